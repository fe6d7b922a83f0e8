"""Business operators: DataFrame in, DataFrame out, explicit ``as_of``."""
