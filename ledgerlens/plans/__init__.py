"""Query plans: fixture views, the query registry and the DuckDB oracle texts."""
