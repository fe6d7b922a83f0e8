"""Training-data operators.  Nothing else in the library imports this package.

Each module holds one operator with its general interface; ``queries`` binds
them to the ``documents`` / ``benchmark`` / ``labels`` tables.
"""
