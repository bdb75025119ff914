"""Operators of a large-scale training-data pipeline (one module each).

Nothing else in the library imports this subpackage.  ``queries.QUERIES`` and
``queries.ORACLE`` hold the registered queries and their DuckDB statements.
"""
