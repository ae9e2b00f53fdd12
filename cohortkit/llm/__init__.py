"""Operators of a large-scale training-data pipeline (text, tokens, archives, vectors).

Nothing else in the library imports this subpackage; ``__spark_entry__.py`` registers its queries
when it is present. ``queries.py`` holds the registered queries and their DuckDB text.
"""
