"""Operators of a training-data pipeline (documents, pages, benchmark items).

Nothing else in the library imports this subpackage; ``queries.py`` holds the
thin registered queries and their DuckDB texts.
"""
