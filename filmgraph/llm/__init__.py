"""Operators of a training-data pipeline over documents, pages and embeddings.

One module per operator; ``entry`` holds the registered queries and ``sql`` their DuckDB
statements. Nothing else in the library imports this package.
"""
