"""Operators of a training-data pipeline over documents, pages and embeddings.

One module per operator; ``queries`` registers one query per operator with its
DuckDB oracle where SQL can express it. Nothing else in the library imports
this subpackage.
"""
