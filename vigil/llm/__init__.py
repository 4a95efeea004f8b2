"""Operators of a training-data pipeline over documents, pages and embeddings.

Nothing else in the package imports this folder; it uses only general helpers.
"""
