"""Operators of a training-data pipeline over documents, pages and embeddings.

Nothing else in the library imports this package; it imports general helpers
(session, scratch folder) from the library.
"""
