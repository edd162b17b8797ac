"""Operators of a training-data pipeline over documents, pages and vectors; nothing else in the library imports this."""
