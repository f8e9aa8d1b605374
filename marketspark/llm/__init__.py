"""Operators of a training-data pipeline: documents, vectors and web pages at corpus scale."""
