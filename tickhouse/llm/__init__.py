"""Operators for preparing training data: documents, vectors and web pages."""
