"""Operators for building training corpora out of documents, pages and vectors."""
