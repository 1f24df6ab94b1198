"""Operators that prepare training data: whole tables of documents, vectors and pages."""
