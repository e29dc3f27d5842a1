"""Operators for large training-data corpora: one module per operator, its query in the same module."""
