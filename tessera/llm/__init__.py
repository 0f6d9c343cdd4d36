"""Operators for large text, media and embedding corpora used as training data."""
