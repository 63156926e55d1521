"""Operators of a training-data pipeline: text, vectors, conversations and token files."""
