"""Readers and discovery of input files."""
