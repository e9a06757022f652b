"""Operators and queries for preparing training corpora."""
