"""Relational operators of the mosaic engine."""
