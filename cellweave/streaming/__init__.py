"""Structured Streaming extensions; batch results never depend on them."""
