"""Run descriptions, their checks, and the query catalogue."""
