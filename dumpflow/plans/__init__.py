"""Whole jobs: dump text rendered from tables, and the queries over it."""
