"""Readers and parsers: dump text in, typed rows out."""
