"""Structured Streaming jobs over message topics."""
