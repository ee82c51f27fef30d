"""Operators on parsed rows: quality, records, links, pages, lookups, statistics."""
