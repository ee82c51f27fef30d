"""All registered queries."""

from __future__ import annotations

from dumpflow.plans import (  # noqa: F401
    dump_queries,
    file_queries,
    manifest_queries,
    message_queries,
    page_queries,
    pageview_queries,
    scalar_queries,
    stream_queries,
)
from dumpflow.plans.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
