"""Registry of queries. Each takes a session and a table folder and returns a frame.

`sql` is the same result written over the base tables, for a check by another
engine; it does not go through dump text, so it also checks the parsers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dumpflow.session import prepare

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name."""
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(prepare(spark), folder)

        QUERIES[fn.__name__] = run
        if sql is not None:
            CHECKS[fn.__name__] = sql
        return run

    return register
