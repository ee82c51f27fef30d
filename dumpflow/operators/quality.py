"""Skip-and-count: reasons, quarantine and required fields."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dumpflow import fixed_values as fx
from dumpflow.functions.times import event_time

KEPT = "kept"


def count_reasons(classified: DataFrame, *sums: str) -> DataFrame:
    """Rows per reason (`kept` for good rows), with optional sums of other columns."""
    return classified.groupBy(F.coalesce("reason", F.lit(KEPT)).alias("reason")).agg(
        F.count("*").alias("n"), *[F.sum(c).alias(c) for c in sums]
    )


def count_prefixes(classified: DataFrame) -> DataFrame:
    """Rows dropped per excluded title prefix."""
    return (
        classified.where(F.col("reason") == fx.EXCLUDED_PREFIX).groupBy("prefix").agg(F.count("*").alias("n"))
    )


def split_quarantine(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without the reason, bad rows with it)."""
    good = F.col("reason").isNull()
    return classified.where(good).drop("reason"), classified.where(~good)


def keep_good(classified: DataFrame, on_bad: Callable[[DataFrame], None]) -> DataFrame:
    """Good rows; the bad ones are handed to `on_bad` as one frame (to write or count)."""
    good, bad = split_quarantine(classified)
    on_bad(bad)
    return good


def observe_reasons(classified: DataFrame, name: str) -> DataFrame:
    """Let a running job report its good and bad rows without a second pass."""
    return classified.observe(
        name,
        F.count_if(F.col("reason").isNull()).alias("processed"),
        F.count_if(F.col("reason").isNotNull()).alias("skipped"),
    )


def _empty(value: Column) -> Column:
    return value.isNull() | (value.cast("string") == "")


def missing_field(record_type: Column, fields: dict[str, Column]) -> Column:
    """Name of the first required field that a record lacks; NULL for a valid record.

    `record_type` is document, pageview, revision, clickstream, outbound_link,
    inbound_link or page_info. `fields` maps field names to columns; a required
    field that is not mapped is missing from every record.
    """
    def absent(name: str) -> Column:
        return _empty(fields[name]) if name in fields else F.lit(True)

    def first_absent(*names: str) -> Column:
        out = F.lit(None).cast("string")
        for name in reversed(names):
            out = F.when(absent(name), F.lit(name)).otherwise(out)
        return out

    views = first_absent("page_hash", "access_type", "user_type", "date", "views")
    if "date" in fields:
        bad_date = event_time(fields["date"].cast("string")).isNull()
        views = F.coalesce(views, F.when(bad_date, F.lit("date")))
    return (
        F.when(record_type == "pageview", views)
        .when(record_type == "revision", first_absent("page_id"))
        .when(record_type == "clickstream", first_absent("target_page", "tuple_struct"))
        .when(record_type == "outbound_link", first_absent("tuple_struct", "pl_from"))
        .when(record_type == "inbound_link", first_absent("tuple_struct", "pl_target_id"))
        .otherwise(first_absent("page_hash"))
    )
