"""Run statistics, line numbers and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def success_totals(log: DataFrame, by: str, ok: Column) -> DataFrame:
    """Attempts and successes per group of a job log."""
    return log.groupBy(by).agg(F.count("*").alias("attempted"), F.count_if(ok).alias("success"))


def job_stats(log: DataFrame, by: str, is_error: Column, at: Column, batch_size: int = 100) -> DataFrame:
    """Documents, batches, errors, duration and documents per second of every job."""
    totals = log.groupBy(by).agg(
        F.count("*").alias("documents"),
        F.count_if(is_error).alias("errors"),
        (F.unix_micros(F.max(at)) - F.unix_micros(F.min(at))).alias("_micros"),
    )
    seconds = F.col("_micros") / F.lit(1000000)
    return totals.select(
        by, "documents",
        F.ceil(F.col("documents") / F.lit(batch_size)).cast("bigint").alias("batches"),
        "errors",
        F.round(seconds, 2).alias("duration"),
        F.round(F.col("documents") / F.nullif(seconds, F.lit(0.0)), 4).alias("docs_per_second"),
    )


def sample_rows(rows: DataFrame, limit: int | None, *order: str) -> DataFrame:
    """The first `limit` rows, by an order if one is given; all rows without a limit."""
    if not limit:
        return rows
    return rows.orderBy(*order).limit(limit) if order else rows.limit(limit)


def sample_per(rows: DataFrame, limit: int, by: str, *order: str) -> DataFrame:
    """The first `limit` rows of every group, as of every file, in the order given.

    Spark drops rows past the limit before the shuffle.
    """
    place = F.row_number().over(Window.partitionBy(by).orderBy(*order))
    return rows.withColumn("_place", place).where(F.col("_place") <= limit).drop("_place")


def number_lines(rows: DataFrame, file: str, block: str, order: str, into: str = "line_number") -> DataFrame:
    """Number the lines of each file from 1 without gathering a file in one task.

    A file is cut into blocks whose order is that of their lines: the block start
    of a text scan, or a line position divided by a fixed width. Blocks are
    numbered inside, then shifted by the sizes of the blocks before them. Only
    block sizes are looked at per file.
    """
    sizes = rows.groupBy(file, block).agg(F.count("*").alias("_size"))
    before = Window.partitionBy(file).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(file, block, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(file, block).orderBy(order)
    numbered = rows.withColumn("_inside", F.row_number().over(inside))
    return (
        numbered.join(starts, [file, block])
        .withColumn(into, F.col("_before") + F.col("_inside"))
        .drop("_before", "_inside")
    )
