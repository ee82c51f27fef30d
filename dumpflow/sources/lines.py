"""Text sources: plain, gzip and bzip2 dump files as rows of lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(
    spark: SparkSession,
    paths: str | Sequence[str],
    line_sep: str | None = None,
    spread: int | None = None,
    skip_corrupt: bool = False,
    recursive: bool = False,
    files: Column | None = None,
) -> DataFrame:
    """Lines of one or many dump files as `(value, file_name, file_path, block_start)`.

    The codec is chosen by suffix. A gzip file cannot be split, so one task reads
    all of it: pass `spread` to deal its lines out to that many partitions before
    the parsing work. `skip_corrupt` keeps the other files when one is broken.
    Bytes that are not UTF-8 become replacement characters. `files` is a condition
    on `file_name` or `file_path`; other files are not opened.
    """
    reader = spark.read.option("ignoreCorruptFiles", str(skip_corrupt).lower()).option(
        "recursiveFileLookup", str(recursive).lower()
    )
    if line_sep is not None:
        reader = reader.option("lineSep", line_sep)
    paths = [paths] if isinstance(paths, str) else list(paths)
    lines = reader.text(paths).select(
        F.make_valid_utf8("value").alias("value"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
    )
    if files is not None:
        lines = lines.where(files)  # in front of the deal, so that it reaches the scan
    return spread_out(lines, spread) if spread else lines


#: Stored bytes of a scan's columns that one task gets by default. Rendered text and parsed rows are many times that.
BYTES_PER_TASK = 4_000_000


def tasks_for(rows: DataFrame, bytes_per_task: int | None = None) -> int:
    """A task per core, and more where the columns of a scan are large, so that no task grows with the input."""
    stored = int(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())  # from file sizes
    if stored >= 2**50:  # rows of no file: Spark takes an unknown size for the greatest
        return int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(rows.sparkSession.sparkContext.defaultParallelism, -(-stored // (bytes_per_task or BYTES_PER_TASK)))


def spread_out(rows: DataFrame, tasks: int | None = None) -> DataFrame:
    """Deal the rows of a scan out evenly to `tasks` tasks, by default `tasks_for` its size.

    Meant for small or unsplittable inputs in front of heavy parsing: one large
    gzip file among thousands of small ones is dealt out like any other.
    """
    wanted = tasks or tasks_for(rows)
    # A scan reads a split in the same order every time, so row numbers, unlike a
    # round-robin deal, need no sort to give the same result when a task is rerun.
    numbered = rows.withColumn("_row", F.monotonically_increasing_id())
    return numbered.repartition(wanted, "_row").drop("_row")


def concat_lines(*frames: DataFrame) -> DataFrame:
    """One frame out of several parsed or raw files, matched by column name."""
    if not frames:
        raise ValueError("no input frames")
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out
