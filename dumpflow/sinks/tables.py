"""Table sinks: raw layout, month-partitioned facts, idempotent batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dumpflow.operators.pages import FACT_COLUMNS, PAGE_KEY, drop_equal_facts

LAYOUT = ("data_type", "wiki_code", "year_month")


def layout_path(data_type: Column, wiki_code: Column, period: Column, file_name: Column) -> Column:
    """`type/wiki/period/file`; parts that are NULL are left out."""
    return F.concat_ws("/", data_type, wiki_code, period, file_name)


def stage_path(wiki_code: Column, data_type: Column, day: Column, processed: bool, file_name: Column) -> Column:
    """`wiki/type/yyyy/mm/stage/file`, the stage being raw or processed."""
    stage = F.lit("processed" if processed else "raw")
    return F.concat_ws(
        "/", wiki_code, data_type, F.date_format(day, "yyyy"), F.date_format(day, "MM"), stage, file_name
    )


def stage_file_name(wiki_code: Column, data_type: Column, day: Column, file_format: str = "data") -> Column:
    """Name for an output without a source file: `wiki_type_yyyymmdd.format`."""
    return F.concat(wiki_code, F.lit("_"), data_type, F.lit("_"), F.date_format(day, "yyyyMMdd"), F.lit(f".{file_format}"))


def write_layout(rows: DataFrame, path: str, processed: bool = False, mode: str = "append") -> None:
    """Write rows under `stage/data_type=/wiki_code=/year_month=`."""
    stage = "processed" if processed else "raw"
    # Rebalancing gathers each folder's rows into files of a good size, and splits a
    # folder that holds most of the rows.
    rows.hint("rebalance", *LAYOUT).write.mode(mode).partitionBy(*LAYOUT).parquet(f"{path.rstrip('/')}/{stage}")


def write_facts(facts: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write facts by month, sorted by page.

    Rows are range-partitioned down to the element, so a hot month or page fills
    several files, while the page ranges of files and row groups stay narrow
    enough to skip when a query asks for some pages.
    """
    order = ["year_month", *PAGE_KEY, "kind", "element"]
    (
        facts.select(*FACT_COLUMNS)
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.mode(mode)
        # Overwriting replaces the table, whatever the session says about single months.
        .option("partitionOverwriteMode", "static")
        .partitionBy("year_month")
        .parquet(path)
    )


def write_bucketed(rows: DataFrame, table: str, buckets: int, path: str | None = None) -> None:
    """Save one-row-per-page results bucketed by page, so that joins between them need no shuffle."""
    writer = rows.repartition(buckets, "page_hash").write.mode("overwrite")
    if path is not None:
        writer = writer.option("path", path)
    writer.bucketBy(buckets, "page_hash").sortBy("page_hash").saveAsTable(table)


def append_batch(facts: DataFrame, path: str, batch_id: int | str) -> None:
    """Add one batch of facts under its own `batch_id` folder.

    A batch that is run again replaces only its own folder, so retries after a
    lost executor or driver add nothing twice. Ids must tell all writers of a table
    apart. Repeats across batches are dropped when facts are folded.
    """
    (
        drop_equal_facts(facts.select(*FACT_COLUMNS))
        .hint("rebalance", "year_month")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy("year_month")
        .parquet(f"{path.rstrip('/')}/batch_id={batch_id}")
    )


def read_facts(spark: SparkSession, path: str) -> DataFrame:
    """Facts of all batches written so far; filters on `year_month` prune folders."""
    schema = (
        "wiki_code string, page_hash string, kind string, element string, seen_at timestamp, "
        "batch_id string, year_month string"
    )
    return spark.read.schema(schema).parquet(path).select(*FACT_COLUMNS)


def compact_facts(spark: SparkSession, path: str, into: str) -> None:
    """Merge all batches into a new month-partitioned table without repeats."""
    write_facts(drop_equal_facts(read_facts(spark, path)), into, mode="errorifexists")
