"""Whole jobs: a folder of dump files to stored facts, and a sample to a topic."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dumpflow import fixed_values as fx
from dumpflow.functions.times import file_date, file_wiki_code
from dumpflow.operators import facts
from dumpflow.operators.links import page_crosswalk
from dumpflow.operators.quality import KEPT
from dumpflow.operators.records import message_rows, stamp_ingest
from dumpflow.operators.stats import sample_rows
from dumpflow.sinks.messages import replay_to_folder
from dumpflow.sinks.tables import append_batch, read_facts
from dumpflow.sources import revisions as rev
from dumpflow.sources.clickstream import classify_clickstream
from dumpflow.sources.lines import read_lines
from dumpflow.sources.pageviews import classify_pageviews
from dumpflow.sources.sqldump import PAGE, PAGELINKS, classify_dump, page_info_records, parse_dump, read_statements


#: Dump files by type; the page table feeds the crosswalk and is not one of the types to fetch.
FILE_PATTERNS = {**fx.LOCAL_FILE_PATTERNS, "page": r"^([a-z][a-z0-9_]*)-\d{8}-page\.sql(?:\.gz)?$"}


def selected(
    data_type: str,
    years: Iterable[int] | None = None,
    months: Iterable[int] | None = None,
    wiki_codes: Iterable[str] | None = None,
) -> Column:
    """Condition on `file_name` for the dump files of a request."""
    name = F.col("file_name")
    keep = name.rlike(FILE_PATTERNS[data_type])
    if years:
        keep = keep & F.year(file_date(name)).isin(list(years))
    if months:
        keep = keep & F.month(file_date(name)).isin(list(months))
    if wiki_codes and data_type != "pageviews":
        keep = keep & file_wiki_code(name).isin(list(wiki_codes))
    return keep


_FACTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "pageviews": facts.view_facts,
    "clickstream": facts.click_facts,
    "revisions": facts.revision_facts,
    "pagelinks": facts.link_facts,
    "page": facts.title_facts,
}


def _classified(spark: SparkSession, folder: str, data_type: str, keep: Column, spread: int | None) -> DataFrame:
    if data_type == "revisions":
        return rev.classify_revisions(rev.read_pages(spark, folder, spread, recursive=True, files=keep))
    if data_type in ("pagelinks", "page"):
        table = PAGELINKS if data_type == "pagelinks" else PAGE
        return classify_dump(read_statements(spark, folder, spread, recursive=True, files=keep), table)
    lines = read_lines(spark, folder, spread=spread, recursive=True, files=keep)
    return classify_pageviews(lines) if data_type == "pageviews" else classify_clickstream(lines)


def process(
    spark: SparkSession,
    folder: str,
    output: str,
    data_type: str,
    batch_id: str,
    years: Iterable[int] | None = None,
    months: Iterable[int] | None = None,
    wiki_codes: Iterable[str] | None = None,
    spread: int | None = None,
) -> DataFrame:
    """Parse the dump files a request asks for and store their facts.

    Typed rows are written once, in a folder per `reason`; `kept` holds the good
    ones, the others are the quarantine. Facts are then made from the good rows,
    without reading text again. Both writes replace what an earlier run of the
    batch left. Returns the typed rows of the batch.
    """
    if data_type not in _FACTS:
        raise ValueError(f"unknown data type {data_type!r}; known: {sorted(_FACTS)}")
    rows = _classified(spark, folder, data_type, selected(data_type, years, months, wiki_codes), spread)
    staged = f"{output.rstrip('/')}/rows/{data_type}/batch_id={batch_id}"
    (
        rows.withColumn("reason", F.coalesce("reason", F.lit(KEPT)))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy("reason")
        .parquet(staged)
    )
    written = spark.read.schema(rows.schema).parquet(staged)
    good = written.where(F.col("reason") == KEPT)
    append_batch(_FACTS[data_type](good), f"{output.rstrip('/')}/facts", f"{data_type}-{batch_id}")
    return written


def stored_pages(spark: SparkSession, output: str) -> DataFrame:
    """Facts that `process` has stored, all under title hashes, with `is_known`.

    The crosswalk comes from the page tables among the stored rows. Facts of pages
    that it lacks stay, marked as not known.
    """
    rows = spark.read.parquet(f"{output.rstrip('/')}/rows/page").where(F.col("reason") == KEPT)
    return facts.by_title(read_facts(spark, f"{output.rstrip('/')}/facts"), page_crosswalk(rows))


def unknown_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files of a folder that no type claims, so that a new kind of name does not go unseen."""
    names = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select(
        F.regexp_extract("path", r"[^/]*$", 0).alias("file_name"), "length")
    claimed = F.lit(False)
    for pattern in FILE_PATTERNS.values():
        claimed = claimed | F.col("file_name").rlike(pattern)
    return names.where(~claimed)


def replay_page_sample(spark: SparkSession, paths, topic_folder: str, run_time: Column, limit: int | None = None) -> None:
    """Send a `page` dump to a topic folder, stamped with the run's time.

    With a limit only the pages with the smallest ids are sent.
    """
    pages = parse_dump(read_statements(spark, paths), PAGE)
    records = stamp_ingest(page_info_records(sample_rows(pages, limit, "wiki_code", "page_id", "page_title")), run_time)
    replay_to_folder(message_rows(records, "pageinfo_topic", "PageInfo"), topic_folder)
