"""Queries over real dump files: rendered text is stored compressed, then read by the readers.

A folder `dump=<file name>` holds the parts of each dump, so names say what they
say for real dumps.
"""

from __future__ import annotations

import gzip
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dumpflow.functions.times import stamp_text
from dumpflow.operators.links import INBOUND, mirror_links
from dumpflow.operators.records import message_rows, typed_partition_key
from dumpflow.plans import adapters
from dumpflow.plans.check_sql import CS, PG, PL, PV, RV, page_hash, with_
from dumpflow.plans.registry import query
from dumpflow.session import cut_lineage, fresh_folder
from dumpflow.sources import revisions as rev
from dumpflow.sources.checked import broken_files, good_lines, read_checked
from dumpflow.sources.clickstream import clickstream_records, parse_clickstream
from dumpflow.sources.lines import read_lines
from dumpflow.sources.pageviews import pageview_records, parse_pageviews
from dumpflow.sources.sqldump import PAGE, PAGELINKS, link_records, page_info_records, parse_dump, read_statements


def stored(rows: DataFrame, purpose: str, compression: str) -> str:
    """Write `(file_name, value)` rows as compressed text, a folder per file name."""
    path = fresh_folder(rows.sparkSession, purpose)
    named = rows.select("value", F.col("file_name").alias("dump"))
    named.hint("rebalance", "dump").write.partitionBy("dump").option("compression", compression).text(path)
    return path


def stored_whole(rows: DataFrame, purpose: str, order: str, broken: Column) -> str:
    """Write `(file_name, value)` rows as one gzip file per name, its lines by `order`.

    Of a `broken` file the second half of the lines is lost: it lies in a gzip member that is cut short.
    """
    path = fresh_folder(rows.sparkSession, purpose)
    of_file = Window.partitionBy("file_name")
    halves = rows.select("file_name", "value", (~broken | (
        F.row_number().over(of_file.orderBy(order)) <= F.floor(F.count("*").over(of_file) / 2))).alias("whole"), order)
    dealt = halves.repartition("file_name").sortWithinPartitions("file_name", order).select("file_name", "value", "whole")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(path) if ":" in path else (pafs.LocalFileSystem(), path)
        fs.create_dir(root, recursive=True)
        name, parts, names = None, {}, []

        def close() -> None:
            if name is not None:
                raw = gzip.compress("".join(parts[True]).encode()) + (gzip.compress("".join(parts[False]).encode())[:12] if parts[False] else b"")
                with fs.open_output_stream(f"{root}/{name}", compression=None) as out:
                    out.write(raw)
                names.append(name)

        for batch in batches:
            for file_name, value, whole in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if file_name != name:
                    close()
                    name, parts = file_name, {True: [], False: []}
                parts[whole].append(value + "\n")
        close()
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], ["file_name"])

    cut_lineage(dealt.mapInArrow(write, "file_name string"))
    return path


def named(rows: DataFrame) -> DataFrame:
    """The dump's name in place of that of one of its parts."""
    return rows.withColumn("file_name", F.regexp_extract("file_path", r"/dump=([^/]+)/", 1))


@query(with_(PV) + "SELECT domain, title, access_type, views, file_name FROM pv WHERE reason IS NULL")
def file_pageviews(spark: SparkSession, folder: str) -> DataFrame:
    path = stored(adapters.pageview_lines(spark, folder), "pageview-files", "bzip2")
    parsed = parse_pageviews(named(read_lines(spark, path, recursive=True)))
    return parsed.select("domain", "title", "access_type", "views", "file_name")


@query(with_(CS) + "SELECT wiki_code, year_month, target, type, clicks FROM cs WHERE kept")
def file_clickstream(spark: SparkSession, folder: str) -> DataFrame:
    """Tab-separated files that cannot be split, dealt out after the scan."""
    path = stored(adapters.clickstream_lines(spark, folder), "clickstream-files", "gzip")
    rows = parse_clickstream(named(read_lines(spark, path, spread=spark.sparkContext.defaultParallelism, recursive=True)))
    return clickstream_records(rows).select(
        "wiki_code", "year_month", F.col("tuple_struct.target_page").alias("target"),
        F.col("tuple_struct.navigation_type").alias("type"), F.col("tuple_struct.clicks").alias("clicks"))


@query(with_(PL) + "SELECT wiki_code, year_month, pl_from, pl_from_namespace, pl_target_id FROM pl")
def file_pagelinks(spark: SparkSession, folder: str) -> DataFrame:
    statements = adapters.pagelink_statements(spark, folder).withColumn("value", F.concat("value", F.lit(";")))
    path = stored(statements, "pagelink-files", "gzip")
    links = parse_dump(named(read_statements(spark, path, recursive=True)), PAGELINKS)
    return links.select("wiki_code", "year_month", "pl_from", "pl_from_namespace", "pl_target_id")


@query(
    with_(RV)
    + """SELECT wiki_code, CAST(o_orderkey AS VARCHAR) AS page_id, CAST(rev_id AS VARCHAR) AS rev_id,
      strftime(stamp, '%Y-%m-%d %H:%M:%S') AS stamp, contributor_id FROM rv WHERE reason IS NULL"""
)
def file_revisions(spark: SparkSession, folder: str) -> DataFrame:
    """Exports under their names' own codec, gzip: a dump of many pages lies in several parts, a task each."""
    path = stored(adapters.revision_pages(spark, folder), "revision-files", "gzip")
    parsed = rev.parse_revisions(named(rev.read_pages(spark, path, recursive=True, main_only=True)))
    return parsed.select("wiki_code", "page_id", "rev_id", stamp_text(F.col("timestamp")).alias("stamp"), "contributor_id")


_VALID_STAMP = "i <> 3 AND NOT (i = 2 AND o_orderkey % 19 = 0)"


@query(
    with_(PV, CS, PL, PG, RV)
    + f""", m AS (
      SELECT 'pageview_topic' AS topic, {page_hash('domain', "coalesce(title, '')")} || '|' || year_month AS key FROM pv WHERE reason IS NULL
      UNION ALL SELECT 'clickstream_topic', {page_hash('wiki_code', 'target')} || '|' || year_month FROM cs WHERE kept
      UNION ALL SELECT 'outbound_pagelinks_topic', year_month || '|' || pl_from FROM pl
      UNION ALL SELECT 'inbound_pagelinks_topic', year_month || '|' || pl_from FROM pl
      UNION ALL SELECT 'revision_data_topic', sha256(wiki_code || '-' || o_orderkey) || '|' || strftime(stamp, '%Y-%m') FROM rv WHERE reason IS NULL
      UNION ALL SELECT 'wikidocument_topic', sha256(wiki_code || '-' || o_orderkey) || '|' || wiki_code || '|' || strftime(max(stamp), '%Y-%m')
        FROM rv WHERE {_VALID_STAMP} GROUP BY wiki_code, o_orderkey
      UNION ALL SELECT 'pageinfo_topic', {page_hash("'enwiki'", 'page_title')} || '|2024-05' FROM pg)
    SELECT topic, key, count(*) AS n FROM m GROUP BY 1, 2"""
)
def message_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Messages of all seven record types by topic and key."""
    links = mirror_links(parse_dump(adapters.pagelink_statements(spark, folder), PAGELINKS))
    inbound = F.col("direction") == INBOUND
    link_topic = F.when(inbound, "inbound_pagelinks_topic").otherwise("outbound_pagelinks_topic")
    link_key = F.when(inbound, typed_partition_key("InboundPageLinks")).otherwise(typed_partition_key("OutboundPageLinks"))
    # Read for the revisions and for the documents, so the export is parsed once and kept.
    export = cut_lineage(rev.pages_from_text(rev.main_text(adapters.revision_pages(spark, folder))))
    frames = [
        (pageview_records(parse_pageviews(adapters.pageview_lines(spark, folder))), "pageview_topic", "PageView", None),
        (clickstream_records(parse_clickstream(adapters.clickstream_lines(spark, folder))), "clickstream_topic", "ClickStream", None),
        # Links of both directions in one pass over the dump.
        (link_records(links), link_topic, "", link_key),
        (rev.revision_records(rev.parse_revisions(export)), "revision_data_topic", "RevisionData", None),
        (rev.document_records(export), "wikidocument_topic", "WikiDocument", None),
        (page_info_records(parse_dump(adapters.page_statements(spark, folder), PAGE)), "pageinfo_topic", "PageInfo", None),
    ]
    rows = None
    for records, topic, schema, key in frames:
        one = message_rows(records, topic, schema, key)
        rows = one if rows is None else rows.unionByName(one)
    return rows.groupBy("topic", "key").agg(F.count("*").alias("n"))


@query(
    with_(RV)
    + f"""SELECT sha256(wiki_code || '-' || o_orderkey) AS page_hash, wiki_code, 'Order & ' || o_orderkey AS title,
      any_value(o_orderstatus) = 'P' AS is_redirect, strftime(max(stamp), '%Y-%m-%d %H:%M:%S') AS last_updated
    FROM rv WHERE {_VALID_STAMP} GROUP BY wiki_code, o_orderkey"""
)
def wiki_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Document envelopes of main-namespace pages, with their newest revision's time."""
    records = rev.document_records(rev.pages_from_text(adapters.revision_pages(spark, folder)))
    t = F.col("tuple_struct")
    return records.select("page_hash", "wiki_code", t["title"].alias("title"), t["is_redirect"].alias("is_redirect"), stamp_text(t["last_updated"]).alias("last_updated"))


@query(
    with_(PV)
    + """, l AS (SELECT *, file_name LIKE '%-bot.bz2' AS broken, row_number() OVER (PARTITION BY file_name ORDER BY event_id) AS line,
      count(*) OVER (PARTITION BY file_name) AS n FROM pv),
    g AS (SELECT * FROM l WHERE NOT broken OR line <= n // 2)
    SELECT replace(file_name, '.bz2', '.gz') AS file_name, count(*) AS good_lines,
      count_if(reason IS NULL)::BIGINT AS n_views, CAST(coalesce(sum(views) FILTER (reason IS NULL), 0) AS BIGINT) AS views,
      bool_or(broken) AS is_broken FROM g GROUP BY 1"""
)
def file_isolation(spark: SparkSession, folder: str) -> DataFrame:
    """Stored gzip files, those of one agent cut short: the views of their good lines, and which files are broken."""
    lines = adapters.pageview_lines(spark, folder).withColumn("file_name", F.replace("file_name", F.lit(".bz2"), F.lit(".gz")))
    path = stored_whole(lines, "isolated-files", "event_id", F.col("file_name").endswith("-bot.gz"))
    rows = cut_lineage(read_checked(spark, path).select("value", "file_name", "file_path", "line_number", "error", "position"))
    views = parse_pageviews(good_lines(rows)).groupBy("file_name").agg(F.count("*").alias("n_views"), F.sum("views").alias("views"))
    counts = good_lines(rows).groupBy("file_name").agg(F.count("*").alias("good_lines"))
    # The damage must show right behind the last good line.
    report = broken_files(rows).select("file_name", F.col("good_lines").alias("_before"))
    zero = F.lit(0).cast("bigint")
    return counts.join(views, "file_name", "left").join(report, "file_name", "left").select(
        "file_name", "good_lines", F.coalesce("n_views", zero).alias("n_views"), F.coalesce("views", zero).alias("views"),
        F.coalesce(F.col("_before") == F.col("good_lines"), F.lit(False)).alias("is_broken"))


@query(
    with_(PV)
    + """SELECT event_id, replace(file_name, '.bz2', '.gz') AS file_name,
      row_number() OVER (PARTITION BY file_name ORDER BY event_id) AS line_number FROM pv"""
)
def file_line_number(spark: SparkSession, folder: str) -> DataFrame:
    """Numbers of the lines of stored gzip files, as the reader counts them."""
    lines = adapters.pageview_lines(spark, folder).select(
        "event_id", F.concat_ws(" ", "event_id", "value").alias("value"), F.replace("file_name", F.lit(".bz2"), F.lit(".gz")).alias("file_name"))
    path = stored_whole(lines, "numbered-files", "event_id", F.lit(False))
    read = good_lines(read_checked(spark, path))
    return read.select(F.split("value", " ")[0].cast("bigint").alias("event_id"), "file_name", "line_number")
