"""Identifier, text and time function queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dumpflow.functions import ids, text, times
from dumpflow.plans import adapters
from dumpflow.plans.check_sql import BLANKS, page_hash
from dumpflow.plans.registry import query


@query(
    f"""SELECT 'documents' AS origin, doc_id AS id, {page_hash('lang', 'text')} AS page_hash FROM documents
    UNION ALL SELECT 'pages', page_id, {page_hash("'enwiki'", 'url')} FROM pages"""
)
def page_identifier(spark: SparkSession, folder: str) -> DataFrame:
    documents = adapters.rows_to_render(spark, folder, "documents", "doc_id", "lang", "text").select(
        F.lit("documents").alias("origin"), F.col("doc_id").alias("id"),
        ids.page_identifier(F.col("lang"), F.col("text")).alias("page_hash"),
    )
    pages = adapters.table(spark, folder, "pages").select(
        F.lit("pages").alias("origin"), F.col("page_id").alias("id"),
        ids.page_identifier(F.lit("enwiki"), F.col("url")).alias("page_hash"),
    )
    return documents.unionByName(pages)


@query(
    """SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN NULL ELSE sha256(lang || '-' || doc_id) END AS content,
      CASE WHEN doc_id % 10 = 0 THEN NULL ELSE sha256(lang || '-' || doc_id || '-' || source) END AS document,
      substr(sha256(text), 1, 8) AS short, substr(sha256(text), 1, 32) AS longest FROM documents"""
)
def hash_family(spark: SparkSession, folder: str) -> DataFrame:
    wiki = F.when(F.col("doc_id") % 10 == 0, F.lit("")).otherwise(F.col("lang"))
    return adapters.table(spark, folder, "documents").select(
        "doc_id",
        ids.content_hash(wiki, F.col("doc_id")).alias("content"),
        ids.document_hash(wiki, F.col("doc_id"), F.col("source")).alias("document"),
        ids.short_hash(F.col("text")).alias("short"),
        ids.short_hash(F.col("text"), 40).alias("longest"),
    )


@query(
    r"""SELECT page_id, lower(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)', 1)) AS netloc,
      nullif(regexp_replace(regexp_replace(lower(regexp_extract(url,
        '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)', 1)), '^.*@', ''), ':[0-9]*$', ''), '') AS host FROM pages"""
)
def url_host(spark: SparkSession, folder: str) -> DataFrame:
    url = F.col("url")
    return adapters.table(spark, folder, "pages").select(
        "page_id", text.url_netloc(url).alias("netloc"), text.url_host(url).alias("host")
    )


@query(
    rf"""SELECT doc_id, len(w) AS n_words, w[1] AS first_word, w[len(w)] AS last_word, lower(w[1]) AS lowered,
      CASE WHEN contains(text, ':') THEN length(split_part(text, ':', 1)) END AS prefix_length,
      length(regexp_replace(text, '^[{BLANKS}]+|[{BLANKS}]+$', '', 'g')) AS stripped_length,
      len(string_split(text, chr(9))) AS n_fields, starts_with(text, 'T') AS starts_with_t,
      ends_with(text, '.') AS ends_with_dot, lpad(CAST(doc_id % 100 AS VARCHAR), 2, '0') AS padded,
      lang || '|' || source AS joined
    FROM (SELECT *, regexp_extract_all(text, '[^{BLANKS}]+') AS w FROM documents)"""
)
def string_fns(spark: SparkSession, folder: str) -> DataFrame:
    body = F.col("text")
    split = text.once(adapters.rows_to_render(spark, folder, "documents", "doc_id", "text", "lang", "source"), "w", text.words(body))
    first = F.get("w", F.lit(0))
    return split.select(
        "doc_id",
        F.size("w").cast("bigint").alias("n_words"),
        first.alias("first_word"),
        F.get("w", F.size("w") - 1).alias("last_word"),
        F.lower(first).alias("lowered"),
        F.length(text.title_prefix(body)).cast("bigint").alias("prefix_length"),
        F.length(text.strip_blanks(body)).cast("bigint").alias("stripped_length"),
        F.size(F.split(body, "\t")).cast("bigint").alias("n_fields"),
        body.startswith("T").alias("starts_with_t"),
        body.endswith(".").alias("ends_with_dot"),
        F.lpad((F.col("doc_id") % 100).cast("string"), 2, "0").alias("padded"),
        ids.key_text(F.col("lang"), F.col("source")).alias("joined"),
    )


@query(
    """SELECT o_orderkey, CASE o_orderkey % 6 WHEN 4 THEN NULL
      WHEN 1 THEN strftime(CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + INTERVAL 8 HOUR, '%Y-%m-%dT%H:%M:%SZ')
      WHEN 3 THEN strftime(CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP), '%Y-%m-%dT%H:%M:%SZ')
      ELSE strftime(CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + INTERVAL 10 HOUR, '%Y-%m-%dT%H:%M:%SZ') END AS parsed
    FROM orders"""
)
def timestamp_parse(spark: SparkSession, folder: str) -> DataFrame:
    shapes = adapters.table(spark, folder, "orders").selectExpr(
        "o_orderkey",
        "CASE o_orderkey % 6 WHEN 0 THEN date_format(o_orderdate, \"yyyy-MM-dd'T10:00:00Z'\") "
        "  WHEN 1 THEN date_format(o_orderdate, \"yyyy-MM-dd'T10:00:00+02:00'\") "
        "  WHEN 2 THEN date_format(o_orderdate, \"yyyy-MM-dd' 10:00:00'\") "
        "  WHEN 3 THEN date_format(o_orderdate, 'yyyy-MM-dd') WHEN 4 THEN 'yesterday' "
        "  ELSE date_format(o_orderdate, \"yyyyMMdd'100000'\") END AS stamp",
    )
    stamp = F.col("stamp")
    parsed = F.coalesce(times.parse_touched(stamp), times.parse_iso(stamp))
    return shapes.select("o_orderkey", times.iso_text(parsed).alias("parsed"))


@query(
    """SELECT event_id, CASE event_id % 5 WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
      WHEN 1 THEN strftime(ts, '%Y-%m-%d 00:00:00') WHEN 2 THEN strftime(ts, '%Y-%m-01 00:00:00')
      WHEN 3 THEN strftime(ts, '%Y-%m-%d 00:00:00') END AS from_text,
      strftime(ts, '%Y-%m-%d %H:%M:%S') AS from_millis, strftime(ts, '%Y-%m-%d %H:%M:%S') AS from_event
    FROM events"""
)
def timestamp_normalize(spark: SparkSession, folder: str) -> DataFrame:
    shapes = adapters.table(spark, folder, "events").selectExpr(
        "event_id",
        "CASE event_id % 5 WHEN 0 THEN date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS') "
        "  WHEN 1 THEN date_format(ts, 'yyyy-MM-dd') WHEN 2 THEN date_format(ts, 'yyyy-MM') "
        "  WHEN 3 THEN date_format(ts, 'yyyyMMdd') ELSE 'soon' END AS shape",
        "unix_millis(cast(ts AS timestamp)) AS millis",
        "if(event_id % 2 = 0, cast(unix_seconds(cast(ts AS timestamp)) AS string), "
        "  date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")) AS event_text",
    )
    return shapes.select(
        "event_id",
        times.normalize_timestamp(F.col("shape")).alias("from_text"),
        times.normalize_epoch_ms(F.col("millis")).alias("from_millis"),
        times.stamp_text(times.event_time(F.col("event_text"))).alias("from_event"),
    )


@query(
    """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso, strftime(ts, '%Y-%m') AS year_month,
      CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS epoch_seconds FROM events"""
)
def timestamp_format(spark: SparkSession, folder: str) -> DataFrame:
    stamp = F.col("ts").cast("timestamp")
    seconds = F.unix_seconds(stamp)
    return adapters.table(spark, folder, "events").select(
        "event_id",
        times.iso_text(F.timestamp_seconds(seconds)).alias("iso"),
        times.year_month(stamp).alias("year_month"),
        seconds.alias("epoch_seconds"),
    )
