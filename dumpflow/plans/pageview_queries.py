"""Pageview and TSV queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dumpflow.functions import codes
from dumpflow.operators.quality import count_prefixes, count_reasons
from dumpflow.operators.stats import number_lines, sample_per, sample_rows
from dumpflow.plans import adapters
from dumpflow.plans.check_sql import CS, PV, page_hash, wiki_of, with_
from dumpflow.plans.registry import query
from dumpflow.sources.clickstream import classify_clickstream, clicks_per_target, parse_clickstream
from dumpflow.sources.formats import route_lines
from dumpflow.sources.lines import concat_lines
from dumpflow.sources.pageviews import classify_pageviews, parse_pageviews, views_per_page_day

KEPT_WIKIS = ("en.wikipedia", "fr.wikipedia")


@query(with_(PV) + "SELECT event_id, domain, title, access_type, views FROM pv WHERE reason IS NULL")
def pageview_parse(spark: SparkSession, folder: str) -> DataFrame:
    lines = adapters.pageview_lines(spark, folder)
    return parse_pageviews(lines).select("event_id", "domain", "title", "access_type", "views")


@query(
    with_(PV)
    + "SELECT coalesce(reason, 'kept') AS reason, count(*) AS n, CAST(sum(CASE WHEN reason IN "
    "('empty_lines', 'invalid_format') THEN 0 ELSE views END) AS BIGINT) AS views FROM pv GROUP BY 1"
)
def pageview_disposition(spark: SparkSession, folder: str) -> DataFrame:
    return count_reasons(classify_pageviews(adapters.pageview_lines(spark, folder)), "views")


@query(
    with_(PV)
    + "SELECT event_id, title FROM pv WHERE reason IS NULL OR reason = 'zero_pageviews'"
)
def prefix_filter(spark: SparkSession, folder: str) -> DataFrame:
    classified = classify_pageviews(adapters.pageview_lines(spark, folder))
    keep = F.col("reason").isNull() | (F.col("reason") == "zero_pageviews")
    return classified.where(keep).select("event_id", "title")


@query(
    with_(PV)
    + "SELECT split_part(title, ':', 1) AS prefix, count(*) AS n FROM pv WHERE reason = 'excluded_prefix' GROUP BY 1"
)
def prefix_counts(spark: SparkSession, folder: str) -> DataFrame:
    return count_prefixes(classify_pageviews(adapters.pageview_lines(spark, folder)))


@query(
    with_(PV)
    + """SELECT 'pageviews' AS kind, CASE WHEN reason IN ('empty_lines', 'invalid_format') THEN reason
      WHEN domain = 'de.wikipedia' THEN 'wiki_code_not_allowed' ELSE coalesce(reason, 'kept') END AS reason,
      count(*) AS n FROM pv GROUP BY 1, 2
    UNION ALL SELECT 'clickstream', CASE WHEN event_id % 13 = 0 OR event_id % 5 = 2 THEN 'invalid_format'
      WHEN user_id % 3 = 1 THEN 'wiki_code_not_allowed' ELSE 'kept' END, count(*) FROM events GROUP BY 1, 2"""
)
def wiki_filter(spark: SparkSession, folder: str) -> DataFrame:
    views = classify_pageviews(adapters.pageview_lines(spark, folder), wiki_filter=KEPT_WIKIS)
    clicks = classify_clickstream(adapters.clickstream_lines(spark, folder), wiki_filter=("enwiki", "frwiki"))
    return concat_lines(
        count_reasons(views).select(F.lit("pageviews").alias("kind"), "reason", "n"),
        count_reasons(clicks).select(F.lit("clickstream").alias("kind"), "reason", "n"),
    )


@query(with_(PV) + "SELECT event_id, access_code, agent_code FROM pv WHERE reason IS NULL")
def pageview_codes(spark: SparkSession, folder: str) -> DataFrame:
    parsed = parse_pageviews(adapters.pageview_lines(spark, folder))
    return parsed.select(
        "event_id",
        codes.access_code(F.col("access_type")).alias("access_code"),
        codes.agent_code(F.col("file_name")).alias("agent_code"),
    )


@query(
    with_(PV)
    + f"""SELECT {page_hash('domain', "coalesce(title, '')")} AS page_hash,
      CAST(day AS VARCHAR) AS day, access_code, CAST(sum(views) AS BIGINT) AS views
    FROM pv WHERE reason IS NULL GROUP BY 1, 2, 3"""
)
def pageview_rollup(spark: SparkSession, folder: str) -> DataFrame:
    parsed = parse_pageviews(adapters.pageview_lines(spark, folder))
    return views_per_page_day(parsed).select("page_hash", F.col("day").cast("string").alias("day"), "access_code", "views")


def _mixed_lines(spark: SparkSession, folder: str) -> DataFrame:
    return concat_lines(adapters.pageview_lines(spark, folder), adapters.clickstream_lines(spark, folder))


@query(
    with_(PV, CS)
    + """SELECT 'pageviews' AS kind, count(*) AS n, count_if(reason IS NULL)::BIGINT AS n_kept,
      CAST(sum(views) FILTER (reason IS NULL) AS BIGINT) AS total FROM pv
    UNION ALL SELECT 'clickstream', count(*), count_if(kept)::BIGINT, CAST(sum(clicks) FILTER (kept) AS BIGINT) FROM cs"""
)
def route_by_file(spark: SparkSession, folder: str) -> DataFrame:
    """Mixed lines, each parsed by the parser that its file's name asks for: lines, good ones, and their views or clicks."""
    views, clicks = route_lines(_mixed_lines(spark, folder))
    parsed = concat_lines(
        classify_pageviews(views).select(F.lit("pageviews").alias("kind"), "reason", F.col("views").alias("amount")),
        classify_clickstream(clicks).select(F.lit("clickstream").alias("kind"), "reason", F.col("clicks").alias("amount")),
    )
    good = F.col("reason").isNull()
    return parsed.groupBy("kind").agg(F.count("*").alias("n"), F.count_if(good).alias("n_kept"), F.sum(F.when(good, F.col("amount"))).alias("total"))


# The rendered lines again, in the other dialect: `adapters` has them as Spark expressions.
_LINES = f"""
  pageview_lines AS (
    SELECT file_name, CASE WHEN event_id % 31 = 0 THEN '  ' ELSE CASE event_id % 5
      WHEN 0 THEN concat_ws(s, domain, access_type, v) WHEN 1 THEN concat_ws(s, domain, t, access_type, v)
      WHEN 2 THEN concat_ws(s, domain, t, event_id, access_type, v)
      WHEN 3 THEN concat_ws(s, domain, t, event_id, access_type, v, 'A3B9') ELSE concat_ws(s, domain, t) END END AS value
    FROM (SELECT pv.*, CASE WHEN event_id % 7 = 0 THEN chr(9) ELSE ' ' END AS s,
        CASE WHEN event_id % 17 = 0 THEN 'x' ELSE '' END || CAST(floor(value) AS BIGINT) AS v,
        CASE pv.event_type WHEN 'error' THEN 'Special:P' || user_id WHEN 'signup' THEN 'User_talk:U' || user_id
          WHEN 'purchase' THEN 'Page:' || user_id ELSE 'Page_' || user_id END AS t
      FROM pv JOIN (SELECT event_id, value FROM events) USING (event_id))),
  clickstream_lines AS (
    SELECT file_name, CASE WHEN event_id % 13 = 0 THEN concat_ws(chr(9), source, target, kind)
      ELSE concat_ws(chr(9), source, target, kind, n, CASE WHEN event_id % 5 = 3 THEN 'extra' END) END AS value
    FROM (SELECT cs.*, ['https://www.Google.com/search?q=' || user_id, 'other-google', '', 'http://news.bing.com:80/' || user_id,
          'Page_' || event_id % 97][1 + event_id % 5] AS source,
        CASE event_type WHEN 'click' THEN 'link' WHEN 'view' THEN 'external' WHEN 'purchase' THEN 'external'
          WHEN 'error' THEN 'other' ELSE 'junk' END AS kind,
        CASE WHEN event_id % 11 = 0 THEN 'n/a' ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END AS n
      FROM cs JOIN (SELECT event_id, event_type, value FROM events) USING (event_id))),
  link_lines AS (
    SELECT {wiki_of('l_linenumber')} || '-' || strftime(l_shipdate, '%Y%m') || '01-pagelinks.sql.gz' AS file_name,
      CASE WHEN l_linenumber = 1 THEN '-- links' || chr(10) || chr(10) ELSE '' END || 'INSERT INTO `'
        || CASE WHEN l_returnflag = 'R' THEN 'templatelinks' ELSE 'pagelinks' END || '` VALUES ('
        || concat_ws(',', l_orderkey, l_linenumber, l_partkey) || '),(' || concat_ws(',', l_orderkey, l_linenumber, l_suppkey) || ')' AS value
    FROM lineitem)"""


@query(
    with_(PV, CS, _LINES)
    + """SELECT file_name, count(*) AS n, CAST(sum(strlen(value)) AS BIGINT) AS n_bytes,
      CAST(sum(CAST('0x' || left(md5(value), 8) AS BIGINT)) AS BIGINT) AS digest
    FROM (FROM pageview_lines UNION ALL FROM clickstream_lines UNION ALL FROM link_lines) GROUP BY 1"""
)
def multi_file_union(spark: SparkSession, folder: str) -> DataFrame:
    """Lines, bytes and a digest of the text, whatever the order of lines, of every file of a union."""
    columns = ("file_name", "value")
    lines = concat_lines(
        adapters.pageview_lines(spark, folder).select(*columns),
        adapters.clickstream_lines(spark, folder).select(*columns),
        adapters.pagelink_statements(spark, folder).select(*columns),
    )
    return lines.groupBy("file_name").agg(
        F.count("*").alias("n"), F.sum(F.octet_length("value")).alias("n_bytes"),
        F.sum(F.conv(F.left(F.md5("value"), F.lit(8)), 16, 10).cast("bigint")).alias("digest"))


@query(
    with_(PV)
    + "SELECT event_id, domain, title, views FROM pv WHERE reason IS NULL ORDER BY event_id LIMIT 100"
)
def sample_limit(spark: SparkSession, folder: str) -> DataFrame:
    parsed = parse_pageviews(adapters.pageview_lines(spark, folder))
    return sample_rows(parsed.select("event_id", "domain", "title", "views"), 100, "event_id")


@query(
    with_(PV)
    + "SELECT event_id, file_name, row_number() OVER (PARTITION BY file_name ORDER BY event_id) AS line_number FROM pv"
)
def line_number(spark: SparkSession, folder: str) -> DataFrame:
    lines = adapters.pageview_lines(spark, folder).select("event_id", "file_name")
    # Events stand in for lines at ascending positions, cut into blocks of a fixed width.
    blocks = lines.withColumn("_block", F.expr("event_id div 1048576"))
    return number_lines(blocks, "file_name", "_block", "event_id").select("event_id", "file_name", "line_number")


@query(
    with_(CS)
    + "SELECT event_id, wiki_code, target, type, category, clicks FROM cs WHERE kept"
)
def clickstream_parse(spark: SparkSession, folder: str) -> DataFrame:
    parsed = parse_clickstream(adapters.clickstream_lines(spark, folder))
    return parsed.select("event_id", "wiki_code", "target", "type", "category", "clicks")


@query(with_(CS) + "SELECT event_id, category, strict_category FROM cs WHERE kept")
def referer_category(spark: SparkSession, folder: str) -> DataFrame:
    parsed = parse_clickstream(adapters.clickstream_lines(spark, folder))
    strict = codes.referer_category(F.col("type"), F.col("source"), strict=True)
    return parsed.select("event_id", "category", strict.alias("strict_category"))


@query(
    with_(CS)
    + "SELECT wiki_code, target, type, category, CAST(sum(clicks) AS BIGINT) AS clicks FROM cs WHERE kept "
    "GROUP BY 1, 2, 3, 4"
)
def clickstream_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return clicks_per_target(parse_clickstream(adapters.clickstream_lines(spark, folder)))


@query(
    with_(PV)
    + """SELECT file_name, event_id FROM (SELECT file_name, event_id,
      row_number() OVER (PARTITION BY file_name ORDER BY event_id) AS rn FROM pv WHERE reason IS NULL) WHERE rn <= 5"""
)
def sample_per_file(spark: SparkSession, folder: str) -> DataFrame:
    """The first five good lines of every file."""
    parsed = parse_pageviews(adapters.pageview_lines(spark, folder))
    return sample_per(parsed, 5, "file_name", "event_id").select("file_name", "event_id")
