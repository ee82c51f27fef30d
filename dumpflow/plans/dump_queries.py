"""SQL dump, link graph and revision queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dumpflow.functions.times import stamp_text
from dumpflow.operators import links as graph
from dumpflow.plans import adapters
from dumpflow.plans.check_sql import PG, PL, RV, page_hash, with_
from dumpflow.plans.registry import query
from dumpflow.sources import revisions as rev
from dumpflow.sources.sqldump import PAGE, PAGELINKS, line_kind, parse_dump


def _links(spark: SparkSession, folder: str) -> DataFrame:
    return parse_dump(adapters.pagelink_statements(spark, folder), PAGELINKS)


def _pages(spark: SparkSession, folder: str) -> DataFrame:
    return parse_dump(adapters.page_statements(spark, folder), PAGE)


def _export(spark: SparkSession, folder: str) -> DataFrame:
    return rev.pages_from_text(adapters.revision_pages(spark, folder))


@query(
    with_(PL)
    + "SELECT wiki_code, year_month, CAST(day AS VARCHAR) || ' 00:00:00' AS dumped_at, "
    "pl_from, pl_from_namespace, pl_target_id FROM pl"
)
def sqldump_pagelinks(spark: SparkSession, folder: str) -> DataFrame:
    return _links(spark, folder).select(
        "wiki_code", "year_month", stamp_text(F.col("timestamp")).alias("dumped_at"),
        "pl_from", "pl_from_namespace", "pl_target_id",
    )


@query(
    """SELECT 'comment' AS kind, count(*) AS n FROM lineitem WHERE l_linenumber = 1
    UNION ALL SELECT 'blank', count(*) FROM lineitem WHERE l_linenumber = 1
    UNION ALL SELECT 'statement', count(*) FROM lineitem"""
)
def sqldump_lines(spark: SparkSession, folder: str) -> DataFrame:
    lines = adapters.dump_lines(spark, folder)
    return lines.groupBy(line_kind(F.col("value")).alias("kind")).agg(F.count("*").alias("n"))


@query(
    with_(PG)
    + f"""SELECT page_id, page_namespace, page_title, page_is_redirect, page_touched, page_links_updated,
      page_latest, page_len, page_content_model, CAST(NULL AS VARCHAR) AS page_lang,
      {page_hash("'enwiki'", 'page_title')} AS page_hash FROM pg"""
)
def sqldump_page(spark: SparkSession, folder: str) -> DataFrame:
    return _pages(spark, folder).select(
        "page_id", "page_namespace", "page_title", "page_is_redirect",
        stamp_text(F.col("page_touched")).alias("page_touched"),
        stamp_text(F.col("page_links_updated")).alias("page_links_updated"),
        "page_latest", "page_len", "page_content_model", "page_lang", "page_hash",
    )


@query(
    with_(PL)
    + """SELECT wiki_code, year_month, 'outbound' AS direction, pl_from, pl_from_namespace, pl_target_id FROM pl
    UNION ALL SELECT wiki_code, year_month, 'inbound', pl_target_id, pl_from_namespace, pl_from FROM pl"""
)
def link_mirror(spark: SparkSession, folder: str) -> DataFrame:
    return graph.mirror_links(_links(spark, folder)).select(
        "wiki_code", "year_month", "direction", "pl_from", "pl_from_namespace", "pl_target_id"
    )


@query(
    with_(PL)
    + """SELECT wiki_code, page_id, direction, count(*) AS n_links FROM (
      SELECT DISTINCT wiki_code, pl_from AS page_id, 'outbound' AS direction, pl_from_namespace, pl_target_id, day FROM pl
      UNION ALL
      SELECT DISTINCT wiki_code, pl_target_id, 'inbound', pl_from_namespace, pl_from, day FROM pl) GROUP BY 1, 2, 3"""
)
def link_degree(spark: SparkSession, folder: str) -> DataFrame:
    return graph.link_degrees(_links(spark, folder))


@query(
    with_(PL, PG)
    + f""", edges AS (SELECT DISTINCT pl_from, pl_from_namespace, pl_target_id, day FROM pl WHERE wiki_code = 'enwiki'),
    n_in AS (SELECT pl_target_id AS page_id, count(*) AS n FROM edges GROUP BY 1),
    n_out AS (SELECT pl_from AS page_id, count(*) AS n FROM edges GROUP BY 1)
    SELECT pg.page_id, page_title AS title, {page_hash("'enwiki'", 'page_title')} AS title_hash,
      sha256('enwiki-' || pg.page_id) AS id_hash,
      coalesce(n_in.n, 0) AS n_in, coalesce(n_out.n, 0) AS n_out
    FROM pg LEFT JOIN n_in ON n_in.page_id = pg.page_id LEFT JOIN n_out ON n_out.page_id = pg.page_id"""
)
def page_crosswalk(spark: SparkSession, folder: str) -> DataFrame:
    counted = graph.with_counts(graph.page_crosswalk(_pages(spark, folder)), graph.link_counts(_links(spark, folder)))
    return counted.select("page_id", "title", "title_hash", "id_hash", "n_in", "n_out")


@query(
    with_(RV)
    + """SELECT wiki_code, sha256(wiki_code || '-' || o_orderkey) AS page_hash, CAST(o_orderkey AS VARCHAR) AS page_id,
      'Order & ' || o_orderkey AS title, CAST(rev_id AS VARCHAR) AS rev_id,
      strftime(stamp, '%Y-%m-%d %H:%M:%S') AS stamp, strftime(stamp, '%Y-%m') AS year_month,
      contributor_id FROM rv WHERE reason IS NULL"""
)
def xml_revisions(spark: SparkSession, folder: str) -> DataFrame:
    return rev.parse_revisions(_export(spark, folder)).select(
        "wiki_code", "page_hash", "page_id", "title", "rev_id",
        stamp_text(F.col("timestamp")).alias("stamp"), "year_month", "contributor_id",
    )


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS page_id, CASE WHEN o_custkey % 2 = 0 THEN 'enwiki' ELSE 'dewiki' END
      AS wiki_code, 'Order & ' || o_orderkey AS title, CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS namespace,
      o_orderstatus = 'P' AS is_redirect, o_orderkey % 3 = 0 AS skipped,
      CAST(1 + o_orderkey % 4 AS INTEGER) AS n_revisions FROM orders"""
)
def xml_pages(spark: SparkSession, folder: str) -> DataFrame:
    return rev.page_rows(_export(spark, folder)).select(
        "page_id", "wiki_code", "title", "namespace", "is_redirect", "skipped", "n_revisions"
    )


@query(
    with_(RV)
    + """SELECT contributor_kind, coalesce(reason, 'kept') AS reason, count(*) AS n,
      count(DISTINCT contributor_id) AS contributors FROM rv GROUP BY 1, 2"""
)
def contributor_kind(spark: SparkSession, folder: str) -> DataFrame:
    return (
        rev.classify_revisions(_export(spark, folder))
        .groupBy("contributor_kind", F.coalesce("reason", F.lit("kept")).alias("reason"))
        .agg(F.count("*").alias("n"), F.countDistinct("contributor_id").alias("contributors"))
    )


@query(
    with_(RV)
    + """, p AS (SELECT CASE WHEN o_custkey % 2 = 0 THEN 'enwiki' ELSE 'dewiki' END AS wiki_code, count(*) AS pages,
      CAST(count_if(o_orderkey % 3 = 0) AS BIGINT) AS skipped_pages FROM orders GROUP BY 1),
    r AS (SELECT wiki_code, count_if(reason IS NULL) AS revisions,
      count_if(reason IS NOT NULL) AS skipped_revisions FROM rv GROUP BY 1)
    SELECT p.wiki_code, pages, skipped_pages, CAST(revisions AS BIGINT) AS revisions,
      CAST(skipped_revisions AS BIGINT) AS skipped_revisions FROM p JOIN r ON p.wiki_code = r.wiki_code"""
)
def revision_stats(spark: SparkSession, folder: str) -> DataFrame:
    return rev.revision_stats(_export(spark, folder))


@query(
    with_(RV)
    + "SELECT wiki_code, strftime(max(stamp), '%Y-%m-%d %H:%M:%S') AS last_updated FROM rv WHERE reason IS NULL GROUP BY 1"
)
def last_updated(spark: SparkSession, folder: str) -> DataFrame:
    newest = rev.last_updated(rev.parse_revisions(_export(spark, folder)))
    return newest.select("wiki_code", stamp_text(F.col("last_updated")).alias("last_updated"))


@query(
    with_(RV)
    + """SELECT page_hash, rev_id, stamp, contributor_kind FROM (
      SELECT sha256(wiki_code || '-' || o_orderkey) AS page_hash, CAST(rev_id AS VARCHAR) AS rev_id,
        strftime(stamp, '%Y-%m-%d %H:%M:%S') AS stamp, contributor_kind,
        row_number() OVER (PARTITION BY wiki_code, o_orderkey ORDER BY rv.stamp DESC, rv.rev_id DESC) AS rn
      FROM rv WHERE reason IS NULL) WHERE rn = 1"""
)
def latest_revision(spark: SparkSession, folder: str) -> DataFrame:
    newest = rev.latest_revisions(_export(spark, folder))
    return newest.select("page_hash", "rev_id", stamp_text(F.col("timestamp")).alias("stamp"), "contributor_kind")
