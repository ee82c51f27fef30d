"""Page document queries: folds, titles, months, upserts, repeats and lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dumpflow import fixed_values as fx
from dumpflow.functions.ids import content_hash, normalize_wiki_code
from dumpflow.functions.times import file_date, stamp_text
from dumpflow.operators import facts as facts_of
from dumpflow.operators import lookups
from dumpflow.operators import pages as docs
from dumpflow.operators.links import INBOUND, OUTBOUND, join_as_of, link_counts, mirror_links, title_spans
from dumpflow.operators.links import page_crosswalk as crosswalk_of
from dumpflow.operators.records import struct_json
from dumpflow.plans import adapters
from dumpflow.plans.check_sql import CS, PG, PL, PV, RV, page_hash, with_
from dumpflow.plans.registry import query
from dumpflow.session import cut_lineage, fresh_folder
from dumpflow.sinks.tables import append_batch, read_facts
from dumpflow.sources.clickstream import parse_clickstream
from dumpflow.sources.lines import concat_lines
from dumpflow.sources.pageviews import parse_pageviews
from dumpflow.sources.revisions import pages_from_text, parse_revisions, revision_records
from dumpflow.sources.sqldump import PAGE, PAGELINKS, parse_dump


def view_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Pageview and title facts, keyed like the page table: by dump code and title."""
    return facts_of.view_facts(parse_pageviews(adapters.pageview_lines(spark, folder)))


def click_facts(spark: SparkSession, folder: str) -> DataFrame:
    return facts_of.click_facts(parse_clickstream(adapters.clickstream_lines(spark, folder)))


def event_page_facts(spark: SparkSession, folder: str) -> DataFrame:
    return view_facts(spark, folder).unionByName(click_facts(spark, folder))


def _as_text(pages: DataFrame) -> DataFrame:
    times = {c: stamp_text(F.col(c)) for c in ("created_at", "last_updated") if c in pages.columns}
    return pages.withColumns(times)


# Elements as the fold sees them: equal payloads of one page and kind are one element.
_VIEW_JSON = (
    """'{"access_type":' || access_code || ',"user_type":' || agent_code || ',"date":"' || day """
    """|| '","views":' || views || '}'"""
)
_CLICK_JSON = (
    """'{"target_page":"' || target || '","date":"' || day || '","clicks":' || clicks """
    """|| ',"navigation_type":"' || type || '","referer_category":"' || category || '"}'"""
)
_FACTS = f"""facts AS (
  SELECT wiki_code, {page_hash('wiki_code', 'title')} AS page_hash, year_month, 'pageviews' AS kind,
    {_VIEW_JSON} AS element, day FROM pv WHERE reason IS NULL AND title IS NOT NULL
  UNION ALL SELECT wiki_code, {page_hash('wiki_code', 'title')}, year_month, 'historical_titles', title, day
    FROM pv WHERE reason IS NULL AND title IS NOT NULL
  UNION ALL SELECT wiki_code, {page_hash('wiki_code', 'target')}, year_month, 'clickstreams_in', {_CLICK_JSON}, day
    FROM cs WHERE kept)"""


def _sizes_sql(kinds: tuple[str, ...] = fx.ELEMENT_KINDS) -> str:
    return ", ".join(f"count(DISTINCT CASE WHEN kind = '{k}' THEN element END) AS n_{k}" for k in kinds)


@query(
    with_(PV, CS, _FACTS)
    + f"""SELECT wiki_code, page_hash, {_sizes_sql()}, CAST(min(day) AS VARCHAR) || ' 00:00:00' AS created_at,
      CAST(max(day) AS VARCHAR) || ' 00:00:00' AS last_updated,
      max(CASE WHEN kind = 'historical_titles' THEN element END) AS current_title
    FROM facts GROUP BY 1, 2"""
)
def page_fold(spark: SparkSession, folder: str) -> DataFrame:
    return _as_text(docs.page_fold(event_page_facts(spark, folder)))


@query(
    with_(PV, CS, _FACTS)
    + f"""SELECT wiki_code, page_hash, 'month' AS grain, year_month, {_sizes_sql()},
      CAST(min(day) AS VARCHAR) || ' 00:00:00' AS created_at, CAST(max(day) AS VARCHAR) || ' 00:00:00' AS last_updated
    FROM facts GROUP BY 1, 2, 4
    UNION ALL SELECT wiki_code, page_hash, 'total', NULL, {_sizes_sql()},
      CAST(min(day) AS VARCHAR) || ' 00:00:00', CAST(max(day) AS VARCHAR) || ' 00:00:00'
    FROM facts GROUP BY 1, 2"""
)
def monthly_buckets(spark: SparkSession, folder: str) -> DataFrame:
    return _as_text(docs.monthly_and_total(event_page_facts(spark, folder)))


@query(
    with_(PV, CS, _FACTS)
    + """, d AS (SELECT wiki_code, page_hash, kind, element, min(day) AS first, max(day) AS last FROM facts GROUP BY 1, 2, 3, 4),
    s AS (SELECT wiki_code, page_hash, count(*) AS n, min(first) AS created, max(last) AS updated FROM d GROUP BY 1, 2),
    e AS (SELECT *, CASE WHEN n <= 15 THEN '' WHEN n <= 240 THEN left(md5(element), 1) WHEN n <= 3840 THEN left(md5(element), 2)
        ELSE left(md5(element), 3) END AS bucket, CASE WHEN n <= 15 THEN 1 WHEN n <= 240 THEN 16 WHEN n <= 3840 THEN 256 ELSE 4096 END AS n_buckets
      FROM d JOIN s USING (wiki_code, page_hash))
    SELECT wiki_code, page_hash, bucket, CAST(any_value(n_buckets) AS BIGINT) AS n_buckets,
      coalesce(string_agg(CASE WHEN kind = 'pageviews' THEN element END, ';' ORDER BY element), '') AS pageviews,
      coalesce(string_agg(CASE WHEN kind = 'clickstreams_in' THEN element END, ';' ORDER BY element), '') AS clickstreams_in,
      coalesce(string_agg(CASE WHEN kind = 'historical_titles' THEN element END, ';' ORDER BY element), '') AS historical_titles,
      CAST(min(created) AS VARCHAR) || ' 00:00:00' AS created_at, CAST(max(updated) AS VARCHAR) || ' 00:00:00' AS last_updated
    FROM e GROUP BY 1, 2, 3"""
)
def page_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Nested documents, a row per page and bucket of its elements; larger pages have more buckets."""
    elements = cut_lineage(docs.page_elements(event_page_facts(spark, folder)))
    documents = docs.page_documents_by_size(elements, per_row=30)
    return _as_text(documents.select(
        "wiki_code", "page_hash", "bucket", "n_buckets", "created_at", "last_updated",
        *[F.array_join(kind, ";").alias(kind) for kind in (fx.PAGEVIEWS, fx.CLICKS_IN, fx.TITLES)],
    ))


@query(
    with_(PV, CS, _FACTS)
    + """SELECT kind, year_month, count(*) AS n FROM (
      SELECT DISTINCT wiki_code, page_hash, year_month, kind, element FROM facts) GROUP BY 1, 2"""
)
def fact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    facts = event_page_facts(spark, folder)
    # The same facts delivered twice. Equal ones are one element of a month, seen once or twice.
    once = docs.set_add(docs.drop_equal_facts(facts.unionByName(facts)), *docs.PAGE_KEY, "year_month")
    return once.groupBy("kind", "year_month").agg(F.count("*").alias("n"))


@query(
    """SELECT sha256('enwiki-' || user_id) AS page_hash, arg_max(event_type || '_' || user_id,
      (ts, event_type || '_' || user_id)) AS current_title, count(DISTINCT event_type) AS n_historical_titles
    FROM events GROUP BY user_id"""
)
def current_title(spark: SparkSession, folder: str) -> DataFrame:
    records = adapters.table(spark, folder, "events").select(
        F.lit("enwiki").alias("wiki_code"),
        content_hash(F.lit("enwiki"), F.col("user_id")).alias("page_hash"),
        F.date_format("ts", "yyyy-MM").alias("year_month"),
        F.concat_ws("_", "event_type", "user_id").alias("title"),
        F.col("ts").cast("timestamp").alias("ts"),
    )
    folded = docs.page_fold(docs.page_facts(records, {fx.TITLES: F.col("title")}, seen_at=F.col("ts")))
    return folded.select("page_hash", "current_title", "n_historical_titles")


@query(
    """SELECT sha256('enwiki-' || user_id) AS page_hash, arg_max(event_type || '_' || user_id,
      (ts, event_type || '_' || user_id)) AS current_title, count(DISTINCT event_type) AS n_historical_titles,
      epoch_us(min(ts)) AS created_at, epoch_us(max(ts)) AS last_updated
    FROM events GROUP BY user_id"""
)
def stored_fold(spark: SparkSession, folder: str) -> DataFrame:
    """Titles stored in two batches, the second of which repeats the first, then read and folded."""
    records = adapters.table(spark, folder, "events").select(
        F.lit("enwiki").alias("wiki_code"),
        content_hash(F.lit("enwiki"), F.col("user_id")).alias("page_hash"),
        F.date_format("ts", "yyyy-MM").alias("year_month"),
        F.concat_ws("_", "event_type", "user_id").alias("title"),
        F.col("ts").cast("timestamp").alias("ts"),
    )
    facts = docs.page_facts(records, {fx.TITLES: F.col("title")}, seen_at=F.col("ts"))
    path = fresh_folder(spark, "stored-facts")
    append_batch(facts.where("seen_at < TIMESTAMP '2024-01-16 00:00:00'"), path, "first")
    append_batch(facts, path, "second")
    return docs.page_fold(read_facts(spark, path)).select(
        "page_hash", "current_title", "n_historical_titles",
        F.unix_micros("created_at").alias("created_at"), F.unix_micros("last_updated").alias("last_updated"),
    )


@query(
    with_(PG, PL, RV, PV, CS)
    + f""", known AS (SELECT 'enwiki' AS wiki_code, page_id, page_title, {page_hash("'enwiki'", 'page_title')} AS page_hash FROM pg),
    links AS (
      SELECT wiki_code, pl_from AS id, 'pagelinks_outbound' AS kind, concat_ws(',', pl_from, pl_from_namespace, pl_target_id, day) AS element FROM pl
      UNION ALL SELECT wiki_code, pl_target_id, 'pagelinks_inbound', concat_ws(',', pl_from, pl_from_namespace, pl_target_id, day) FROM pl
      UNION ALL SELECT wiki_code, o_orderkey, 'revisions', CAST(rev_id AS VARCHAR) FROM rv WHERE reason IS NULL),
    e AS (
      SELECT l.wiki_code, coalesce(k.page_hash, sha256(l.wiki_code || '-' || l.id)) AS page_hash, kind, element, k.page_hash IS NOT NULL AS known
        FROM links l LEFT JOIN known k ON k.page_id = l.id AND k.wiki_code = l.wiki_code
      UNION ALL SELECT wiki_code, page_hash, 'historical_titles', page_title, true FROM known
      UNION ALL SELECT wiki_code, {page_hash('wiki_code', 'title')}, 'pageviews', concat_ws(',', access_code, agent_code, day, views), true
        FROM pv WHERE reason IS NULL AND title IS NOT NULL
      UNION ALL SELECT wiki_code, {page_hash('wiki_code', 'title')}, 'historical_titles', title, false
        FROM pv WHERE reason IS NULL AND title IS NOT NULL
      UNION ALL SELECT wiki_code, {page_hash('wiki_code', 'target')}, 'clickstreams_in', {_CLICK_JSON}, true FROM cs WHERE kept)
    SELECT wiki_code, page_hash, {_sizes_sql()}, bool_or(known) AS is_known FROM e GROUP BY 1, 2"""
)
def page_fold_all(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of all wikis over all record types under one key.

    Links and revisions of pages that the page table lacks stay under the hash of
    their id; `is_known` tells these pages apart.
    """
    # Read for the titles and for the crosswalk, so the dump is parsed once and kept.
    page_rows = cut_lineage(
        parse_dump(adapters.page_statements(spark, folder), PAGE).select(
            "wiki_code", "page_id", "page_title", "year_month", "timestamp", "page_touched"
        )
    )
    revisions = parse_revisions(pages_from_text(adapters.revision_pages(spark, folder)))
    facts = (
        event_page_facts(spark, folder)
        .unionByName(facts_of.revision_facts(revisions))
        .unionByName(facts_of.title_facts(page_rows))
    )
    links = link_counts(parse_dump(adapters.pagelink_statements(spark, folder), PAGELINKS))
    return facts_of.sizes_by_title(facts, links, crosswalk_of(page_rows))


@query(
    with_(PG, PL, RV, PV)
    + f""", known AS (SELECT page_id, page_title, {page_hash("'enwiki'", 'page_title')} AS page_hash FROM pg),
    e AS (
      SELECT k.page_hash, 'pagelinks_outbound' AS kind, concat_ws(',', pl_from, pl_from_namespace, pl_target_id, day) AS element
        FROM pl JOIN known k ON k.page_id = pl_from WHERE wiki_code = 'enwiki'
      UNION SELECT k.page_hash, 'pagelinks_inbound', concat_ws(',', pl_from, pl_from_namespace, pl_target_id, day)
        FROM pl JOIN known k ON k.page_id = pl_target_id WHERE wiki_code = 'enwiki'
      UNION SELECT k.page_hash, 'revisions', CAST(rev_id AS VARCHAR)
        FROM rv JOIN known k ON k.page_id = o_orderkey WHERE wiki_code = 'enwiki' AND reason IS NULL
      UNION SELECT page_hash, 'historical_titles', page_title FROM known
      UNION SELECT {page_hash('wiki_code', 'title')}, 'pageviews', concat_ws(',', access_code, agent_code, day, views)
        FROM pv WHERE wiki_code = 'enwiki' AND reason IS NULL AND title IS NOT NULL
      UNION SELECT {page_hash('wiki_code', 'title')}, 'historical_titles', title
        FROM pv WHERE wiki_code = 'enwiki' AND reason IS NULL AND title IS NOT NULL)
    SELECT page_hash, {_sizes_sql(('pageviews', 'revisions', 'pagelinks_inbound', 'pagelinks_outbound',
                                   'historical_titles'))} FROM e GROUP BY 1"""
)
def page_fold_crosswalk(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of one wiki over all record types, brought to one key by the crosswalk.

    Links are keyed by page id and revisions by a hash of it; both are replaced by
    the page's title hash. Equal links are dropped before that join.
    """
    # Read by both joins and for the titles, so the dump is parsed once and kept.
    page_rows = cut_lineage(
        parse_dump(adapters.page_statements(spark, folder), PAGE).select(
            "wiki_code", "page_id", "page_title", "page_hash", "year_month", "timestamp", "page_touched"
        )
    )
    crosswalk = crosswalk_of(page_rows)

    edges = parse_dump(adapters.pagelink_statements(spark, folder), PAGELINKS).where("wiki_code = 'enwiki'").distinct()
    links = lookups.lookup_join(
        mirror_links(edges).withColumn("page_id", F.col("pl_from")),
        crosswalk.select("wiki_code", "page_id", F.col("title_hash").alias("page_hash")),
        ["wiki_code", "page_id"], "inner",
    )
    link = struct_json(F.struct("pl_from", "pl_from_namespace", "pl_target_id", "timestamp"))
    link_elements = {
        fx.LINKS_OUT: F.when(F.col("direction") == OUTBOUND, link),
        fx.LINKS_IN: F.when(F.col("direction") == INBOUND, link),
    }

    parsed = parse_revisions(pages_from_text(adapters.revision_pages(spark, folder))).where("wiki_code = 'enwiki'")
    revisions = lookups.lookup_join(
        revision_records(parsed).withColumnRenamed("page_hash", "id_hash"),
        crosswalk.select("wiki_code", "id_hash", F.col("title_hash").alias("page_hash")),
        ["wiki_code", "id_hash"], "inner",
    )
    facts = (
        view_facts(spark, folder).where("wiki_code = 'enwiki'")
        .unionByName(docs.page_facts(links, link_elements, seen_at=F.col("timestamp")))
        .unionByName(docs.page_facts(revisions, {fx.REVISIONS: struct_json(F.col("tuple_struct"))},
                                     seen_at=F.col("tuple_struct.timestamp")))
        .unionByName(docs.page_facts(page_rows, {fx.TITLES: F.col("page_title")}, seen_at=F.col("timestamp")))
    )
    folded = docs.fold_pages(docs.page_elements(facts))
    return folded.select(
        "page_hash", "n_pageviews", "n_revisions", "n_pagelinks_inbound", "n_pagelinks_outbound", "n_historical_titles"
    )


@query(
    with_(PG)
    + """SELECT sha256('enwiki-' || page_id) AS page_hash, page_id,
      CASE WHEN page_id % 4 = 0 THEN 'Moved_' || page_id ELSE page_title END AS current_title,
      CAST(CASE WHEN page_id % 4 = 0 THEN 2 ELSE 1 END AS BIGINT) AS n_historical_titles,
      CAST(page_namespace AS VARCHAR) AS page_namespace,
      CASE WHEN page_id % 4 = 0 THEN '1' ELSE CAST(page_is_redirect AS VARCHAR) END AS page_is_redirect,
      '2024-05-01 00:00:00' AS created_at, '2024-06-01 00:00:00' AS last_updated FROM pg"""
)
def page_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """Two dumps of the page table a month apart, with some pages moved between them.

    Pages are keyed by the hash of their id, which a move does not change.
    """
    dumps = parse_dump(
        concat_lines(
            adapters.page_statements(spark, folder),
            adapters.page_statements(spark, folder, day="20240601", moved=True),
        ),
        PAGE,
    ).withColumn("page_hash", content_hash(F.col("wiki_code"), F.col("page_id")))
    facts = docs.page_facts(dumps, {fx.TITLES: F.col("page_title")}, seen_at=F.col("timestamp"))
    fields = ["page_namespace", "page_title", "page_is_redirect", "page_touched"]
    summaries = docs.page_summaries(facts, docs.latest_metadata(dumps, fields, at=F.col("timestamp")))
    return summaries.select(
        "page_hash", "page_id", "current_title", "n_historical_titles",
        F.col("metadata")["page_namespace"].alias("page_namespace"),
        F.col("metadata")["page_is_redirect"].alias("page_is_redirect"),
        stamp_text(F.col("created_at")).alias("created_at"),
        stamp_text(F.col("last_updated")).alias("last_updated"),
    )


@query(
    """WITH o AS (SELECT DISTINCT user_id FROM events WHERE ts < TIMESTAMP '2024-01-16' AND event_type = 'click'),
    n AS (SELECT DISTINCT user_id FROM events WHERE ts >= TIMESTAMP '2024-01-16')
    SELECT n.user_id, CASE WHEN o.user_id IS NULL THEN 'insert' ELSE 'update' END AS action
    FROM n LEFT JOIN o ON o.user_id = n.user_id"""
)
def upsert_split(spark: SparkSession, folder: str) -> DataFrame:
    events = adapters.table(spark, folder, "events")
    stored = events.where("ts < TIMESTAMP_NTZ '2024-01-16' AND event_type = 'click'")
    incoming = events.where("ts >= TIMESTAMP_NTZ '2024-01-16'")
    return lookups.upsert_split(stored, incoming, ["user_id"])


@query(
    """SELECT event_id, c_custkey IS NOT NULL AS found, c_mktsegment AS segment
    FROM events LEFT JOIN customer ON user_id = c_custkey AND c_acctbal > 0"""
)
def event_lookup(spark: SparkSession, folder: str) -> DataFrame:
    customers = adapters.table(spark, folder, "customer").where("c_acctbal > 0").select(
        F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment")
    )
    events = adapters.table(spark, folder, "events").select("event_id", "user_id")
    return lookups.lookup_flag(events, customers, "user_id").select("event_id", "found", "segment")


_TITLE_AFTER = "CASE WHEN page_id % 2 = 0 THEN 'Page_' || (page_id + CASE WHEN page_id % 4 = 0 THEN 2 ELSE -2 END) ELSE page_title END"


@query(
    with_(PV, PG)
    + f""", early AS (SELECT page_title AS title, min(page_id) AS page_id FROM pg GROUP BY 1),
    late AS (SELECT {_TITLE_AFTER} AS title, min(page_id) AS page_id FROM pg GROUP BY 1),
    v AS (SELECT title, day, views FROM pv WHERE reason IS NULL AND title IS NOT NULL AND wiki_code = 'enwiki')
    SELECT v.title, CASE WHEN day >= DATE '2024-01-20' THEN late.page_id ELSE coalesce(early.page_id, late.page_id) END AS page_id,
      count(*) AS n_lines, CAST(sum(views) AS BIGINT) AS views, CAST(min(day) AS VARCHAR) AS first_day, CAST(max(day) AS VARCHAR) AS last_day
    FROM v LEFT JOIN early USING (title) LEFT JOIN late USING (title) GROUP BY 1, 2"""
)
def crosswalk_asof(spark: SparkSession, folder: str) -> DataFrame:
    """Views per title and the page that held it on the day, by two page dumps between which pages swapped titles."""
    dumps = parse_dump(
        concat_lines(
            adapters.page_statements(spark, folder, day="20240110"),
            adapters.page_statements(spark, folder, day="20240120", swapped=True),
        ),
        PAGE,
    )
    # The spans are read for their bounds and for the join, so the dumps are parsed once.
    spans = cut_lineage(title_spans(dumps.select("wiki_code", "page_id", "page_title", "page_touched", "timestamp")))
    views = parse_pageviews(adapters.pageview_lines(spark, folder)).where("title IS NOT NULL")
    dated = views.select(normalize_wiki_code(F.col("domain")).alias("wiki_code"), "title", "views", file_date(F.col("file_name")).alias("day"))
    held = join_as_of(dated.where("wiki_code = 'enwiki'"), spans, "day")
    return held.groupBy("title", "page_id").agg(
        F.count("*").alias("n_lines"), F.sum("views").alias("views"),
        F.min("day").cast("string").alias("first_day"), F.max("day").cast("string").alias("last_day"))
