"""Envelope, routing, key and validation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dumpflow.operators import records as rec
from dumpflow.operators.quality import missing_field
from dumpflow.operators.stats import job_stats as totals_per_job
from dumpflow.operators.stats import success_totals
from dumpflow.plans import adapters
from dumpflow.plans.check_sql import CS, PV, page_hash, with_
from dumpflow.plans.registry import query
from dumpflow.sources.clickstream import clickstream_records, parse_clickstream
from dumpflow.sources.pageviews import pageview_records, parse_pageviews
from dumpflow.sources.topics import decode_json, open_messages

_PV_HASH = page_hash("domain", "coalesce(title, '')")
_CS_HASH = page_hash("wiki_code", "target")
_PV_STRUCT = (
    """'{"access_type":' || access_code || ',"user_type":' || agent_code || ',"date":"' || day """
    """|| '","views":' || views || '}'"""
)
_CS_STRUCT = (
    """'{"target_page":"' || target || '","date":"' || day || '","clicks":' || clicks """
    """|| ',"navigation_type":"' || type || '","referer_category":"' || category || '"}'"""
)


def _views(spark: SparkSession, folder: str) -> DataFrame:
    return pageview_records(parse_pageviews(adapters.pageview_lines(spark, folder)))


def _clicks(spark: SparkSession, folder: str) -> DataFrame:
    return clickstream_records(parse_clickstream(adapters.clickstream_lines(spark, folder)))


@query(
    with_(PV)
    + f"""SELECT {_PV_HASH} AS page_hash, year_month, domain AS wiki_code, title, {_PV_STRUCT} AS tuple_struct
    FROM pv WHERE reason IS NULL"""
)
def envelope_build(spark: SparkSession, folder: str) -> DataFrame:
    return _views(spark, folder).withColumn("tuple_struct", rec.struct_json(F.col("tuple_struct")))


@query(
    with_(CS)
    + f"""SELECT 'clickstream_topic' AS topic, {_CS_HASH} || '|' || year_month AS key,
      '{{"page_hash":"' || {_CS_HASH} || '","year_month":"' || year_month || '","wiki_code":"' || wiki_code
        || '","tuple_struct":' || {_CS_STRUCT} || '}}' AS value FROM cs WHERE kept"""
)
def kafka_rows(spark: SparkSession, folder: str) -> DataFrame:
    return rec.message_rows(_clicks(spark, folder), "clickstream_topic", "ClickStream")


@query(
    with_(PV, CS)
    + """SELECT 'pageview' AS kind, access_code || '|' || agent_code || '|' || year_month AS key, count(*) AS n
      FROM pv WHERE reason IS NULL GROUP BY 1, 2
    UNION ALL SELECT 'clickstream', year_month || '|' || target, count(*) FROM cs WHERE kept GROUP BY 1, 2"""
)
def composite_key(spark: SparkSession, folder: str) -> DataFrame:
    views, clicks = _views(spark, folder), _clicks(spark, folder)
    keys = views.select(F.lit("pageview").alias("kind"), rec.pageview_composite_key(views).alias("key")).unionByName(
        clicks.select(F.lit("clickstream").alias("kind"), rec.clickstream_composite_key(clicks).alias("key"))
    )
    return keys.groupBy("kind", "key").agg(F.count("*").alias("n"))


_ROUTE = """CASE event_id % 9 WHEN 0 THEN 'RevisionData' WHEN 1 THEN 'WikiDocument' WHEN 2 THEN 'TitleIdMapping'
      WHEN 3 THEN 'OutboundPageLinks' WHEN 4 THEN 'InboundPageLinks' WHEN 5 THEN 'RevisionData'
      WHEN 6 THEN 'PageView' WHEN 7 THEN 'ClickStream'
      ELSE ['PageInfo', 'WikiDocument', 'Other'][1 + event_id % 3] END"""


@query(f"SELECT event_id, {_ROUTE} AS schema_name FROM events")
def schema_route(spark: SparkSession, folder: str) -> DataFrame:
    return rec.route_schema(open_messages(adapters.typed_messages(spark, folder))).select("event_id", "schema_name")


@query(
    f"""SELECT event_id, CASE r WHEN 'OutboundPageLinks' THEN ym || '|' || user_id
      WHEN 'InboundPageLinks' THEN ym || '|' || event_id
      WHEN 'WikiDocument' THEN 'h' || user_id || '|' || CASE WHEN event_id % 9 = 1 THEN 'enwiki' ELSE 'None' END || '|' || ym
      WHEN 'Other' THEN NULL ELSE 'h' || user_id || '|' || ym END AS key
    FROM (SELECT *, strftime(ts, '%Y-%m') AS ym, {_ROUTE} AS r FROM events)"""
)
def partition_key(spark: SparkSession, folder: str) -> DataFrame:
    routed = rec.route_schema(open_messages(adapters.typed_messages(spark, folder)))
    return routed.select("event_id", rec.partition_key(F.col("schema_name")).alias("key"))


@query(
    """SELECT event_id, 'metadata.wiki_code' AS name, 'enwiki' AS value FROM events WHERE event_id % 9 = 1
    UNION ALL SELECT event_id, 'metadata._schema_name', 'RevisionData' FROM events WHERE event_id % 9 = 0
    UNION ALL SELECT event_id, 'metadata.direction', 'inbound' FROM events WHERE event_id % 9 = 4"""
)
def metadata_flatten(spark: SparkSession, folder: str) -> DataFrame:
    messages = open_messages(adapters.typed_messages(spark, folder))
    return messages.select("event_id", F.explode(rec.metadata_map()).alias("name", "value"))


@query(
    """SELECT record_type, reason, count(*) AS n FROM (SELECT record_type, coalesce(CASE record_type
      WHEN 'pageview' THEN CASE WHEN event_id % 5 = 0 THEN 'page_hash' WHEN event_id % 4 = 0 THEN 'access_type'
        WHEN event_id % 3 = 0 THEN 'date' END
      WHEN 'revision' THEN CASE WHEN event_id % 6 = 0 THEN 'page_id' END
      WHEN 'clickstream' THEN CASE WHEN event_id % 4 = 0 THEN 'target_page' WHEN event_id % 5 = 0 THEN 'tuple_struct' END
      WHEN 'outbound_link' THEN CASE WHEN event_id % 5 = 0 THEN 'tuple_struct' WHEN event_id % 8 = 0 THEN 'pl_from' END
      WHEN 'inbound_link' THEN CASE WHEN event_id % 5 = 0 THEN 'tuple_struct' WHEN event_id % 9 = 0 THEN 'pl_target_id' END
      ELSE CASE WHEN event_id % 5 = 0 THEN 'page_hash' END END, 'kept') AS reason
    FROM (SELECT *, ['pageview', 'revision', 'clickstream', 'outbound_link', 'inbound_link', 'page_info',
      'document'][1 + event_id % 7] AS record_type FROM events)) GROUP BY 1, 2"""
)
def required_fields(spark: SparkSession, folder: str) -> DataFrame:
    rows = adapters.table(spark, folder, "events").selectExpr(
        "elt(1 + event_id % 7, 'pageview', 'revision', 'clickstream', 'outbound_link', 'inbound_link', "
        "  'page_info', 'document') AS record_type",
        "if(event_id % 5 = 0, NULL, concat('h', user_id)) AS page_hash",
        "if(event_id % 4 = 0, NULL, 1) AS access_type",
        "0 AS user_type",
        "if(event_id % 3 = 0, 'soon', date_format(ts, 'yyyy-MM-dd')) AS date",
        "value AS views",
        "if(event_id % 6 = 0, '', cast(user_id AS string)) AS page_id",
        "if(event_id % 4 = 0, NULL, 'Page') AS target_page",
        "if(event_id % 5 = 0, NULL, '{}') AS tuple_struct",
        "if(event_id % 8 = 0, NULL, user_id) AS pl_from",
        "if(event_id % 9 = 0, NULL, user_id) AS pl_target_id",
    )
    fields = {c: F.col(c) for c in rows.columns if c != "record_type"}
    checked = rows.select("record_type", missing_field(F.col("record_type"), fields).alias("reason"))
    return checked.groupBy("record_type", F.coalesce("reason", F.lit("kept")).alias("reason")).agg(
        F.count("*").alias("n")
    )


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, false AS is_malformed FROM events")
def json_decode(spark: SparkSession, folder: str) -> DataFrame:
    events = adapters.table(spark, folder, "events").select("event_id", "props")
    decoded = decode_json(events, "k bigint", text="props", into="p")
    return decoded.select("event_id", F.col("p.k").alias("k"), "is_malformed")


@query(
    "SELECT event_type, count(*) AS attempted, CAST(count_if(value >= 100) AS BIGINT) AS success FROM events GROUP BY 1"
)
def download_stats(spark: SparkSession, folder: str) -> DataFrame:
    log = adapters.table(spark, folder, "events")
    return success_totals(log, "event_type", F.col("value") >= 100)


@query(
    """SELECT user_id, documents, CAST(ceil(documents / 100.0) AS BIGINT) AS batches, errors,
      round(s, 2) AS duration, round(documents / nullif(s, 0), 4) AS docs_per_second
    FROM (SELECT user_id, count(*) AS documents, CAST(count_if(event_type = 'error') AS BIGINT) AS errors,
      (epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0 AS s FROM events GROUP BY 1)"""
)
def job_stats(spark: SparkSession, folder: str) -> DataFrame:
    log = adapters.table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return totals_per_job(log, "user_id", F.col("event_type") == "error", F.col("ts"))
