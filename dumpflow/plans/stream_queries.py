"""Streaming queries: each drains what is there now into a table and reads it back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dumpflow.functions.times import stamp_text
from dumpflow.operators.pages import FACT_COLUMNS
from dumpflow.plans import adapters
from dumpflow.plans.page_queries import event_page_facts
from dumpflow.plans.registry import CHECKS, query
from dumpflow.session import cut_lineage, fresh_folder
from dumpflow.sinks.messages import send_batch, send_stream
from dumpflow.sources.topic_log import use_topic_log
from dumpflow.sources.topics import decode_json, of_topics, read_topic, union_topics
from dumpflow.streaming.dedup import drop_repeats
from dumpflow.streaming.kept import create_kept, keep_stream, read_kept
from dumpflow.streaming.unify import drain_and_read, unify_topics

TOPICS = ("clickstream_topic", "pageview_topic", "wikidocument_topic")

_TOPIC = """CASE event_type WHEN 'click' THEN 'clickstream_topic' WHEN 'view' THEN 'pageview_topic'
      ELSE 'wikidocument_topic' END"""


@query(f"SELECT {_TOPIC} AS topic, count(*) AS n, CAST(count_if(event_id % 50 = 0) AS BIGINT) AS cut_short FROM events GROUP BY 1")
def topic_union(spark: SparkSession, folder: str) -> DataFrame:
    messages = adapters.event_messages(spark, folder)
    topics = union_topics([messages.where(F.col("topic") == topic) for topic in TOPICS])
    return topics.groupBy("topic").agg(
        F.count("*").alias("n"), F.count_if(~F.col("value").endswith("}")).alias("cut_short")
    )


@query(
    f"""SELECT topic, CASE WHEN bad THEN NULL ELSE user_id END AS id, CASE WHEN bad THEN NULL ELSE event_id END AS event_id,
      CASE WHEN bad THEN NULL ELSE event_type END AS event_type, bad AS is_malformed,
      NOT bad AND c_custkey IS NOT NULL AS found, CASE WHEN bad THEN NULL ELSE c_mktsegment END AS segment
    FROM (SELECT *, {_TOPIC} AS topic, event_id % 50 = 0 AS bad FROM events)
    LEFT JOIN customer ON user_id = c_custkey AND c_acctbal > 0"""
)
def stream_unified(spark: SparkSession, folder: str) -> DataFrame:
    customers = adapters.table(spark, folder, "customer").where("c_acctbal > 0").select(
        F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment")
    )
    # One scan serves all topics, as each message says its own.
    messages = of_topics(adapters.event_messages(spark, folder, streaming=True), TOPICS)
    unified = unify_topics([messages], adapters.MESSAGE_SCHEMA, customers, on="id")
    drained = drain_and_read(unified, fresh_folder(spark, "unified"))
    return drained.select("topic", "id", "event_id", "event_type", "is_malformed", "found", "segment")


@query("SELECT event_id, event_type, user_id FROM events")
def stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every event is delivered twice; one of each is kept."""
    schema = "event_id bigint, user_id bigint, event_type string"

    def delivery() -> DataFrame:
        return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)

    once = drop_repeats(delivery().unionByName(delivery()), ["event_id"], within="1 hour")
    return drain_and_read(once, fresh_folder(spark, "dedup"))


@query(CHECKS["page_fold"])
def stream_kept_fold(spark: SparkSession, folder: str) -> DataFrame:
    """The page fold kept current by a stream of two micro-batches, read as it stands after them.

    The second run goes on from the checkpoint of the first, and repeats its last days.
    """
    root = fresh_folder(spark, "kept-fold")
    incoming, kept = f"{root}/incoming", f"{root}/kept"
    # Read by both deliveries, so the events are rendered and parsed once and kept.
    facts = cut_lineage(event_page_facts(spark, folder).select(*FACT_COLUMNS))
    create_kept(spark, kept, buckets=16)
    for part in (F.col("seen_at") < "2024-01-16", F.col("seen_at") >= "2024-01-14"):
        facts.where(part | (F.col("kind") == "clickstreams_in")).write.mode("append").parquet(incoming)
        stream = spark.readStream.schema(facts.schema).parquet(incoming)
        keep_stream(stream, kept, f"{root}/checkpoint").awaitTermination()
    pages = read_kept(spark, kept)
    return pages.withColumns({c: stamp_text(F.col(c)) for c in ("created_at", "last_updated")})


@query(
    f"""SELECT topic, count(*) AS n, CAST(sum(CASE WHEN bad THEN 0 ELSE event_id END) AS BIGINT) AS event_ids,
      CAST(count_if(bad) AS BIGINT) AS malformed, count(*) AS n_offsets, count(*) AS end_offset
    FROM (SELECT event_id, {_TOPIC} || '_copy' AS topic, event_id % 50 = 0 AS bad FROM events) GROUP BY 1"""
)
def stream_topic_log(spark: SparkSession, folder: str) -> DataFrame:
    """Messages sent to a topic log in two batches, each carried by a stream per run from its topics to other ones.

    The second run goes on from the offsets of the first; the copies are read as a batch.
    """
    use_topic_log(spark)
    root = fresh_folder(spark, "topic-log")
    first, copies = {"path": f"{root}/first"}, {"path": f"{root}/copies", "writer": "copies"}
    messages = adapters.event_messages(spark, folder).select("topic", F.lit(None).cast("string").alias("key"), "value")
    early = F.pmod(F.xxhash64("value"), F.lit(3)) == 0
    for part in (messages.where(early), messages.where(~early)):
        send_batch(part, first, sink="topic_log")
        streams = [read_topic(spark, topic, first, source="topic_log") for topic in TOPICS]
        carried = union_topics(streams).select(F.concat("topic", F.lit("_copy")).alias("topic"), F.col("topic").alias("key"), "value")
        send_stream(carried, copies, f"{root}/checkpoint", sink="topic_log", availableNow=True).awaitTermination()
    read = spark.read.format("topic_log").options(**copies).load()
    decoded = decode_json(read, adapters.MESSAGE_SCHEMA).select("topic", "offset", "is_malformed", "event.event_id")
    return decoded.groupBy("topic").agg(
        F.count("*").alias("n"), F.sum(F.coalesce("event_id", F.lit(0))).cast("bigint").alias("event_ids"),
        F.count_if("is_malformed").alias("malformed"), F.count_distinct("offset").alias("n_offsets"), (F.max("offset") + 1).alias("end_offset"))
