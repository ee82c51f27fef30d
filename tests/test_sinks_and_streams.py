"""Writers and streaming jobs on temporary folders."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from dumpflow.operators import pages
from dumpflow.operators.records import message_rows
from dumpflow.session import fresh_folder
from dumpflow.sinks import messages, tables
from dumpflow.sources.topics import of_topics
from dumpflow.streaming import dedup, fold, unify
from tests.test_operators import FOLD_COLUMNS, random_facts, rows


def test_layout_is_partitioned_and_pruned(spark, tmp_path):
    frame = spark.createDataFrame([("pageviews", "enwiki", "2024-01", 1), ("pagelinks", "dewiki", "2024-02", 2)],
                                  "data_type string, wiki_code string, year_month string, v int")
    tables.write_layout(frame, str(tmp_path))
    tables.write_layout(frame, str(tmp_path), processed=True)
    assert os.path.isdir(tmp_path / "raw" / "data_type=pageviews" / "wiki_code=enwiki" / "year_month=2024-01")
    read = spark.read.parquet(str(tmp_path / "processed"))
    assert rows(read.where("wiki_code = 'dewiki'"), "v") == [(2,)]


def test_paths(spark):
    row = spark.sql("SELECT 'enwiki' w, 'pagelinks' t, date'2024-03-05' d, 'f.gz' f, CAST(NULL AS string) n").select(
        tables.layout_path(F.col("t"), F.col("w"), F.lit("20240305"), F.col("f")).alias("a"),
        tables.layout_path(F.col("t"), F.col("n"), F.col("n"), F.col("f")).alias("b"),
        tables.stage_path(F.col("w"), F.col("t"), F.col("d"), True, F.col("f")).alias("c"),
        tables.stage_file_name(F.col("w"), F.col("t"), F.col("d")).alias("e"),
    ).first()
    assert tuple(row) == ("pagelinks/enwiki/20240305/f.gz", "pagelinks/f.gz",
                          "enwiki/pagelinks/2024/03/processed/f.gz", "enwiki_pagelinks_20240305.data")


def test_written_facts_fold_the_same(spark, tmp_path):
    facts = random_facts(spark, 11)
    tables.write_facts(facts, str(tmp_path / "facts"))
    back = spark.read.parquet(str(tmp_path / "facts"))
    assert rows(pages.page_fold(back), *FOLD_COLUMNS) == rows(pages.page_fold(facts), *FOLD_COLUMNS)
    plan = back.where("year_month = '2024-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "year_month" in plan


def test_batches_are_idempotent_and_compact(spark, tmp_path):
    a, b = random_facts(spark, 12), random_facts(spark, 13)
    path = str(tmp_path / "facts")
    tables.append_batch(a, path, 0)
    tables.append_batch(b, path, 1)
    first = tables.read_facts(spark, path).count()
    tables.append_batch(b, path, 1)  # a retry of the same batch
    assert tables.read_facts(spark, path).count() == first
    want = rows(pages.page_fold(a.unionByName(b)), *FOLD_COLUMNS)
    assert rows(pages.page_fold(tables.read_facts(spark, path)), *FOLD_COLUMNS) == want
    tables.compact_facts(spark, path, str(tmp_path / "compact"))
    compact = spark.read.parquet(str(tmp_path / "compact"))
    assert rows(pages.page_fold(compact), *FOLD_COLUMNS) == want


def test_bucketed_table_joins_without_a_shuffle(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("folded_a", "folded_b"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
            folded = pages.page_fold(random_facts(spark, 14)).select("page_hash", "n_revisions")
            tables.write_bucketed(folded, name, 4, path=str(tmp_path / name))
        joined = spark.table("folded_a").join(spark.table("folded_b"), "page_hash")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("folded_a", "folded_b"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


@pytest.fixture()
def topic_folder(spark, tmp_path):
    clicks = spark.range(20).select(F.concat(F.lit('{"id": '), F.col("id"), F.lit("}")).alias("value"))
    for topic in ("clickstream_topic", "pageview_topic"):
        rows_ = clicks.select(F.lit(topic).alias("topic"), F.lit(None).cast("string").alias("key"), "value")
        messages.replay_to_folder(rows_, str(tmp_path / "topics"))
    return str(tmp_path / "topics")


def test_replayed_topics_are_unified_and_restart_adds_nothing(spark, tmp_path, topic_folder):
    table = spark.createDataFrame([(i, f"n{i}") for i in range(10)], "id bigint, name string")

    def stream(salts):
        topics = [unify.folder_topic(spark, topic_folder, t, files_per_batch=3) for t in ("clickstream_topic", "pageview_topic")]
        return unify.unify_topics(topics, "id bigint", table, "id", salts=salts)

    columns = ("topic", "id", "found", "name")
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    unify.drain(stream(1), out, checkpoint)
    drained = spark.read.parquet(out).fillna("-")
    assert drained.count() == 40 and drained.where("found").count() == 20
    before = rows(drained, *columns)
    unify.drain(stream(1), out, checkpoint)
    assert rows(spark.read.parquet(out).fillna("-"), *columns) == before
    salted = unify.drain_and_read(stream(4), fresh_folder(spark, "test-salted"))
    assert rows(salted.fillna("-"), *columns) == before
    # What arrives later is added once.
    more = spark.createDataFrame([("pageview_topic", None, '{"id": 99}')], "topic string, key string, value string")
    messages.replay_to_folder(more, topic_folder)
    unify.drain(stream(1), out, checkpoint)
    assert spark.read.parquet(out).count() == 41


def test_no_topics(spark):
    with pytest.raises(ValueError):
        unify.unify_topics([], "id bigint", spark.range(1), "id")


def test_message_rows_round_trip(spark, tmp_path):
    frame = spark.sql("SELECT 'h' AS page_hash, '2024-01' AS year_month, named_struct('access_type', 0) AS tuple_struct")
    messages.replay_to_folder(message_rows(frame, "pageview_topic", "PageView"), str(tmp_path))
    back = spark.read.parquet(str(tmp_path)).first()
    assert (back.topic, back.key) == ("pageview_topic", "h|2024-01")


def test_repeats_are_dropped_and_old_events_kept(spark, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "run")
    data = spark.range(30).select("id", F.timestamp_seconds(F.col("id") * 10**6).alias("at"))
    # The newest events come first; older ones and repeats follow in later batches.
    for part in (data.where("id >= 15"), data.where("id < 15"), data):
        part.coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema("id bigint, at timestamp").option("maxFilesPerTrigger", 1).parquet(source)
    assert rows(unify.drain_and_read(dedup.drop_repeats(stream, ["id"], "1 hour"), folder), "id") == [(i,) for i in range(30)]
    # Keys are remembered across a restart.
    data.coalesce(1).write.mode("append").parquet(source)
    assert unify.drain_and_read(dedup.drop_repeats(stream, ["id"], "1 hour"), folder).count() == 30


def test_streamed_fold_equals_batch_fold(spark, tmp_path):
    parts = [random_facts(spark, seed, 500) for seed in (21, 22, 23)]
    source = str(tmp_path / "in")
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(source)
    broken = parts[0].limit(5).withColumn("page_hash", F.lit(None).cast("string"))
    broken.coalesce(1).write.mode("append").parquet(source)
    bad_counts = []
    stream = spark.readStream.schema(parts[0].schema).option("maxFilesPerTrigger", 1).parquet(source)
    table = str(tmp_path / "facts")

    def run():
        fold.fold_stream(stream, table, str(tmp_path / "checkpoint"),
                         on_bad=lambda bad, batch_id: bad_counts.append(bad.count())).awaitTermination()

    run()
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    want = rows(pages.page_fold(whole), *FOLD_COLUMNS)
    assert rows(pages.page_fold(tables.read_facts(spark, table)), *FOLD_COLUMNS) == want
    assert sum(bad_counts) == 5
    run()  # nothing new: the same table again
    assert rows(pages.page_fold(tables.read_facts(spark, table)), *FOLD_COLUMNS) == want


def test_two_streams_on_one_table_lose_nothing(spark, tmp_path):
    parts = [random_facts(spark, seed, 300) for seed in (31, 32)]
    table = str(tmp_path / "facts")
    for n, part in enumerate(parts):
        part.coalesce(1).write.parquet(str(tmp_path / f"in{n}"))
        stream = spark.readStream.schema(part.schema).parquet(str(tmp_path / f"in{n}"))
        fold.fold_stream(stream, table, str(tmp_path / f"checkpoint{n}")).awaitTermination()
    want = rows(pages.page_fold(parts[0].unionByName(parts[1])), *FOLD_COLUMNS)
    assert rows(pages.page_fold(tables.read_facts(spark, table)), *FOLD_COLUMNS) == want


def test_stored_facts_keep_first_and_last_times(spark, tmp_path):
    title = "SELECT 'enwiki' wiki_code, 'p' page_hash, '2024-01' year_month, 'historical_titles' kind, '{}' element, timestamp'2024-01-{} 00:00:00' seen_at"
    facts = spark.sql(title.format("A", "01")).unionAll(spark.sql(title.format("B", "10"))).unionAll(spark.sql(title.format("A", "20")))
    tables.append_batch(facts, str(tmp_path / "facts"), 0)
    assert rows(pages.page_fold(tables.read_facts(spark, str(tmp_path / "facts"))), *FOLD_COLUMNS) == rows(pages.page_fold(facts), *FOLD_COLUMNS)
    assert pages.page_fold(tables.read_facts(spark, str(tmp_path / "facts"))).first().current_title == "A"


@pytest.mark.parametrize("policy", ["dynamic", "static"])
def test_overwriting_facts_replaces_the_table(spark, tmp_path, policy):
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", policy)
    try:
        facts = random_facts(spark, 15)
        tables.write_facts(facts, str(tmp_path / "facts"))
        one = facts.where("year_month = '2024-01'")
        tables.write_facts(one, str(tmp_path / "facts"))
        assert spark.read.parquet(str(tmp_path / "facts")).count() == one.count()
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


def test_repeats_by_event_time(spark, tmp_path):
    data = spark.range(30).select("id", F.timestamp_seconds(F.col("id") + 1_700_000_000).alias("at"))
    data.coalesce(1).write.parquet(str(tmp_path / "in"))
    data.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id bigint, at timestamp").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out = unify.drain_and_read(dedup.drop_repeats(stream, ["id"], "1 hour", event_time="at"), str(tmp_path / "run"))
    assert rows(out, "id") == [(i,) for i in range(30)]


def test_one_scan_counts_every_topic(spark, tmp_path):
    data = [(t, f"{t}{i}") for t, n in (("a", 5), ("b", 3), ("c", 2)) for i in range(n)]
    spark.createDataFrame(data, "topic string, value string").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("topic string, value string").parquet(str(tmp_path / "in"))
    query = (of_topics(stream, ["a", "b"]).writeStream.format("parquet").option("path", str(tmp_path / "out"))
             .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())
    query.awaitTermination()
    counts = [p.observedMetrics["topics"] for p in query.recentProgress if "topics" in p.observedMetrics]
    assert (sum(c.a for c in counts), sum(c.b for c in counts)) == (5, 3)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 8
    assert len(query.lastProgress.sources) == 1
