"""Topics as a log of files: offsets, commits, streams that go on."""

from __future__ import annotations

import random

import pyarrow as pa
import pytest

from dumpflow.sinks.messages import send_batch, send_stream
from dumpflow.sources import topic_log
from dumpflow.sources.topics import read_topic

MESSAGES = "topic string, key string, value string"


@pytest.fixture
def log(spark, tmp_path):
    topic_log.use_topic_log(spark)
    return {"path": str(tmp_path / "log")}


def sent(spark, log, rows, parts=3):
    send_batch(spark.createDataFrame(rows, MESSAGES).repartition(parts), log, sink="topic_log")


def read(spark, log, **options):
    return sorted((r.topic, r.offset, r.key, r.value) for r in spark.read.format("topic_log").options(**log, **options).load().collect())


def test_offsets_of_batches(spark, log):
    assert read(spark, log) == []
    rng, want = random.Random(1), []
    for k in range(3):
        rows = [(rng.choice("abc"), None if rng.random() < 0.3 else "k", f"{k}-{i}") for i in range(200)]
        sent(spark, log, rows)
        want += rows
    got = read(spark, log)
    assert sorted((t, v) for t, _, _, v in got) == sorted((t, v) for t, _, v in want)
    assert {(t, v): k for t, k, v in want} == {(t, v): k for t, _, k, v in got}
    for topic in "abc":
        assert [o for t, o, _, _ in got if t == topic] == list(range(sum(t == topic for t, _, _ in want)))
        # Messages of a batch come after those of the batches before it.
        batches = [int(v[0]) for t, _, _, v in got if t == topic]
        assert batches == sorted(batches)
    assert read(spark, log, topic="a,c") == [r for r in got if r[0] != "b"]
    assert read(spark, log, topic="nothing") == []


def test_ranges_within_files(tmp_path):
    path = str(tmp_path / "log")
    log = topic_log.Log(path)
    for n in (5, 20_000, 1):
        batch = pa.RecordBatch.from_arrays([pa.array(["t"] * n), pa.array([None] * n, pa.string()), pa.array([f"{n}"] * n)], ["topic", "key", "value"])
        log.add(topic_log._write(path, iter([batch])).files)
    for a, b in ((0, 20_006), (3, 9), (5, 20_005), (9_000, 9_001), (20_005, 20_006), (7, 7)):
        parts = topic_log._parts(log, {"t": a}, {"t": b})
        got = [o for p in sorted(parts, key=lambda p: p.first) for batch in topic_log._read(path, p) for o in batch.column(3).to_pylist()]
        assert got == list(range(a, b))


def test_only_committed_files_count_and_count_once(spark, log, tmp_path):
    sent(spark, log, [("t", "k", "one")])
    store = topic_log.Log(log["path"])
    batch = pa.RecordBatch.from_arrays([pa.array(["t"]), pa.array(["k"]), pa.array(["two"])], ["topic", "key", "value"])
    lost = topic_log._write(log["path"], iter([batch])).files  # a task whose job never commits
    assert [r[3] for r in read(spark, log)] == ["one"]
    store.add(lost, "stream", 4)
    again = topic_log._write(log["path"], iter([batch])).files
    store.add(again, "stream", 4)  # the same batch after a restart
    store.add(again, "stream", 3)
    assert [r[1:] for r in read(spark, log)] == [(0, "k", "one"), (1, "k", "two")]
    store.add(again, "other", 0)
    assert len(read(spark, log)) == 3


def test_stream_goes_on_from_its_checkpoint(spark, log, tmp_path):
    copies = {"path": str(tmp_path / "copies"), "writer": "w"}
    for k, values in enumerate((["a", "b", "c"], [], ["d"] * 50)):
        if values:
            sent(spark, log, [(t, "k", f"{v}{i}") for i, v in enumerate(values) for t in ("x", "y")], parts=2)
        stream = read_topic(spark, "x", log, source="topic_log").selectExpr("'copy' AS topic", "topic AS key", "value")
        send_stream(stream, copies, str(tmp_path / "c"), sink="topic_log", availableNow=True).awaitTermination()
        have = [r[3] for r in read(spark, log) if r[0] == "x"]
        got = read(spark, copies)
        assert sorted(r[3] for r in got) == sorted(have) and {r[0] for r in got} == {"copy"}
        assert [r[1] for r in got] == list(range(len(have)))


def test_no_overwriting(spark, log):
    frame = spark.createDataFrame([("t", "k", "v")], MESSAGES)
    with pytest.raises(Exception, match="only added"):
        frame.write.format("topic_log").options(**log).mode("overwrite").save()
