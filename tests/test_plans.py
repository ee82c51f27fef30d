"""Plan shapes that must hold at scale."""

from __future__ import annotations

import re

import pytest

from dumpflow.plans import catalogue

FOLDER = "/root/testdata/sf0.001"
#: Queries over files that must be read whole, with line numbers; the reader for that runs in Python.
CHECKED_READER = {"file_isolation", "file_line_number"}
BATCH = sorted(n for n in catalogue.QUERIES if not n.startswith("stream_"))
PYTHON = ("MapInArrow", "MapInPandas", "EvalPython", "InArrow", "InPandas", "PythonUDF", "PythonUDTF", "Python", "Pandas")


def plan_of(spark, name):
    frame = catalogue.QUERIES[name](spark, FOLDER)
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(spark, name)
    for bad in (*(() if name in CHECKED_READER else PYTHON), "CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition, ENSURE"):
        assert bad not in plan, bad


@pytest.mark.parametrize(
    "name, columns",
    [("download_stats", {"event_type", "value"}), ("json_decode", {"event_id", "props"}),
     ("link_degree", {"l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_shipdate"}),
     ("pageview_disposition", {"event_id", "user_id", "event_type", "value"}), ("href_extract", {"page_id", "html"})],
)
def test_only_needed_columns_are_read(spark, name, columns):
    frame = catalogue.QUERIES[name](spark, FOLDER)
    plan = frame._jdf.queryExecution().executedPlan()
    scans = re.findall(r"ReadSchema: struct<([^>]*)", plan.verboseStringWithOperatorId()) or re.findall(
        r"ReadSchema: struct<([^>]*)", plan.toString())
    assert len(scans) == 1
    assert {part.split(":")[0] for part in scans[0].split(",") if ":" in part} <= columns


def test_filters_reach_the_scan(spark):
    plan = plan_of(spark, "upsert_split")
    assert "PushedFilters: [IsNotNull(ts)" in plan and "EqualTo(event_type,click)" in plan


def test_rollups_shuffle_once_and_hash(spark):
    for name in ("pageview_rollup", "clickstream_rollup", "revision_stats", "job_stats"):
        plan = plan_of(spark, name)
        assert plan.count("ENSURE_REQUIREMENTS") == 1 and "SortAggregate" not in plan


def test_no_join_is_forced_to_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("event_lookup", "page_crosswalk", "page_fold_crosswalk", "line_number"):
            assert "Broadcast" not in plan_of(spark, name)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_element_of_a_link_is_shuffled_for_the_page_fold(spark):
    plan = plan_of(spark, "page_fold_all").split("Initial Plan")[-1]
    # Revisions, views and clicks are shuffled as digests, links as numbers: no JSON of an element is in an exchange.
    assert "unhex(md5(" in plan and "direction#" in plan
    assert not re.search(r"to_json[^\n]*pl_from", plan)


def test_a_scan_is_dealt_out_by_its_size(spark, monkeypatch):
    from dumpflow.plans import adapters
    from dumpflow.sources import lines

    rows = adapters.rows_to_render(spark, FOLDER, "lineitem", "l_orderkey", "l_partkey")
    assert rows.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(lines, "BYTES_PER_TASK", 1_000)
    more = adapters.rows_to_render(spark, FOLDER, "lineitem", "l_orderkey", "l_partkey")
    assert more.rdd.getNumPartitions() > 2 * spark.sparkContext.defaultParallelism and more.count() == rows.count()


def test_messages_parse_each_dump_once(spark):
    plan = plan_of(spark, "message_keys").split("Initial Plan")[-1]
    assert "from_xml" not in plan.lower()  # the parsed export is kept
    assert plan.count("pagelinks.sql.gz") == 1


def test_stored_exports_have_the_codec_of_their_names(spark):
    files = catalogue.QUERIES["file_revisions"](spark, FOLDER).inputFiles()
    assert files and all(".xml.gz/" in f and f.endswith(".gz") for f in files)
