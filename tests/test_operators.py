"""Operators on parsed rows: properties and small brute-force checks."""

from __future__ import annotations

import hashlib
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from dumpflow import fixed_values as fx
from dumpflow.operators import links, lookups, pages, quality, records, stats
from dumpflow.operators.facts import by_title, link_facts, sizes_by_title
from dumpflow.sources.pageviews import classify_pageviews
from dumpflow.sources.topics import decode_json, open_messages, union_topics


def rows(frame, *columns):
    return sorted(tuple(r) for r in frame.select(*columns).collect())


@pytest.fixture(scope="module")
def edges(spark):
    rng = random.Random(1)
    # One hub has a third of all links.
    data = [("enwiki", 0 if rng.random() < 0.33 else rng.randint(1, 40), rng.randint(0, 1), rng.randint(1, 60))
            for _ in range(2000)]
    return spark.createDataFrame(data, "wiki_code string, pl_from bigint, pl_from_namespace int, pl_target_id bigint"
                                 ).withColumn("timestamp", F.lit("2024-01-01").cast("timestamp"))


def test_mirror_twice_gives_the_edges_back(edges):
    once = links.mirror_links(edges)
    assert once.count() == 2 * edges.count()
    back = links.mirror_links(once.where("direction = 'inbound'").drop("direction")).where("direction = 'inbound'")
    columns = ("pl_from", "pl_from_namespace", "pl_target_id")
    assert rows(back, *columns) == rows(edges, *columns)


def test_degrees_by_brute_force(edges):
    want: dict[tuple, set] = {}
    for r in edges.collect():
        edge = (r.pl_from, r.pl_from_namespace, r.pl_target_id)
        want.setdefault((r.pl_from, "outbound"), set()).add(edge)
        want.setdefault((r.pl_target_id, "inbound"), set()).add(edge)
    got = rows(links.link_degrees(edges), "page_id", "direction", "n_links")
    assert got == sorted((page, direction, len(found)) for (page, direction), found in want.items())


def held(dumps, title, at):
    """The page with a title at a time, dump by dump: the last that took it, unless it has left since."""
    shown, holder, changes = {}, None, []
    for day in sorted({d for d, _, _ in dumps}):
        now = {page: t for d, page, t in dumps if d == day}
        takers = [page for page, t in now.items() if t == title and shown.get(page) != title]
        if takers or now.get(holder, title) != title:
            holder = min(takers, default=None)
            changes.append((day, holder))
        shown |= now
    return next((page for day, page in reversed(changes) if day <= at), changes[0][1] if changes else None)


def test_as_of_by_brute_force(spark):
    rng = random.Random(8)
    dumps = []
    for day in (3, 40, 41, 90, 400, 800):
        dumps += [(day, page, f"T{rng.randint(1, 9)}") for page in range(1, 9) if rng.random() < 0.8]
    table = spark.createDataFrame([("enwiki", p, t, d) for d, p, t in dumps], "wiki_code string, page_id bigint, page_title string, d int").select(
        "*", F.timestamp_seconds(F.col("d") * 86_400).alias("timestamp"), F.timestamp_seconds("d").alias("page_touched"))
    spans = links.title_spans(table)
    for a in spans.collect():  # no two holders of a title at once
        assert a.valid_from is None or a.valid_to is None or a.valid_from < a.valid_to
    views = [(i, "enwiki", rng.choice(["T1", f"T{rng.randint(1, 11)}", "T1", None]), rng.choice([None, 0, 2, 3, 39, 40, 41, 60, 90, 399, 400, 401, 800, 2_000])) for i in range(300)]
    facts = spark.createDataFrame([(i, w, t, d, -1) for i, w, t, d in views], "i int, wiki_code string, title string, d int, page_id int").withColumn(
        "seen_at", F.timestamp_seconds(F.col("d") * 86_400))
    want = [(i, (t and d is not None and held(dumps, t, d)) or 0) for i, _, t, d in views]
    for months in (1, 12, 1_000):
        joined = links.join_as_of(facts, spans, "seen_at", months)
        assert joined.columns == ["i", "wiki_code", "title", "d", "seen_at", "page_id"]
        assert [(i, p or 0) for i, p in rows(joined.withColumn("page_id", F.coalesce("page_id", F.lit(0))), "i", "page_id")] == want
    assert links.join_as_of(facts, spans.limit(0), "seen_at").where("page_id IS NOT NULL").count() == 0


def test_as_of_meets_by_title_and_period(spark):
    table = spark.createDataFrame([("enwiki", 1, "A")], "wiki_code string, page_id bigint, page_title string").withColumn(
        "timestamp", F.lit("2024-01-01").cast("timestamp")).withColumn("page_touched", F.col("timestamp"))
    facts = spark.createDataFrame([("enwiki", "A")], "wiki_code string, title string").withColumn("at", F.col("wiki_code").try_cast("timestamp"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = links.join_as_of(facts, links.title_spans(table), "at")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin [_row_wiki_code" in plan and "_period" in plan and "NestedLoop" not in plan


def test_crosswalk_takes_the_last_title(spark):
    table = spark.createDataFrame(
        [("enwiki", 1, "Old", 1), ("enwiki", 1, "New", 2), ("dewiki", 1, "Neu", 1)],
        "wiki_code string, page_id bigint, page_title string, at int",
    ).select("*", F.timestamp_seconds("at").alias("timestamp"), F.timestamp_seconds("at").alias("page_touched"))
    crosswalk = links.page_crosswalk(table)
    assert rows(crosswalk, "wiki_code", "page_id", "title") == [("dewiki", 1, "Neu"), ("enwiki", 1, "New")]
    degrees = spark.createDataFrame([("enwiki", 1, "inbound", 5)], "wiki_code string, page_id bigint, direction string, n_links bigint")
    assert rows(links.with_link_counts(crosswalk, degrees), "wiki_code", "n_in", "n_out") == [("dewiki", 0, 0), ("enwiki", 5, 0)]


def test_dispositions_sum_to_the_input(spark):
    rng = random.Random(5)
    parts = ["en.wikipedia", "A:b", "Special:X", "desktop", "7", "0", ""]
    frame = spark.createDataFrame([(" ".join(rng.choices(parts, k=rng.randint(0, 7))),) for _ in range(500)], "value string")
    counted = quality.count_reasons(classify_pageviews(frame))
    assert counted.agg(F.sum("n")).first()[0] == 500


def test_quarantine_and_handler(spark):
    frame = spark.createDataFrame([(1, None), (2, "bad")], "id int, reason string")
    seen = []
    good = quality.keep_good(frame, lambda bad: seen.append(rows(bad, "id", "reason")))
    assert rows(good, "id") == [(1,)] and good.columns == ["id"] and seen == [[(2, "bad")]]


def test_observed_counts(spark):
    from pyspark.sql import Observation

    frame = spark.createDataFrame([(1, None), (2, "bad"), (3, None)], "id int, reason string")
    seen = Observation("run")
    frame.observe(seen, F.count_if(F.col("reason").isNull()).alias("processed")).count()
    assert seen.get == {"processed": 2}
    assert quality.observe_reasons(frame, "run2").count() == 3


def random_facts(spark, seed, n=3000):
    rng = random.Random(seed)
    data = []
    for _ in range(n):
        page = "hot" if rng.random() < 0.34 else f"p{rng.randint(0, 30)}"
        month = f"2024-{rng.randint(1, 3):02d}"
        data.append(("enwiki", page, month, rng.choice(fx.ELEMENT_KINDS), f"e{rng.randint(0, 300)}", rng.randint(0, 10**6)))
    return spark.createDataFrame(
        data, "wiki_code string, page_hash string, year_month string, kind string, element string, s int"
    ).withColumn("seen_at", F.timestamp_seconds("s")).select(*pages.FACT_COLUMNS)


def brute_fold(facts):
    out: dict[str, dict] = {}
    for r in facts.collect():
        page = out.setdefault(r.page_hash, {"sets": {}, "seen": [], "titles": {}})
        page["sets"].setdefault(r.kind, set()).add(r.element)
        page["seen"].append(r.seen_at)
        if r.kind == fx.TITLES:
            page["titles"][r.element] = max(page["titles"].get(r.element, r.seen_at), r.seen_at)
    return sorted(
        (page, *[len(d["sets"].get(k, ())) for k in fx.ELEMENT_KINDS], min(d["seen"]), max(d["seen"]),
         max(((at, t) for t, at in d["titles"].items()), default=(None, None))[1])
        for page, d in out.items()
    )


FOLD_COLUMNS = ("page_hash", *[f"n_{k}" for k in fx.ELEMENT_KINDS], "created_at", "last_updated", "current_title")


def test_fold_by_brute_force(spark):
    facts = random_facts(spark, 1)
    assert rows(pages.page_fold(facts), *FOLD_COLUMNS) == brute_fold(facts)


def test_fold_of_parts_equals_fold_of_all(spark):
    a, b = random_facts(spark, 2), random_facts(spark, 3)
    both = rows(pages.page_fold(a.unionByName(b)), *FOLD_COLUMNS)
    repeated = a.unionByName(b).unionByName(a)
    assert rows(pages.page_fold(repeated), *FOLD_COLUMNS) == both
    assert rows(pages.page_fold(pages.drop_equal_facts(a).unionByName(b)), *FOLD_COLUMNS) == both


def test_months_and_total(spark):
    facts = random_facts(spark, 4)
    folded = pages.monthly_and_total(facts)
    total = folded.where("grain = 'total'")
    assert rows(total, "page_hash", "n_revisions") == rows(pages.page_fold(facts), "page_hash", "n_revisions")
    march = folded.where("grain = 'month' AND year_month = '2024-03'")
    only_march = pages.page_fold(facts.where("year_month = '2024-03'"))
    assert rows(march, "page_hash", "n_pageviews") == rows(only_march, "page_hash", "n_pageviews")


@pytest.mark.parametrize("digits", [1, 2])
def test_documents_hold_every_element_in_buckets(spark, digits):
    facts = random_facts(spark, 5)
    elements = pages.page_elements(facts)
    documents = pages.page_documents(elements, digits).cache()
    for kind in fx.ELEMENT_KINDS:
        exploded = documents.select("page_hash", F.explode(kind).alias("element"))
        assert rows(exploded, "page_hash", "element") == rows(elements.where(F.col("kind") == kind), "page_hash", "element")
    times = documents.select("page_hash", "created_at", "last_updated").distinct()
    assert rows(times, "page_hash", "created_at", "last_updated") == rows(pages.page_fold(facts), "page_hash", "created_at", "last_updated")
    assert documents.where("page_hash = 'hot'").count() > 1


def test_documents_by_size_stay_below_a_bound(spark):
    # One page has a third of all elements.
    data = [("enwiki", "hot" if i % 3 == 0 else f"p{i % 40}", fx.ELEMENT_KINDS[i % 2], f"e{i}", i % 7) for i in range(6_000)]
    elements = spark.createDataFrame(data, "wiki_code string, page_hash string, kind string, element string, d int").select(
        "wiki_code", "page_hash", "kind", "element", F.timestamp_seconds("d").alias("first_seen"), F.timestamp_seconds("d").alias("last_seen"))
    documents = pages.page_documents_by_size(elements, per_row=200).cache()
    sizes = documents.select("page_hash", "n_buckets", "bucket", sum(F.size(k) for k in fx.ELEMENT_KINDS).alias("n")).collect()
    assert max(r.n for r in sizes) <= 200
    assert {r.n_buckets for r in sizes if r.page_hash == "hot"} == {256} and {r.n_buckets for r in sizes if r.page_hash != "hot"} <= {1, 16}
    assert all(16 ** len(r.bucket) == r.n_buckets for r in sizes)
    for kind in fx.ELEMENT_KINDS[:2]:
        exploded = documents.select("page_hash", F.explode(kind).alias("element"))
        assert rows(exploded, "page_hash", "element") == rows(elements.where(F.col("kind") == kind), "page_hash", "element")


def test_months_and_totals_shuffle_no_text(spark):
    plan = pages.monthly_and_total(random_facts(spark, 3))._jdf.queryExecution().executedPlan().toString()
    exchanges = re.findall(r"Exchange hashpartitioning\(([^\n]*)", plan)
    assert exchanges and "Generate" not in plan and "md5" in plan
    # The text is digested in front of the first shuffle and does not come up again.
    below = plan[plan.rindex("Exchange hashpartitioning"):]
    assert "md5(" in below


def test_latest_row_is_the_last_of_each_group(spark):
    data = [(k, random.Random(k * 100 + i).randint(0, 50), i) for k in range(5) for i in range(40)]
    frame = spark.createDataFrame(data, "k int, at int, id int")
    got = rows(pages.latest_row(frame, ["k"], [F.col("at"), F.col("id")]), "k", "at", "id")
    assert got == sorted(max((r for r in data if r[0] == k), key=lambda r: (r[1], r[2])) for k in range(5))


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_lookup_join_does_not_depend_on_salts(spark, how):
    facts = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 20).alias("k"))
    table = spark.createDataFrame([(i, f"n{i}") for i in range(0, 15)], "k bigint, name string")
    plain = lookups.lookup_join(facts, table, "k", how)
    salted = lookups.lookup_join(facts, table, "k", how, salts=7)
    assert rows(plain, *sorted(plain.columns)) == rows(salted, *sorted(plain.columns))


def test_upsert_split(spark):
    old = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    new = spark.createDataFrame([(2,), (3,), (3,), (None,)], "k int")
    got = {(r.k, r.action) for r in lookups.upsert_split(old, new, ["k"]).collect()}
    assert got == {(2, "update"), (3, "insert"), (None, "insert")}


def test_line_numbers_by_brute_force(spark):
    rng = random.Random(9)
    data = [(rng.choice("abb"), i) for i in range(500)]
    frame = spark.createDataFrame(data, "file string, at int").withColumn("block", F.expr("at div 37"))
    got = rows(stats.number_lines(frame, "file", "block", "at"), "file", "at", "line_number")
    want, seen = [], {}
    for file, at in data:
        seen[file] = seen.get(file, 0) + 1
        want.append((file, at, seen[file]))
    assert got == sorted(want)


def test_line_numbers_of_a_split_file(spark, tmp_path):
    from dumpflow.sources.lines import read_lines

    (tmp_path / "x.txt").write_text("".join(f"line {i}\n" for i in range(1, 5001)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        read = read_lines(spark, str(tmp_path)).withColumn("_at", F.monotonically_increasing_id())
        assert read.rdd.getNumPartitions() > 2
        numbered = stats.number_lines(read, "file_name", "block_start", "_at")
        assert numbered.where(F.concat(F.lit("line "), F.col("line_number")) != F.col("value")).count() == 0
        assert numbered.count() == 5000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_sample_limit(spark):
    assert stats.sample_rows(spark.range(10), None).count() == 10
    assert rows(stats.sample_rows(spark.range(10), 3, "id"), "id") == [(0,), (1,), (2,)]


def test_job_stats_with_no_duration(spark):
    log = spark.createDataFrame([("a", False, 5), ("b", True, 0), ("b", False, 50)], "job string, bad boolean, s int")
    got = rows(stats.job_stats(log, "job", F.col("bad"), F.timestamp_seconds("s"), batch_size=1),
               "job", "documents", "batches", "errors", "docs_per_second")
    assert got == [("a", 1, 1, 0, None), ("b", 2, 2, 1, 0.04)]


def test_routing_rules(spark):
    messages = [
        ("x_topic", {"_schema_name": "Given"}, "Given"),
        ("x_topic", {"tuple_struct": {"rev_id": None, "title": "t"}}, "RevisionData"),
        ("x_topic", {"tuple_struct": {"access_type": 1}}, "PageView"),
        ("x_topic", {"tuple_struct": {"target_page": "t"}}, "ClickStream"),
        ("x_topic", {"tuple_struct": {"pl_from": 1}}, "OutboundPageLinks"),
        ("x_topic", {"tuple_struct": {"pl_from": 1}, "direction": "inbound"}, "InboundPageLinks"),
        ("x_topic", {"tuple_struct": {"title": "t"}, "wiki_code": "enwiki"}, "WikiDocument"),
        ("x_topic", {"tuple_struct": {"title": "t"}}, "TitleIdMapping"),
        ("x_topic", {"tuple_struct": {"page_title": "t"}}, "PageInfo"),
        ("revision_data_topic", {}, "RevisionData"),
        ("pageview_topic", {"tuple_struct": {}}, "PageView"),
        ("other_topic", {"a": 1}, "Other"),
    ]
    frame = spark.createDataFrame([(t, json.dumps(m), w) for t, m, w in messages], "topic string, value string, want string")
    routed = records.route_schema(open_messages(frame))
    assert [(r.topic, r.schema_name) for r in routed.where("NOT (schema_name <=> want)").collect()] == []


def test_keys_of_typed_frames_equal_keys_of_messages(spark):
    frame = spark.sql("SELECT 'h' AS page_hash, CAST(NULL AS string) AS year_month, "
                      "named_struct('pl_from', 5, 'pl_target_id', 6) AS tuple_struct")
    for schema in ("PageView", "OutboundPageLinks", "InboundPageLinks"):
        message = records.message_rows(frame, "t", schema).first()
        opened = open_messages(spark.createDataFrame([(message.value,)], "value string"))
        again = opened.select(records.partition_key(F.lit(schema)).alias("k")).first().k
        assert message.key == again
    assert json.loads(message.value) == {"page_hash": "h", "year_month": None, "tuple_struct": {"pl_from": 5, "pl_target_id": 6}}
    assert records.message_rows(frame, "t", "Unmapped").first().key is None
    assert records.message_rows(frame, "t", "PageView", key=F.lit("mine")).first().key == "mine"


def test_ingest_stamp(spark):
    stamped = records.stamp_ingest(spark.range(2).withColumn("timestamp", F.lit("x")), F.lit("2024-01-01").cast("timestamp"))
    assert {str(r.timestamp) for r in stamped.collect()} == {"2024-01-01 00:00:00"}


def test_json_decode_marks_malformed(spark):
    frame = spark.createDataFrame([('{"id": 1}',), ('{"id": ',), ("text",), ("",), (None,), ('{"other": 2}',), ('{"id": "x"}',)], "value string")
    got = [(r.is_malformed, r.event and r.event.id) for r in decode_json(frame, "id bigint").collect()]
    assert got == [(False, 1), (True, None), (True, None), (True, None), (True, None), (False, None), (True, None)]


def test_union_of_no_topics_is_an_error():
    with pytest.raises(ValueError):
        union_topics([])


def test_last_value_of_a_repeated_key_counts(spark):
    frame = spark.createDataFrame([('{"a":1,"a":2,"tuple_struct":{"x":1,"x":null,"y":3}}',), ('{"a":1}',), ("no json",)], "value string")
    got = open_messages(frame).select("*", records.metadata_map().alias("metadata")).collect()
    assert got[0]._top["a"] == "2" and got[0]._inner == {"x": None, "y": "3"} and got[0].metadata == {"metadata.a": "2"}
    assert got[1]._top == {"a": "1"} and not got[2]._top


def test_facts_without_a_key_stay_with_salts(spark):
    facts = spark.createDataFrame([(None, i) for i in range(50)] + [(1, 99)], "k bigint, v bigint")
    table = spark.createDataFrame([(1, "one"), (None, "none")], "k bigint, name string")
    got = lookups.lookup_flag(facts, table, "k", salts=4)
    assert got.count() == 51 and rows(got.where("found"), "v", "name") == [(99, "one")]


def test_facts_by_title_lose_none(spark):
    keys = spark.sql("SELECT 'enwiki' wiki_code, 1 page_id, 'T' title, 'title1' title_hash, 'id1' id_hash")
    facts = spark.createDataFrame(
        [("enwiki", "id1", "2024-01", "revisions", "a"), ("enwiki", "id2", "2024-01", "revisions", "b"), ("enwiki", "title1", "2024-01", "pageviews", "c")],
        "wiki_code string, page_hash string, year_month string, kind string, element string").withColumn("seen_at", F.lit("2024-01-01").cast("timestamp"))
    got = rows(by_title(facts, keys), "element", "page_hash", "is_known")
    assert got == [("a", "title1", True), ("b", "id2", False), ("c", "title1", True)]


def test_sizes_by_title_equal_the_fold_of_facts_by_title(spark):
    keys = spark.createDataFrame([("enwiki", p, f"t{p % 5}") for p in range(12)], "wiki_code string, page_id bigint, title_hash string").withColumn(
        "id_hash", F.sha2(F.concat_ws("-", "wiki_code", "page_id"), 256))
    rng = random.Random(9)
    data = [("enwiki", f"t{rng.randint(0, 8)}", "pageviews", str(rng.randint(0, 6))) for _ in range(80)]
    data += [("enwiki", hashlib.sha256(f"enwiki-{p}".encode()).hexdigest(), kind, element) for p in range(20)
             for kind, element in (("revisions", f"{p}-{p % 3}"), ("historical_titles", f"title {p % 4}"))]
    facts = spark.createDataFrame(data, "wiki_code string, page_hash string, kind string, element string").withColumns(
        {"year_month": F.lit("2024-01"), "seen_at": F.lit("2024-01-01").cast("timestamp")})
    edges = spark.createDataFrame([("enwiki", rng.randint(0, 15), 0, rng.randint(0, 15)) for _ in range(200)],
                                  "wiki_code string, pl_from bigint, pl_from_namespace int, pl_target_id bigint").withColumns(
        {"year_month": F.lit("2024-01"), "timestamp": F.lit("2024-01-01").cast("timestamp")})
    got = sizes_by_title(facts, links.link_counts(edges), keys)
    want = by_title(facts.unionByName(link_facts(edges)), keys).groupBy(*pages.PAGE_KEY, "kind", "element").agg(
        F.max("is_known").alias("is_known")).groupBy(*pages.PAGE_KEY).agg(*pages.element_counts(), F.max("is_known").alias("is_known"))
    assert rows(got, *want.columns) == rows(want, *want.columns) and got.count() > 15


def test_salted_copies_are_not_broadcast(spark):
    facts = spark.range(1000).select("id", (F.col("id") % 20).alias("k"))
    table = spark.range(15).select(F.col("id").alias("k"), F.lit("n").alias("name"))
    plan = lookups.lookup_join(facts, table, "k", salts=7)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_tasks_for_edges_follow_the_input(spark, edges):
    small, large = (links.distinct_edges(spark.range(n).selectExpr(
        "'enwiki' wiki_code", "id pl_from", "0 pl_from_namespace", "id pl_target_id", "timestamp'2024-01-01' timestamp")) for n in (10, 10_000_000))
    sizes = [int(s) for f in (small, large) for s in re.findall(r"REPARTITION_BY_NUM|, (\d+)\), REPARTITION", f._jdf.queryExecution().executedPlan().toString()) if s]
    assert len(sizes) == 2 and sizes[0] == spark.sparkContext.defaultParallelism and sizes[1] > 10 * sizes[0]
    assert rows(links.distinct_edges(edges), "pl_from", "pl_target_id") == rows(edges.distinct(), "pl_from", "pl_target_id")
