from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from dumpflow.llm import quality
from tests.llm.conftest import prose


def brute(text):
    text = text or ""
    w = [x.decode() for x in text.encode().split()]
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = Counter(grams)
    inside = {j for i, g in enumerate(grams) if often[g] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if x.encode().split()]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)


def junk(seed):
    rng = random.Random(seed)
    return " | ".join(f"W{rng.randrange(500)}#" for _ in range(60 + seed % 40))


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(i, prose(i, 80 + i % 50), None, None, None) for i in range(150)] + [(1000 + i, junk(i), None, None, None) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return docs, spark.createDataFrame([(r[0], int(r[0] < 1000)) for r in rows if r[0] % 2] + [(1, None), (None, 0), (99_999, 0)], "doc_id bigint, quality int")


def test_statistics(documents):
    rows = [(i, x, None, None, None) for i, x in enumerate(["a b c a b c", "a a a a", "x\ny\nx\n \n \nx", "a b c d a b c e b c d", "| # é b *$%&<>", "a b", "a b c"])]
    docs = documents().union(documents(rows)).withColumns({"n_words": F.lit("clash"), "n_lines": F.lit(1)})
    for r in quality.statistics(docs).collect():
        assert tuple(r[c] for c in quality.BASE) == brute(r.text), r.text[:80] if r.text else r
    assert set(quality.statistics(docs).columns) == set(docs.columns) | set(quality.BASE) | set(quality.FURTHER)


def test_rules_tell_junk_from_prose(labelled):
    docs, labels = labelled
    stats = quality.statistics(docs)
    rules = quality.learn(quality.with_labels(stats, labels))
    assert rules
    kept = {r.doc_id: r.kept for r in quality.judge(stats, rules).collect()}
    held = [i for i in kept if i % 2 == 0]  # no label was seen for these
    assert all(kept[i] == (i < 1000) for i in held)


def test_no_rule_without_bad_rows(labelled, spark):
    docs, labels = labelled
    stats = quality.statistics(docs)
    for some in (labels.where("quality = 1"), labels.where("false")):
        assert quality.learn(quality.with_labels(stats, some)) == []
    assert quality.judge(quality.statistics(docs.where("false")), []).count() == 0


def test_random_labels_give_no_rule(labelled):
    docs, labels = labelled
    noise = labels.where("doc_id < 1000").withColumn("quality", (F.xxhash64("doc_id") % 2 == 0).cast("int"))
    assert quality.learn(quality.with_labels(quality.statistics(docs), noise)) == []


def test_base_limits(documents):
    rows = [(0, " ".join(f"w{i}" for i in range(50)), None, None, None), (1, " ".join(f"w{i}" for i in range(49)), None, None, None), (2, "a b c d " * 40, None, None, None), (3, None, None, None, None)]
    got = {r.doc_id: (r.base_failed, r.kept) for r in quality.judge(quality.statistics(documents(rows)), []).collect()}
    assert got == {0: (False, True), 1: (True, False), 2: (True, False), 3: (True, False)}


def test_first_rule_that_holds(documents):
    rules = [[quality.Condition("words", 60.0, True), quality.Condition("words", 70.0, False)], [quality.Condition("words", 55.0, True)]]
    rows = [(n, " ".join(f"w{i}" for i in range(n)), None, None, None) for n in (50, 58, 65, 80)]
    got = {r.doc_id: (r.rule, r.kept) for r in quality.judge(quality.statistics(documents(rows)), rules).collect()}
    assert got == {50: (0, True), 58: (2, False), 65: (1, False), 80: (2, False)}
