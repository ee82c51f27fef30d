from __future__ import annotations

from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
from pyspark.sql import functions as F

from dumpflow.llm import mixing


def targets(sizes):
    """Water filling with exact fractions."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    out, total, open_ = {}, sum(sizes.values()), set(names)
    while open_:
        share = Fraction(total - sum(out.values()), sum(weight[s] for s in open_))
        full = {s for s in open_ if share * weight[s] >= 3 * sizes[s]}
        if not full:
            return out | {s: share * weight[s] for s in open_}
        out |= {s: Fraction(3 * sizes[s]) for s in full}
        open_ -= full
    return out


def test_targets_and_takings(documents):
    docs = documents().withColumns({"size": F.lit("clash"), "key": F.lit(1), "queue": F.lit(2)})
    rows = mixing.taken(docs).collect()
    assert len(rows) == docs.count()
    texts = docs.select("doc_id", "source", "text").collect()
    sizes = defaultdict(int)
    for r in texts:
        sizes[r.source] += len((r.text or "").encode().split())
    want = targets(sizes)
    source = {(r.doc_id): r.source for r in texts}
    for r in rows:
        assert r.source_size == sizes[source[r.doc_id]] and abs(r.target - float(want[source[r.doc_id]])) < 1e-6
        assert r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
    total = sum(sizes.values())
    assert total <= sum(r.taken for r in rows) <= total + max(r.size for r in rows)
    assert Counter(rows) == Counter(mixing.taken(docs.repartition(7)).collect())  # reruns agree


def test_sources_come_near_their_targets(documents):
    docs = documents([(i, "w " * (5 + i % 40), None, ("big", "mid", "small")[min(2, i % 20)], None) for i in range(3000)])
    rows = mixing.taken(docs).collect()
    by = defaultdict(int)
    for r in rows:
        by[r.target] += r.taken
    assert all(abs(got - target) <= 0.02 * target + 50 for target, got in by.items())


def test_copies_in_order(documents):
    docs = documents().withColumns({"mix_epoch": F.lit("clash"), "span": F.lit(1), "bucket": F.lit(1)})
    rows = mixing.mix(docs).collect()
    assert set(docs.columns) | {"mix_target", "mix_finish"} == set(rows[0].asDict())
    assert [r.mix_finish for r in rows] == sorted(r.mix_finish for r in rows)
    words = sum(len((r.text or "").encode().split()) for r in rows)
    assert words == sum(r.taken for r in mixing.taken(docs).collect())
    assert mixing.mix(documents([])).count() == 0 and mixing.taken(documents([])).count() == 0


def test_against_sql(documents):
    docs = documents().where("doc_id is not null and doc_id <> 5")
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    got = sorted(map(tuple, mixing.taken(docs).select("doc_id", "size", "source_size", "target", "taken").collect()))
    assert sorted(con.sql(mixing.TAKEN_SQL).fetchall()) == got


def test_only_empty_texts(documents):
    rows = mixing.taken(documents([(1, None, None, None, None), (2, "", None, "a", None)])).collect()
    assert [(r.size, r.target, r.taken) for r in rows] == [(0, 0.0, 0)] * 2
