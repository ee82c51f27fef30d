from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from dumpflow.llm import components, simhash


def brute(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    runs = [b" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or [b" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(x, 42) for x in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(nodes, near):
    """Smallest node that each reaches."""
    root = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a in nodes:
            for b in nodes:
                low = min(root[a], root[b])
                if near(a, b) and (root[a], root[b]) != (low, low):
                    root[a] = root[b] = low
                    changed = True
    return root


def test_fingerprints_and_components(documents):
    docs = documents().withColumn("fp", F.lit("clash"))
    rows = docs.select("doc_id", "text").collect()
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    prints = {}
    for i, text in rows:
        prints.setdefault(brute(text) & (2**64 - 1), []).append(i)
    ids = {fp: min(i for i in x if i is not None) for fp, x in prints.items() if any(i is not None for i in x)}
    by_id = {i: fp for fp, i in ids.items()}
    root = groups(list(by_id), lambda a, b: (by_id[a] ^ by_id[b]).bit_count() <= 4)
    want = sorted((str(i), fp, str(root.get(ids.get(fp)))) for fp, x in prints.items() for i in x)
    assert sorted((str(r.doc_id), r.fp & (2**64 - 1), str(r.component_id)) for r in got) == want


@pytest.mark.parametrize("deal_again", [2, 20_000])
def test_links_of_crowded_fingerprints(spark, deal_again):
    rng = random.Random(deal_again)
    base = [rng.getrandbits(64) for _ in range(12)]
    fps = sorted({b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 5))) for b in base for _ in range(25)})
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    classes = spark.createDataFrame(list(zip(signed, range(len(fps)), strict=True)), "fp bigint, node bigint")
    found = components.components(simhash.links_within(classes, deal_again=deal_again))
    root = {n: n for n in range(len(fps))} | {r.node: r.root for r in found.collect()}
    assert root == groups(list(range(len(fps))), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 4)


def test_dealt_keys_bring_near_ones_together(spark):
    fp = 0x0123456789ABCDEF
    near = [fp ^ (1 << a) ^ (1 << b) ^ (1 << c) ^ (1 << d) for a, b, c, d in [(0, 20, 40, 63), (12, 13, 14, 15), (5, 25, 38, 51)]]
    for other in near:
        rows = spark.createDataFrame([(fp, 0), (other - (1 << 64) if other >> 63 else other, 1)], "fp bigint, node bigint")
        for again in (0, 10):
            keys = simhash.dealt(rows, deal_again=again).groupBy("key").agg(F.count_distinct("node").alias("n"))
            assert keys.where("n = 2").count() > 0


def test_index_finds_each_pair():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    fps = np.unique(np.concatenate([base, base ^ np.uint64(5), base ^ np.uint64(1 << 50 | 7)]))
    keys = (fps % np.uint64(3)).astype(np.int64)
    order = np.lexsort((fps, keys))
    keys, fps = keys[order], fps[order]
    got = set(zip(*map(np.ndarray.tolist, simhash.GrayIndex(keys, fps).within(np.arange(len(fps)), 4)), strict=True))
    assert got == {(i, j) for i in range(len(fps)) for j in range(i + 1, len(fps)) if keys[i] == keys[j] and np.bitwise_count(fps[i] ^ fps[j]) <= 4}


def test_components_of_a_long_chain(spark):
    rows = [(i, i + 1) for i in range(200)] + [(500, 501), (7, 7), (None, 3), (501, 500)]
    found = {r.node: r.root for r in components.components(spark.createDataFrame(rows, "a bigint, b bigint")).collect()}
    assert found == {i: 0 for i in range(1, 201)} | {501: 500}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_one_of_each_group(documents):
    docs = documents()
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) and None in ids and 300 in ids
    assert not set(range(100, 104)) & set(ids) and not {301, 302} & set(ids)
    assert simhash.one_of_each(documents([])).count() == 0


def test_one_of_each_tells_rows_apart(documents):
    """Unlike texts under one id stay, all of them; rows without an id are compared like others."""
    one, two, three = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(1, one, "p", None, None), (1, two, "q", None, None), (2, one, "r", None, None), (None, two, "s", None, None)]
    rows += [(None, three, "t", None, None)] * 2 + [(None, three, "u", None, None)]
    kept = simhash.one_of_each(documents(rows)).collect()
    assert sorted((r.doc_id or 0, r.text, r.lang) for r in kept) == [(0, three, "t"), (1, one, "p"), (1, two, "q")]
    prose = documents([(None, " ".join(f"w{i}_{j}" for j in range(30)), None, None, None) for i in range(1000)])
    assert simhash.one_of_each(prose.union(prose)).count() == 1000
