from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from dumpflow.llm import fingerprints


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def likeness(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.mark.parametrize("parts", [2, 1024])
def test_edited_texts(documents, monkeypatch, parts):
    monkeypatch.setattr(fingerprints.with_next, "__defaults__", (parts,))
    docs = documents().where("doc_id is not null and doc_id <> 5").withColumn("part", F.lit("clash"))
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), reverse=True)
    got = {r.doc_id: r for r in fingerprints.compare_edited(docs).collect()}
    assert len(got) == len(rows)
    for at, (i, text) in enumerate(rows):
        following = rows[(at + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        r = got[i]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        # A sketch holds all shingles of a short text; for longer ones the estimate is near.
        small = len(shingles(text) | shingles(edited) | shingles(following)) <= fingerprints.K
        assert r.near_edited == pytest.approx(likeness(text, edited), abs=1e-9 if small else 0.2)
        assert r.near_next == pytest.approx(likeness(text, following), abs=1e-9 if small else 0.2)


def test_equal_texts_have_equal_fingerprints(documents):
    got = fingerprints.compare_edited(documents()).collect()
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, r.fingerprint)
    assert all(by_id[i] == by_id[100 + i] != "" for i in range(4)) and by_id[300] == by_id[301] == by_id[302] == ""
    assert len(got) == documents().count()


def test_one_and_no_document(documents):
    r = fingerprints.compare_edited(documents([(1, "a b c d e f", None, None, None)])).first()
    assert (r.near_next, r.n_chars) == (1.0, 11)
    assert fingerprints.compare_edited(documents([(None, None, None, None, None)])).first().near_next == 1.0
    assert fingerprints.compare_edited(documents([])).count() == 0


def test_parts_merge(documents, spark):
    text = " ".join(f"w{i * i % 701}" for i in range(900))
    words = text.split()
    parts = [(k % 2 if k else None, " ".join(words[a : a + 104])) for k, a in enumerate(range(0, 900, 100))]
    rows = spark.createDataFrame([(None if k is None else 1, t) for k, t in parts], "g int, text string").select(F.lit(1).alias("g"), fingerprints.sketch(F.col("text")).alias("sketch"))
    merged = fingerprints.merge_sketches(rows, ["g"]).first().sketch
    whole = spark.createDataFrame([(text,)], "text string").select(fingerprints.sketch(F.col("text")).alias("s"), fingerprints.distinct_shingles(fingerprints.sketch(F.col("text"))).alias("n")).first()
    assert merged == whole.s and len(merged) == fingerprints.K
    assert whole.n == pytest.approx(len(shingles(text)), rel=0.3)


def test_containment(spark):
    words = [f"w{i}" for i in range(1000)]
    frame = spark.createDataFrame([(" ".join(words[:500]), " ".join(words))], "a string, b string")
    a, b = fingerprints.sketch(F.col("a")), fingerprints.sketch(F.col("b"))
    r = frame.select(fingerprints.containment(a, b).alias("ab"), fingerprints.containment(b, a).alias("ba"), fingerprints.resemblance(a, b).alias("r")).first()
    assert r.ab > 0.8 and abs(r.ba - 0.5) < 0.15 and abs(r.r - 0.5) < 0.15
