from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from dumpflow.llm import language


def test_codewords_stand_apart():
    for count in (2, 3, 4, 7, 20):
        code = language.codewords(count)
        assert code.any(axis=0).all() and not code.all(axis=0).any()
        assert min((code[i] ^ code[j]).sum() for i in range(count) for j in range(i)) >= (1 if count == 2 else 2 if count == 3 else 4)


def test_ngrams_do_not_cross_texts():
    one, two = language._letters("ab cd"), language._letters("Éx")
    alone = [np.concatenate([b for _, b in language._buckets([t])]) for t in (one, two)]
    owner, bucket = (np.concatenate(x) for x in zip(*language._buckets([one, b"", two]), strict=True))
    assert sorted(bucket[owner == 0]) == sorted(alone[0]) and sorted(bucket[owner == 2]) == sorted(alone[1])


def test_slices_count_all(monkeypatch):
    text = language._letters("some words that are cut into slices of a few letters each")
    whole = np.concatenate([b for _, b in language._buckets([text])])
    monkeypatch.setattr(language, "AT_ONCE", 7)
    assert sorted(np.concatenate([b for _, b in language._buckets([text])])) == sorted(whole)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language.with_held_out(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 200
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_only_text_counts(spark, documents):
    docs = documents()
    model = language.learn(docs.where("doc_id < 10"))
    a = language.predict(docs.select("doc_id", "text"), model).collect()
    b = language.predict(docs.select((F.col("doc_id") + 1000).alias("doc_id"), "text"), model).collect()
    assert [(r.lang_pred, r.score) for r in a] == [(r.lang_pred, r.score) for r in b]


@pytest.mark.parametrize("langs", [[], ["en"], ["en", "fr"]])
def test_awkward_rows(documents, langs):
    docs = documents().withColumns({"score": F.lit("clash"), "ambiguous": F.lit(3)})
    model = language.learn(docs.where(F.col("lang").isin(langs)) if langs else docs.where("false"))
    rows = language.predict(docs, model).collect()
    assert len(rows) == docs.count()
    for r in rows:
        letters = r.text is not None and any(c.isalpha() for c in r.text)
        assert r.lang_pred in (langs or ["und"]) if letters else (r.lang_pred, r.score) == ("und", 0.0)
    assert language.with_held_out(documents([])).count() == 0


def test_letters_are_what_unicode_calls_so():
    assert [language._letters(t) for t in ("²", "½ ①", "Ⅷ", "12 _", None)] == [b""] * 5
    assert language._letters("M² a½b").split() == [b"m", b"a", b"b"]
