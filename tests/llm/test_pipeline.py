from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from check import compare, open_tables
from dumpflow.llm import queries
from tests.llm.conftest import SCHEMA

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_runs_and_agrees(spark, name):
    outcome, _ = compare(spark, open_tables(FOLDER), name, FOLDER)
    assert outcome.startswith(("ok", "rows only")), outcome


def test_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 11)) and "pipeline" in contract.queries()


def test_pipeline_follows_its_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    before = {r.doc_id: r for r in docs.collect()}
    kept = None
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, FOLDER), name)
        rows = docs.collect()
        if name != "sentencepiece":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        ids = {r.doc_id for r in rows}
        assert ids <= (kept or set(before))
        if name == "quality_rules":
            assert all(tuple(r) == tuple(before[r.doc_id]) for r in rows)
        if name == "line_dedup":
            assert ids == kept
        if name == "sentencepiece":
            assert all(r.round_trip for r in rows) and ids == kept
        kept = ids
    clean = {r.doc_id for r in spark.read.parquet(f"{FOLDER}/labels.parquet").where("quality = 1").collect()} & {i for i, r in before.items() if len(r.text.split()) >= 50}
    first = {r.doc_id for r in corpus_pipeline.drop_low_quality(spark, spark.read.parquet(f"{FOLDER}/documents.parquet"), FOLDER).collect()}
    assert len(clean - first) <= 0.02 * len(clean)


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None), (1, "", None, None, None), (1, "", None, None, None)]])
def test_stages_take_awkward_tables(spark, rows):
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(rows, SCHEMA)
        assert stage(spark, docs, FOLDER).count() <= max(1, len(rows)) * 3
