"""Registered queries of the corpus operators, each over its whole table, and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dumpflow.llm import alignment, extraction, fingerprints, language, line_dedup, lm, mixing, passages, pieces, quality, runs, simhash, token_files
from dumpflow.llm.stages import documents, written
from dumpflow.session import fresh_folder, prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its own name."""
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            CHECKS[fn.__name__] = sql
        return fn

    return register


@query()
def op1_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lm.score(documents(spark, folder).select("doc_id", "text"))


@query(line_dedup.REMOVED_SQL)
def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.removed_by_document(documents(spark, folder))


@query()
def op3_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    encoded = pieces.encode(documents(spark, folder).select("doc_id", "text"), model)
    back = pieces.decode(encoded, model)
    return back.select("doc_id", F.size("ids").cast("bigint").alias("n_pieces"), "ids", (F.coalesce("text", F.lit("")) == F.col("decoded")).alias("round_trip"))


@query()
def op4_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, folder).select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query()
def op5_token_files(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    return token_files.as_written(docs, fresh_folder(spark, "token-files"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)


@query(mixing.TAKEN_SQL)
def op6_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.taken(documents(spark, folder))


@query()
def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.with_held_out(documents(spark, folder).select("doc_id", "lang", "text"))


@query()
def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    stats = written(quality.statistics(documents(spark, folder).select("doc_id", "text")).drop("text"), "quality-statistics")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rules = quality.learn(quality.with_labels(stats, labels))
    return quality.judge(stats, rules).select("doc_id", *quality.BASE, "base_failed", "kept", "rule", *quality.FURTHER)


@query()
def op9_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.compare_edited(documents(spark, folder))


@query()
def op10_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return extraction.extract(prepare(spark).read.parquet(f"{folder}/pages.parquet").select("page_id", "url", "html"))


@query(passages.REMOVED_SQL)
def op11_passage_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = passages.without_repeats(documents(spark, folder).select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query(runs.RUNS_SQL)
def op12_word_runs(spark: SparkSession, folder: str) -> DataFrame:
    return runs.digests(runs.find(runs.with_planted_runs(documents(spark, folder).select("doc_id", "text"))))


@query()
def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    a, b = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    found = alignment.align(documents(spark, folder).select("doc_id", "text"), a, b)
    return found.withColumn("groups_sha256", F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))).drop("groups")
