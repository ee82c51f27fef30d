"""The corpus pipeline: stages that turn `documents` into token ids.

Each stage reads what its predecessor kept, decides over all of it and passes
on the columns of documents; the last one returns piece ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dumpflow.llm import line_dedup, mixing, pieces, quality, simhash
from dumpflow.llm.stages import DOCUMENT_COLUMNS, documents, written

MODEL = "piece_bpe_32k.model"


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base limits and the rules learned from `labels`."""
    stats = written(quality.statistics(docs.select(*DOCUMENT_COLUMNS)), "pipeline-statistics", "zstd")
    rules = quality.learn(quality.with_labels(stats, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return quality.judge(stats, rules).where("kept").select(*DOCUMENT_COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that come earlier in the corpus; n_chars follows the text.

    A text of which all goes stays as an empty one.
    """
    rows = line_dedup.without_repeats(docs.select(*DOCUMENT_COLUMNS))
    return rows.withColumn("n_chars", F.length("text").cast("bigint")).select(*DOCUMENT_COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies."""
    return simhash.one_of_each(docs.select(*DOCUMENT_COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Document copies in the order of their finish times, up to the size of all documents together."""
    return mixing.mix(docs.select(*DOCUMENT_COLUMNS)).select(*DOCUMENT_COLUMNS)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, piece ids, and whether decoding them gives the text back."""
    model = public_tokenizers.path(MODEL)
    back = pieces.decode(pieces.encode(docs.select("doc_id", "source", "text"), model), model)
    return back.select("doc_id", "source", "ids", (F.coalesce("text", F.lit("")) == F.col("decoded")).alias("round_trip"))


STAGES = [
    ("quality_rules", drop_low_quality),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("source_mixing", mix_sources),
    ("sentencepiece", encode_pieces),
]

#: Learned rules and piece ids have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as Parquet and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
