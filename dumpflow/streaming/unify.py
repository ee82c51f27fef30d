"""Topics -> union -> JSON -> reference lookup -> table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dumpflow.operators.lookups import lookup_flag
from dumpflow.sources.topics import decode_json, union_topics


def unify_topics(
    topics: Sequence[DataFrame],
    schema: str,
    lookup: DataFrame,
    on: str,
    salts: int = 8,
) -> DataFrame:
    """One stream of decoded events with the lookup's columns and a `found` flag.

    Every event stays, whether its key is known or not. Malformed messages stay
    too, marked by `is_malformed` and with NULL fields. Streaming joins do not
    split hot keys at run time, so each key is dealt out to `salts` tasks. The
    static side is read anew in every batch.
    """
    decoded = decode_json(union_topics(topics), schema).select("topic", "value", "is_malformed", "event.*")
    return lookup_flag(decoded, lookup, on, salts=salts, spread_by=["value"])


def folder_topic(spark: SparkSession, path: str, topic: str, files_per_batch: int | None = None) -> DataFrame:
    """A topic folder written by `replay_to_folder`, read as a stream."""
    reader = spark.readStream.schema("key string, value string, topic string")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path).where(F.col("topic") == topic).select("topic", "value")


def drain(stream: DataFrame, output: str, checkpoint: str) -> None:
    """Process all that is there now, append it to a parquet table and stop.

    Run again with the same checkpoint, it adds only what has arrived since.
    """
    query = (
        stream.writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def drain_and_read(stream: DataFrame, folder: str) -> DataFrame:
    """Drain a stream into a new folder and return the table it made."""
    output, checkpoint = f"{folder}/table", f"{folder}/checkpoint"
    schema = stream.schema
    drain(stream, output, checkpoint)
    return stream.sparkSession.read.schema(schema).parquet(output)
