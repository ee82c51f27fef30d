"""Message topics as streaming or batch frames of `(topic, value)`."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dumpflow.functions.text import once


def read_topic(spark: SparkSession, topic: str, options: dict[str, str], source: str = "kafka") -> DataFrame:
    """Stream of one topic's string values. Needs the connector of `source`, or `use_topic_log` for a `topic_log`."""
    raw = spark.readStream.format(source).options(**options).option("subscribe" if source == "kafka" else "topic", topic)
    return raw.load().select(F.lit(topic).alias("topic"), F.col("value").cast("string").alias("value"))


def union_topics(streams: Sequence[DataFrame]) -> DataFrame:
    """All topics as one frame. It is an error to pass none."""
    if not streams:
        raise ValueError("no topics given")
    out = streams[0]
    for stream in streams[1:]:
        out = out.unionByName(stream)
    return out


def of_topics(messages: DataFrame, topics: Sequence[str], progress: str = "topics") -> DataFrame:
    """The messages of some topics out of one source that holds many, read once for all of them.

    A streaming query's progress has the count of each topic's messages per batch, as the
    observed metric `progress`.
    """
    counts = [F.count_if(F.col("topic") == topic).alias(topic) for topic in topics]
    return messages.where(F.col("topic").isin(*topics)).observe(progress, *counts)


def decode_json(rows: DataFrame, schema: str, text: str = "value", into: str = "event") -> DataFrame:
    """Decode a JSON column by a DDL schema; `is_malformed` marks text that is no JSON object."""
    broken = f"{schema}, _broken string"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}
    decoded = rows.withColumn(into, F.from_json(F.col(text), broken, options))
    bad = F.col(into).isNull() | F.col(f"{into}._broken").isNotNull()
    return decoded.select(
        *rows.columns,
        bad.alias("is_malformed"),
        F.when(~bad, F.col(into).dropFields("_broken")).alias(into),
    )


def open_messages(rows: DataFrame, text: str = "value") -> DataFrame:
    """Add a JSON message's fields as two maps, each parsed once.

    `_top` holds the fields of the message, nested ones as JSON text, and `_inner`
    those of its `tuple_struct`. A key with a null value is present in a map. Both
    are NULL where there is no such object. Of a repeated key the last value counts.
    """
    fields = "map<string,string>"
    top = once(rows, "_top", _last_wins(F.from_json(text, fields)))
    return once(top, "_inner", _last_wins(F.from_json(F.try_element_at("_top", F.lit("tuple_struct")), fields)))


def _last_wins(fields: Column) -> Column:
    """A map as JSON reading makes it, which may hold a key twice, with the last value of each key."""
    def last(keys: Column, values: Column) -> Column:
        later = lambda key, i: F.array_contains(F.slice(keys, i + 2, F.greatest(F.size(keys), F.lit(1))), key)
        kept = F.filter(F.sequence(F.lit(0), F.size(keys) - 1), lambda i: ~later(keys[i], i))
        return F.map_from_arrays(F.transform(kept, lambda i: keys[i]), F.transform(kept, lambda i: values[i]))

    split = F.array(F.struct(F.map_keys(fields).alias("k"), F.map_values(fields).alias("v")))
    distinct = F.element_at(F.transform(split, lambda m: F.when(
        F.size(m["k"]) > F.size(F.array_distinct(m["k"])), last(m["k"], m["v"]))), 1)
    return F.coalesce(distinct, fields)


def has_key(fields: Column, key: str) -> Column:
    """Whether a field map has a key. False, never NULL."""
    return F.coalesce(F.map_contains_key(fields, key), F.lit(False))
