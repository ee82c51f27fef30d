"""Record envelopes, message routing and keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dumpflow import fixed_values as fx
from dumpflow.functions.ids import key_text
from dumpflow.sources.topics import has_key

_JSON = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ssXXX"}


def as_json(*columns) -> Column:
    """Columns as one JSON object, NULLs written out, times in ISO form."""
    return F.to_json(F.struct(*columns), _JSON)


def struct_json(struct: Column) -> Column:
    return F.to_json(struct, _JSON)


def stamp_ingest(records: DataFrame, run_time: Column) -> DataFrame:
    """Set `timestamp` to the time of the run. The time is given, so that reruns agree."""
    return records.withColumn("timestamp", run_time)


def route_schema(messages: DataFrame, topic: str = "topic") -> DataFrame:
    """Add the record type of opened JSON messages as `schema_name`.

    An explicit `_schema_name` wins, then the keys in `tuple_struct` decide, then
    the topic. Link messages carry a `direction`; without one they are outbound.
    """
    top, inner = F.col("_top"), F.col("_inner")
    by_topic = F.initcap(F.replace(F.col(topic), F.lit("_topic"), F.lit("")))
    for name, schema in fx.TOPIC_SCHEMAS.items():
        by_topic = F.when(F.col(topic) == name, F.lit(schema)).otherwise(by_topic)
    inbound = F.try_element_at(top, F.lit("direction")) == "inbound"
    schema_name = (
        F.when(has_key(top, "_schema_name"), F.try_element_at(top, F.lit("_schema_name")))
        .when(has_key(inner, "rev_id"), "RevisionData")
        .when(has_key(inner, "access_type"), "PageView")
        .when(has_key(inner, "target_page"), "ClickStream")
        .when(has_key(inner, "pl_from"), F.when(inbound, "InboundPageLinks").otherwise("OutboundPageLinks"))
        .when(has_key(inner, "title"), F.when(has_key(top, "wiki_code"), "WikiDocument").otherwise("TitleIdMapping"))
        .when(has_key(inner, "page_title"), "PageInfo")
        .otherwise(by_topic)
    )
    return messages.withColumn("schema_name", schema_name)


def message_field(path: str) -> Column:
    """A field of an opened message by its dotted path, as text."""
    parent, _, key = path.rpartition(".")
    if parent not in ("", "tuple_struct"):
        raise ValueError(f"no such part of a message: {parent}")
    return F.try_element_at("_inner" if parent else "_top", F.lit(key))


def partition_key(schema_name: Column) -> Column:
    """Key of opened messages by record type; NULL for types without one (no key, spread freely)."""
    out = F.lit(None).cast("string")
    for schema, paths in fx.PARTITION_KEYS.items():
        out = F.when(schema_name == schema, key_text(*[message_field(p) for p in paths])).otherwise(out)
    return out


def typed_partition_key(schema_name: str) -> Column:
    """Message key of a frame of one known record type, straight from its columns."""
    return key_text(*[F.col(path) for path in fx.PARTITION_KEYS[schema_name]])


def composite_key(*parts: Column) -> Column:
    return key_text(*parts)


def pageview_composite_key(records: DataFrame) -> Column:
    t = records["tuple_struct"]
    return composite_key(t["access_type"], t["user_type"], records["year_month"])


def clickstream_composite_key(records: DataFrame) -> Column:
    return composite_key(records["year_month"], records["tuple_struct"]["target_page"])


def metadata_map() -> Column:
    """Top-level fields of opened messages but their key fields, as `metadata.<name>`."""
    kept = F.map_filter("_top", lambda k, v: ~k.isin(*fx.DOCUMENT_KEY_FIELDS))
    return F.transform_keys(kept, lambda k, v: F.concat(F.lit("metadata."), k))


def message_rows(records: DataFrame, topic: str | Column, schema_name: str, key: Column | None = None) -> DataFrame:
    """`(topic, key, value)` rows ready for a message sink. A given key wins over the type's own.

    A frame of several record types has its topic and key as columns.
    """
    if key is None and schema_name in fx.PARTITION_KEYS:
        key = typed_partition_key(schema_name)
    return records.select(
        F.lit(topic).alias("topic"),
        (F.lit(None).cast("string") if key is None else key).alias("key"),
        as_json(*records.columns).alias("value"),
    )
