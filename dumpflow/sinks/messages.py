"""Message sinks: rows of `(topic, key, value)` to a broker or a topic folder."""

from __future__ import annotations

from pyspark.sql import DataFrame


def send_batch(messages: DataFrame, options: dict[str, str], sink: str = "kafka") -> None:
    """Add a batch of message rows to a broker, or to a `topic_log`. Needs the connector of `sink`."""
    messages.write.format(sink).options(**options).mode("append").save()


def send_stream(messages: DataFrame, options: dict[str, str], checkpoint: str, sink: str = "kafka", **trigger):
    """Start a query that writes a stream of message rows to a broker, or to a `topic_log`."""
    writer = messages.writeStream.format(sink).options(**options).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def replay_to_folder(messages: DataFrame, path: str) -> None:
    """Write message rows to a folder per topic, which a file stream can read."""
    messages.write.mode("append").partitionBy("topic").parquet(path)
