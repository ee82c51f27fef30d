"""At-least-once delivery: drop repeated messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_repeats(stream: DataFrame, keys: Sequence[str], within: str, event_time: str | None = None) -> DataFrame:
    """Keep the first of equal messages within a time of each other.

    `within` bounds how long keys are held in state. By default time is that of
    arrival: a message about the distant past is never taken for late and dropped,
    but which repeats are seen depends on when the job runs. With `event_time` it
    is that column's: results do not depend on the run, repeats after an outage
    are found, and messages later than `within` behind the newest are dropped.
    Repeats from further apart pass; the page fold absorbs those, as it drops
    equal elements for good.
    """
    if event_time is not None:
        return stream.withWatermark(event_time, within).dropDuplicatesWithinWatermark(list(keys))
    arrived = stream.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", within)
    return arrived.dropDuplicatesWithinWatermark(list(keys)).drop("_arrived")
