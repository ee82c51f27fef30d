"""Continuous page fold: every micro-batch adds its facts to a batch table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dumpflow.sinks.tables import append_batch

BadRows = Callable[[DataFrame, int], None]


def batch_name(batch: DataFrame, batch_id: int) -> str:
    """A name for a micro-batch that no other query's batch has, and that a rerun has again."""
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not query:
        raise RuntimeError("the batch does not tell its query")
    return f"{query}-{batch_id}"


def fold_stream(facts: DataFrame, path: str, checkpoint: str, on_bad: BadRows | None = None, **trigger):
    """Start a query that appends a stream of facts to the table at `path`.

    Rows without a page go to `on_bad` and do not stop their batch. The query's id,
    which lives in its checkpoint, and the batch id name the folder, so a batch
    that is run again replaces itself and no other query's.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        name = batch_name(batch, batch_id)
        has_page = F.col("page_hash").isNotNull()
        if on_bad is None:
            append_batch(batch.where(has_page), path, name)
            return
        # Two writes read the batch, so its source is read once and kept on executors.
        batch.persist()
        try:
            append_batch(batch.where(has_page), path, name)
            on_bad(batch.where(~has_page), batch_id)
        finally:
            batch.unpersist()

    return (
        facts.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
