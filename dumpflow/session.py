"""Session settings and the shared folder for checkpoints and drained streams."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even where that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Keys of a stream are held on local disk with the heap as a cache, and kept in its checkpoint.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings that the operators rely on."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach, taken from `spark.checkpoint.dir`.

    Only a local session without that setting gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix="dumpflow-")
    raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """A new path under the shared folder; nothing is created yet."""
    return f"{shared_folder(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def cut_lineage(rows: DataFrame) -> DataFrame:
    """Write rows to the shared folder once, for plans that read them more than once.

    Parquet rather than a checkpoint: columns that a plan does not need are not
    read, and joins know the size.
    """
    folder = fresh_folder(rows.sparkSession, "kept")
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)
