"""Tables written once to the shared folder and read back by later steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dumpflow.session import fresh_folder, prepare

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def written(rows: DataFrame, purpose: str, compression: str = "snappy", rows_per_file: int = 0) -> DataFrame:
    """Rows read back from Parquet in the folder of `spark.checkpoint.dir`.

    Files survive a lost executor, unlike cached blocks, and later plans start
    at a scan. Spark's writer and reader hold many rows of a file at a time;
    `rows_per_file` bounds them where a row takes megabytes.
    """
    spark = rows.sparkSession
    folder = fresh_folder(spark, purpose)
    rows.write.option("maxRecordsPerFile", rows_per_file).parquet(folder, compression=compression)
    return spark.read.schema(rows.schema).parquet(folder)


def arrow_ready(spark: SparkSession, rows_per_batch: int = 500) -> SparkSession:
    """Settings for Python tasks: small batches, as one text may be very long."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows_per_batch))
    return spark


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/documents.parquet")
