"""Page documents kept current: each batch re-folds only the buckets of pages that it touches.

A table holds, per bucket of pages, the distinct elements of its pages and
the fold of each page. A batch merges its own elements with those of the buckets
it touches and writes these buckets again under a version named after the batch.
The last step of a batch is one small file, a commit, that says which version of
each bucket counts. Readers follow the newest commit and aggregate nothing; a
batch that died before its commit has changed nothing, and one that is run
again after it is passed over.

    <path>/commits/commit=<n>             bucket, version, source
    <path>/elements/version=<v>/bucket=<b>  elements with first and last time seen
    <path>/pages/version=<v>/bucket=<b>     a row per page

A bucket is a set of whole pages, so that a page's fold needs no other bucket;
inside a bucket the merge shuffles by element, so one page with most of the
rows is merged by many tasks and written as many files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dumpflow import fixed_values as fx
from dumpflow.operators.pages import PAGE_KEY, fold_elements, page_elements
from dumpflow.streaming.fold import BadRows, batch_name

COMMIT = "bucket int, version string, source string, commit bigint"
ELEMENT = "wiki_code string, page_hash string, kind string, element string, first_seen timestamp, last_seen timestamp, version string, bucket int"
SIZES = [f"n_{kind}" for kind in fx.ELEMENT_KINDS]
PAGE = (
    "wiki_code string, page_hash string, " + ", ".join(f"{c} bigint" for c in SIZES)
    + ", created_at timestamp, last_updated timestamp, current_title string, version string, bucket int"
)
FOLD_COLUMNS = [*PAGE_KEY, *SIZES, "created_at", "last_updated", "current_title"]


def bucket_of(buckets: int) -> Column:
    """The bucket of a row's page."""
    return F.pmod(F.xxhash64(*PAGE_KEY), F.lit(buckets)).cast("int")


def _commit(spark: SparkSession, path: str, number: int, versions: dict[int, str | None], source: str) -> None:
    rows = spark.createDataFrame([(b, v, source) for b, v in sorted(versions.items())], "bucket int, version string, source string")
    rows.coalesce(1).write.mode("overwrite").parquet(f"{path}/commits/commit={number}")


def create_kept(spark: SparkSession, path: str, buckets: int = 256) -> None:
    """An empty table; the number of buckets is that of the table from now on.

    Take so many that a bucket is some hundred megabytes: a batch writes all of each bucket that it touches.
    """
    _commit(spark, path.rstrip("/"), 0, dict.fromkeys(range(buckets)), "")


def _commits(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(COMMIT).parquet(f"{path}/commits")


def current_versions(spark: SparkSession, path: str) -> tuple[int, dict[int, str | None]]:
    """The newest commit's number and its version of each bucket."""
    rows = _commits(spark, path.rstrip("/"))
    newest = rows.agg(F.max("commit")).first()[0]
    return newest, {r.bucket: r.version for r in rows.where(F.col("commit") == newest).collect()}


def _read(spark: SparkSession, path: str, part: str, schema: str, versions: dict[int, str | None]) -> DataFrame:
    folders = [f"{path}/{part}/version={v}/bucket={b}" for b, v in sorted(versions.items()) if v is not None]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{path}/{part}").parquet(*folders)


def merge_batch(facts: DataFrame, path: str, name: str) -> list[int]:
    """Merge a batch of facts into the table and return the buckets that were written.

    `name` tells the batch from all others: a batch that is in the table already
    is passed over. One writer at a time.
    """
    spark, path = facts.sparkSession, path.rstrip("/")
    if _commits(spark, path).where(F.col("source") == name).limit(1).count():
        return []
    number, versions = current_versions(spark, path)
    # The batch's own elements, written once: they tell the buckets, and the merge reads them again.
    incoming = f"{path}/incoming/{name}"
    page_elements(facts).withColumn("bucket", bucket_of(len(versions))).write.mode("overwrite").parquet(incoming)
    new = spark.read.parquet(incoming)
    touched = [r.bucket for r in new.select("bucket").distinct().collect()]  # as many as buckets at most
    if touched:
        old = _read(spark, path, "elements", ELEMENT, {b: versions[b] for b in touched}).drop("version")
        merged = new  # distinct already, so buckets without a version are written as they are
        if any(versions[b] is not None for b in touched):
            merged = old.unionByName(new).groupBy("bucket", *PAGE_KEY, "kind", "element").agg(
                F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"))
        _write(merged, f"{path}/elements/version={name}")
        written = _read(spark, path, "elements", ELEMENT, dict.fromkeys(touched, name)).drop("version")
        _write(fold_elements(written, "bucket"), f"{path}/pages/version={name}")
    _commit(spark, path, number + 1, versions | dict.fromkeys(touched, name), name)
    return sorted(touched)


def _write(rows: DataFrame, folder: str) -> None:
    rows.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(folder)


def read_kept(spark: SparkSession, path: str, pages: DataFrame | None = None) -> DataFrame:
    """The fold of every page as of the newest commit, or of the pages (wiki_code, page_hash) asked for.

    Pages that are asked for are looked up in their buckets: their number is bounded by the caller.
    """
    path = path.rstrip("/")
    _, versions = current_versions(spark, path)
    if pages is None:
        return _read(spark, path, "pages", PAGE, versions).select(*FOLD_COLUMNS)
    wanted = pages.select(*PAGE_KEY).distinct()
    buckets = {r[0] for r in wanted.select(bucket_of(len(versions))).distinct().collect()}
    rows = _read(spark, path, "pages", PAGE, {b: versions[b] for b in buckets})
    return rows.join(wanted, list(PAGE_KEY), "left_semi").select(*FOLD_COLUMNS)


def read_elements(spark: SparkSession, path: str) -> DataFrame:
    """All distinct elements as of the newest commit."""
    path = path.rstrip("/")
    return _read(spark, path, "elements", ELEMENT, current_versions(spark, path)[1]).drop("version", "bucket")


def drop_old_versions(spark: SparkSession, path: str) -> int:
    """Delete the buckets' versions, and the batches' own elements, that the newest commit does not name.

    Call it while no batch runs and no reader holds an older commit; returns the number of folders deleted.
    """
    path, dropped = path.rstrip("/"), 0
    _, versions = current_versions(spark, path)
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def children(folder: str) -> list[tuple[str, object]]:
        at = jvm.org.apache.hadoop.fs.Path(f"{path}/{folder}")
        return [(f.getPath().getName(), f.getPath()) for f in fs.listStatus(at)] if fs.exists(at) else []

    for part in ("elements", "pages"):
        for version, _ in children(part):
            for bucket, at in children(f"{part}/{version}"):
                if bucket.startswith("bucket=") and versions[int(bucket[7:])] != version.removeprefix("version="):
                    dropped += fs.delete(at, True)
    for _, at in children("incoming"):
        dropped += fs.delete(at, True)
    return dropped


def keep_stream(facts: DataFrame, path: str, checkpoint: str, on_bad: BadRows | None = None, **trigger):
    """Start a query that keeps the table at `path` current with a stream of facts.

    Rows without a page go to `on_bad` and do not stop their batch.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        has_page = F.col("page_hash").isNotNull()
        if on_bad is None:
            merge_batch(batch.where(has_page), path, batch_name(batch, batch_id))  # one read of the source
            return
        batch.persist()  # two reads, one of the source
        try:
            merge_batch(batch.where(has_page), path, batch_name(batch, batch_id))
            on_bad(batch.where(~has_page), batch_id)
        finally:
            batch.unpersist()

    return (
        facts.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
