"""Mix sources to target weights by weighted fair queueing.

Every source is a queue of shuffled documents, gone through up to three times.
A document copy finishes at (words of its source up to and with it) / (target
of the source); copies are served by finish time until the total budget is
spent. Running sums are taken in two steps, sums of small shuffle buckets first
and rows inside a bucket second, so that no source and no span of time is
sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dumpflow.llm.stages import written
from dumpflow.llm.text import word_count

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
#: Hexadecimal digits of the shuffle key that name a bucket of a source.
BUCKET_DIGITS = 3
#: Spans of finish time up to time 1, when all targets are met; later ones get wider.
SPANS = 4096


def sources(sized: DataFrame) -> DataFrame:
    """A row per source of (source, size) rows: source_size and target.

    Weights repeat over the sources by code point, NULL last. Targets share the
    sum of all sizes by weight, stop at three times the size of their source,
    and the excess is shared again by weight. In order of stop per weight those
    that stop come before those that share, so one pass settles all.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_stop = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before, everything = by_stop.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    wide = lambda c: c.cast("decimal(38,0)")
    left = lambda c: F.sum(c).over(everything) - F.coalesce(F.sum(c).over(before), F.lit(0))
    total = F.sum("source_size").over(everything)
    spent = F.coalesce(F.sum(MAX_EPOCHS * F.col("source_size")).over(before), F.lit(0))
    rows = (
        sized.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.row_number().over(by_name) - 1) % len(WEIGHTS) + 1))
        .withColumns({"to_share": total - spent, "sharing": left(F.col("weight")), "stop": MAX_EPOCHS * F.col("source_size")})
        .withColumn("stopped", wide(F.col("stop")) * wide(F.col("sharing")) <= wide(F.col("to_share")) * wide(F.col("weight")))
    )
    share = F.min_by(F.struct("to_share", "sharing"), F.when(~F.col("stopped"), F.struct(
        F.col("source_size") / F.col("weight"), F.col("source").isNull(), F.coalesce("source", F.lit(""))))).over(everything)
    return rows.withColumn("share", share).select(
        "source", "source_size",
        F.when(F.col("stopped"), F.col("stop").cast("double"))
        .otherwise((F.col("weight") * F.col("share.to_share")).cast("double") / F.col("share.sharing")).alias("target"),
    )


def _shuffle_key(seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def _queues(docs: DataFrame, seed: int, keep: list[str]) -> DataFrame:
    """Documents with the words of their source up to and with them, written once."""
    queue = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))  # never NULL, so joins keep the partitioning
    sized = docs.select("doc_id", "source", *keep, queue.alias("queue"), word_count(F.col("text")).alias("size"), _shuffle_key(seed).alias("key")).withColumn("bucket", F.left("key", F.lit(BUCKET_DIGITS)))
    small = written(sized.drop(*keep), "mixing-sizes")
    earlier = Window.partitionBy("queue").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    facts = sources(small).select(F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("queue"), "source_size", "target")
    offsets = (
        small.groupBy("queue", "bucket").agg(F.sum("size").alias("words"))
        .select("queue", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset"))
        .join(facts, "queue")
    )
    inside = Window.partitionBy("queue", "bucket").orderBy("key", "doc_id", "size")
    placed = (sized if keep else small).withColumns({
        "upto": F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)), "place": F.row_number().over(inside)})
    return written(placed.join(offsets, ["queue", "bucket"]).withColumn("upto", F.col("upto") + F.col("offset")).drop("offset"), "mixing-queues")


def _served(docs: DataFrame, seed: int, keep: list[str]) -> DataFrame:
    """Every copy of every document, with `finish` and whether the mix takes it."""
    queues = _queues(docs, seed, keep)
    finish = F.try_divide(((F.col("epoch") - 1) * F.col("source_size") + F.col("upto")).cast("double"), F.col("target"))
    copies = (
        queues.select("*", F.explode(F.when(F.col("size") > 0, F.sequence(F.lit(1), F.lit(MAX_EPOCHS))).otherwise(F.array(F.lit(1)))).alias("epoch"))
        .withColumn("finish", F.coalesce(finish, F.lit(0.0)))
        .withColumn("span", F.floor(SPANS * F.log2(1 + F.col("finish"))))
    )
    spans = copies.groupBy("span").agg(F.sum("size").alias("words"))
    spent = spans.select("span", "words", F.sum("words").over(Window.orderBy("span")).alias("spent"))
    budget = queues.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    last = spent.where(F.col("spent") >= budget).orderBy("span").first()
    if last is None:  # no documents
        return copies.withColumn("served", F.lit(True))
    # Only the copies of the last span need their exact order.
    order = Window.partitionBy("span").orderBy("finish", "queue", "key", "doc_id", "size", "place", "epoch").rowsBetween(Window.unboundedPreceding, -1)
    edge = copies.where(F.col("span") == last["span"]).withColumn(
        "served", F.coalesce(F.sum("size").over(order), F.lit(0)) + (last["spent"] - last["words"]) < budget)
    return copies.where(F.col("span") != last["span"]).withColumn("served", F.col("span") < last["span"]).unionByName(edge)


def mix(docs: DataFrame, seed: int = 7) -> DataFrame:
    """Document copies that the mix takes, in the order of their finish times.

    `docs` has `doc_id`, `source` and `text`; all its columns stay, and
    `mix_epoch` (from 1), `mix_target` and `mix_finish` are added, in place of
    columns of these names. NULL is a source of its own. A NULL or empty text
    has size 0: it is taken once if its queue gets there, and spends nothing.
    The copy that reaches the budget, the sum of all sizes, is the last of some
    size. Repeated rows are documents of their own. No documents: no rows.
    """
    added = ("mix_epoch", "mix_target", "mix_finish")
    columns = [c for c in docs.columns if c not in added]
    packed = docs.select("doc_id", "source", "text", F.struct(*columns).alias("mix_row"))
    copies = _served(packed, seed, ["mix_row"]).where("served")
    return copies.select(
        *(F.col("mix_row")[c].alias(c) for c in columns),
        F.col("epoch").alias("mix_epoch"), F.col("target").alias("mix_target"), F.col("finish").alias("mix_finish"),
    ).orderBy("mix_finish", "doc_id", "mix_epoch")


def taken(docs: DataFrame, seed: int = 7) -> DataFrame:
    """A row per document: size, source_size, target and the words that the mix takes of it."""
    return (
        _served(docs.select("doc_id", "source", "text"), seed, [])
        .groupBy("queue", "bucket", "place")
        .agg(*(F.first(c).alias(c) for c in ("doc_id", "size", "source_size", "target")),
             F.coalesce(F.sum(F.when(F.col("served"), F.col("size"))), F.lit(0)).alias("taken"))
        .drop("queue", "bucket", "place")
    )


TAKEN_SQL = f"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         md5('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key, coalesce('=' || source, '') AS queue
  FROM documents),
s AS (
  SELECT *, ([5, 2, 1])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::HUGEINT AS weight
  FROM (SELECT source, queue, sum(size)::HUGEINT AS source_size FROM d GROUP BY source, queue)),
-- For each source: what is shared, and by which weights, if it and all with a higher stop per weight share.
o AS (
  SELECT *, sum(source_size) OVER () - coalesce(sum({MAX_EPOCHS} * source_size) OVER before, 0) AS to_share,
         sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS sharing,
         row_number() OVER (ORDER BY source_size / weight, source NULLS LAST) AS nr
  FROM s WINDOW before AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, {MAX_EPOCHS} * source_size * sharing <= to_share * weight AS stopped FROM o),
f AS (SELECT to_share AS a, sharing AS b FROM c WHERE NOT stopped ORDER BY nr LIMIT 1),
t AS (
  SELECT queue, source_size, CASE WHEN stopped THEN CAST({MAX_EPOCHS} * source_size AS DOUBLE)
         ELSE CAST(weight * (SELECT a FROM f) AS DOUBLE) / CAST((SELECT b FROM f) AS DOUBLE) END AS target FROM c),
q AS (
  SELECT d.*, t.source_size, t.target,
         sum(size) OVER (PARTITION BY queue ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto
  FROM d JOIN t USING (queue)),
e AS (
  SELECT *, CASE WHEN target = 0 THEN 0 ELSE CAST((epoch - 1) * source_size + upto AS DOUBLE) / target END AS finish
  FROM q, (SELECT unnest([1, 2, 3]) AS epoch) WHERE size > 0 OR epoch = 1),
r AS (
  SELECT *, coalesce(sum(size) OVER (ORDER BY finish, queue, key, doc_id, size, epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
            < (SELECT sum(size) FROM d) AS served FROM e)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST(sum(CASE WHEN served THEN size ELSE 0 END) AS BIGINT) AS taken
FROM r GROUP BY doc_id, size, source_size, target, key, upto
"""
