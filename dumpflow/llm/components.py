"""Connected components of links, by alternating large and small stars.

Both steps are an aggregate and a join over links, so no node's links meet in
one place and nothing is gathered on the driver but a row count and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dumpflow.llm.stages import written


def _checksum(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("node", "root"))).first())


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """`node` and `root`, the smallest node that it reaches, for all linked nodes but roots.

    `links` holds pairs `a`, `b` in any order, repeats and loops included. Pairs
    with a NULL are left out. No links: no rows.
    """
    pairs = links.where(F.col("a") != F.col("b"))
    now = written(pairs.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")).distinct(), "links")
    seen = _checksum(now)
    for _ in range(max_rounds):
        # Large star: larger neighbours of a node move to its smallest neighbour.
        both = now.union(now.select("root", "node")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("node"), F.col("m").alias("root")).distinct()
        # Small star: a node and its smaller neighbours move to the smallest of these.
        least = large.groupBy("node").agg(F.min("root").alias("m"))
        moved = large.join(least, "node")
        small = moved.where(F.col("root") != F.col("m")).select(F.col("root").alias("node"), F.col("m").alias("root"))
        now = written(small.union(least.toDF("node", "root")).distinct(), "links")
        before, seen = seen, _checksum(now)
        if seen == before:
            return now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
