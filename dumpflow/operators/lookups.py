"""Joins of a large frame to a reference table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: str | Sequence[str],
    how: str = "left",
    salts: int = 1,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Join facts to a lookup that has one row per key.

    No broadcast is forced: Spark broadcasts the lookup only when its size, from
    file statistics or measured at run time, is under the session's threshold.
    Beyond it, batch joins rely on adaptive skew splitting for hot keys.
    Streaming plans are not adaptive, so for them `salts` > 1 deals each key's
    facts out to that many tasks, by a hash of `spread_by`, against as many copies
    of the lookup row. The copies are many times what file statistics say, so they
    are sorted and merged, which spills, and never held whole by a task as a broadcast.
    Facts without a key match nothing; they are dealt out to all
    tasks. Results do not depend on `salts`.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if salts <= 1:
        return facts.join(lookup, keys, how)
    spread = list(spread_by or facts.columns)
    no_key = F.exists(F.array(*[F.col(k).isNull() for k in keys]), lambda missing: missing)
    salt = F.xxhash64(*spread)
    dealt = facts.withColumn("_salt", F.when(no_key, salt).otherwise(F.pmod(salt, F.lit(salts))))
    copies = lookup.select("*", F.explode(F.sequence(*(F.lit(n).cast("bigint") for n in (0, salts - 1)))).alias("_salt"))
    return dealt.join(copies.hint("merge"), [*keys, "_salt"], how).drop("_salt")


def lookup_flag(facts: DataFrame, lookup: DataFrame, on: str, flag: str = "found", **options) -> DataFrame:
    """All facts with the lookup's columns and whether the key was there."""
    marked = lookup.withColumn(flag, F.lit(True))
    return lookup_join(facts, marked, on, **options).withColumn(flag, F.coalesce(flag, F.lit(False)))


def upsert_split(existing: DataFrame, incoming: DataFrame, key: Sequence[str]) -> DataFrame:
    """Each incoming key with what a write would do to it: insert or update.

    Both sides shrink to their distinct keys by one partial aggregation, so a key
    that holds most rows costs no more than any other.
    """
    keys = list(key)
    tagged = existing.select(*keys, F.lit(1).alias("old"), F.lit(0).alias("new")).unionByName(
        incoming.select(*keys, F.lit(0).alias("old"), F.lit(1).alias("new"))
    )
    seen = tagged.groupBy(*keys).agg(F.max("old").alias("old"), F.max("new").alias("new"))
    return seen.where("new = 1").select(*keys, F.when(F.col("old") == 1, "update").otherwise("insert").alias("action"))
