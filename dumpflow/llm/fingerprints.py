"""Document fingerprints: the k smallest distinct shingle hashes of a text.

The k smallest hashes of a union are among the k smallest of its parts, so
sketches of parts merge into the sketch of the whole. The k smallest of two
sketches together are a uniform sample of both texts' shingles, and the share
of that sample which both hold estimates their resemblance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dumpflow.functions.text import once
from dumpflow.llm.text import let, lower_ascii, words_of

K, SHINGLE = 128, 5


def sketch(text: Column, k: int = K, shingle: int = SHINGLE) -> Column:
    """Ascending bottom-k hashes of the runs of `shingle` words, A-Z lower-cased.

    A text with fewer words has one shingle, all of them; one without a word,
    or NULL, has an empty sketch. Repeated shingles count once.
    """
    def smallest(w: Column) -> Column:
        # get() gives NULL past the end, which the hash skips.
        hashes = F.transform(
            F.sequence(F.lit(0), F.greatest(F.size(w) - shingle, F.lit(0))),
            lambda i: F.xxhash64(*(F.get(w, i + j) for j in range(shingle))),
        )
        return F.when(F.size(w) > 0, F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)).otherwise(
            F.array().cast("array<bigint>"))

    return let(words_of(lower_ascii(text)), smallest)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_sketches(rows: DataFrame, keys: list[str], sketches: str = "sketch", k: int = K) -> DataFrame:
    """A merged sketch per group. Rows past the k-th distinct hash go before the shuffle.

    Groups of NULL keys merge as well; a group of empty sketches has no row.
    """
    ranks = Window.partitionBy(*keys).orderBy("hash")
    hashes = rows.select(*keys, F.explode(sketches).alias("hash"))
    return (
        hashes.withColumn("rank", F.dense_rank().over(ranks)).where(F.col("rank") <= k)
        .groupBy(*keys).agg(F.sort_array(F.collect_set("hash")).alias(sketches))
    )


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard likeness of two texts; 1 for two empty ones, exact below k shingles."""
    return F.coalesce(let(merged(a, b, k), lambda both: F.try_divide(
        F.size(F.array_intersect(F.array_intersect(a, b), both)).cast("double"), F.size(both))), F.lit(1.0))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    at = (F.element_at(a, k).cast("double") + 2.0**63) / 2.0**64
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / at)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the first text's shingles that the second holds; 1 for an empty first text."""
    together = distinct_shingles(merged(a, b, k), k)
    return F.least(F.lit(1.0), F.coalesce(
        F.try_divide(resemblance(a, b, k) * together, distinct_shingles(a, k)), F.lit(1.0)))


def as_text(a: Column) -> Column:
    """The sketch as text: 16 hexadecimal digits a hash."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def _splits(docs: DataFrame, parts: int) -> list[int]:
    """At most `parts` ids that cut the documents into ranges of about equal counts."""
    found = docs.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)], 20 * parts)).first()[0]
    return sorted(set(found or []))


def with_next(docs: DataFrame, parts: int = 1024) -> DataFrame:
    """Documents with `next_text`, the text of the next one by descending doc_id.

    After the last comes the first again; NULL ids come last; rows that share an
    id follow each other by text. Ids are cut into ranges at quantiles, and the
    first document of the next lower range is a guest in each, so that every
    range finds its own successors and nothing is ordered in one task. `parts`
    bounds the cut points and guests that the driver names.
    """
    splits = _splits(docs, parts)
    edges = F.array(*map(F.lit, splits)) if splits else F.array().cast("array<bigint>")
    # Cut points at or below the id; -1 for a NULL id.
    place = F.when(F.col("doc_id").isNull(), -1).otherwise(F.size(F.filter(edges, lambda e: e <= F.col("doc_id"))))
    rows = docs.select("doc_id", "text")
    tops = rows.select("doc_id", place.alias("part")).groupBy("part").agg(F.max("doc_id").alias("top")).orderBy(F.desc("part")).collect()
    following = {tops[i]["part"]: tops[(i + 1) % len(tops)]["top"] for i in range(len(tops))}
    guests = rows.where(F.lit(False)).select("*", F.lit(0).alias("part"))
    if following:
        # The range that a guest visits, by its id; a NULL one visits under no id.
        named = {top: part for part, top in following.items() if top is not None}
        ids, visits = (F.array(*map(F.lit, x)) for x in (named, named.values())) if named else (None, None)
        part = F.lit(following and next((p for p, t in following.items() if t is None), None)).cast("int")
        chosen = F.col("doc_id").isNull() if None in following.values() else F.lit(False)
        if named:
            part = F.when(F.col("doc_id").isNull(), part).otherwise(F.get(visits, (F.array_position(ids, F.col("doc_id")) - 1).cast("int")))
            chosen = chosen | F.col("doc_id").isin(list(named))
        guests = rows.where(chosen).select("*", part.alias("part"))
    both = rows.select("*", place.alias("part"), F.lit(False).alias("guest")).unionByName(guests.select("*", F.lit(True).alias("guest")))
    order = Window.partitionBy("part").orderBy("guest", F.desc_nulls_last("doc_id"), "text")
    return both.select("*", F.lead("text").over(order).alias("next_text")).where(~F.col("guest")).drop("guest")


def compare_edited(docs: DataFrame) -> DataFrame:
    """Fingerprints of documents, of their edited texts and of the next documents.

    The edited text is the text with its last half (rounded down) replaced by as
    many first characters of the next document, or all it has.
    """
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    rows = with_next(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    edited = F.concat(F.left("text", n - half), F.left("next_text", half))
    rows = once(rows.select("doc_id", n.cast("bigint").alias("n_chars"), "text", "next_text", edited.alias("edited")), "sketches", F.struct(
        sketch(F.col("text")).alias("own"), sketch(F.col("edited")).alias("edited"), sketch(F.col("next_text")).alias("next")))
    own, changed, following = (F.col("sketches")[x] for x in ("own", "edited", "next"))
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        as_text(own).alias("fingerprint"), as_text(changed).alias("edited_fingerprint"),
        resemblance(own, changed).alias("near_edited"), resemblance(own, following).alias("near_next"),
        containment(own, changed).alias("contained_in_edited"), distinct_shingles(own).alias("distinct_shingles"),
    )
