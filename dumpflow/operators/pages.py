"""Page documents, kept long and folded on demand.

A page's arrays grow without bound, so they are stored as one row per element:
`(wiki_code, page_hash, year_month, kind, element, seen_at)`, the element being
JSON text. Adding to a set is dropping equal rows; a document is a fold of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dumpflow import fixed_values as fx

PAGE_KEY = ("wiki_code", "page_hash")
FACT_COLUMNS = (*PAGE_KEY, "year_month", "kind", "element", "seen_at")


def page_facts(
    records: DataFrame,
    elements: dict[str, Column],
    seen_at: Column,
    page_hash: Column | None = None,
) -> DataFrame:
    """Facts out of rows that carry a page's key, all kinds in one pass.

    `elements` maps a kind to the element a row adds to it; NULL adds none. The
    page is the row's own `page_hash` unless another key is given.
    """
    added = F.array(*[F.struct(F.lit(kind).alias("kind"), element.alias("element")) for kind, element in elements.items()])
    return records.select(
        "wiki_code",
        (F.col("page_hash") if page_hash is None else page_hash).alias("page_hash"),
        "year_month",
        seen_at.alias("seen_at"),
        F.inline(added),
    ).where(F.col("element").isNotNull()).select(*FACT_COLUMNS)


def set_add(facts: DataFrame, *grain: str) -> DataFrame:
    """Distinct elements per grain and kind, with when each was first and last seen.

    The shuffle is by grain, kind and element together, so a page with a third of
    all rows still spreads over all tasks.
    """
    return facts.groupBy(*grain, "kind", "element").agg(
        F.min("seen_at").alias("first_seen"), F.max("seen_at").alias("last_seen")
    )


def page_elements(facts: DataFrame) -> DataFrame:
    """Distinct elements of every page."""
    return set_add(facts, *PAGE_KEY)


def element_counts() -> list[Column]:
    """Number of a group's elements by kind."""
    return [F.count_if(F.col("kind") == kind).alias(f"n_{kind}") for kind in fx.ELEMENT_KINDS]


def fold_pages(elements: DataFrame, *grain: str) -> DataFrame:
    """One row per page: array sizes, first and last time seen.

    Only counters and times are held per page, so the aggregation stays in its
    hash form and is nearly finished before its shuffle.
    """
    return elements.groupBy(*(grain or PAGE_KEY)).agg(
        *element_counts(), F.min("first_seen").alias("created_at"), F.max("last_seen").alias("last_updated")
    )


def page_fold(facts: DataFrame) -> DataFrame:
    """The page document without its arrays: sizes, times and current title.

    The current title is the one seen last; between titles seen at one time the
    greater one wins. Text cannot be kept as the state of a hash aggregation, so
    elements are first counted per page and title, and only that small result, a
    row per title and one for all else, is aggregated by sorting.
    """
    return fold_elements(page_elements(facts))


def fold_elements(elements: DataFrame, *carried: str) -> DataFrame:
    """`page_fold` of distinct elements; `carried` are columns that are the same in all rows of a page."""
    grain = (*carried, *PAGE_KEY)
    title = F.when(F.col("kind") == fx.TITLES, F.col("element"))
    per_title = fold_pages(elements.withColumn("_title", title), *grain, "_title")
    last = F.when(F.col("_title").isNotNull(), F.struct("last_updated", "_title"))
    return per_title.groupBy(*grain).agg(
        *[F.sum(f"n_{kind}").alias(f"n_{kind}") for kind in fx.ELEMENT_KINDS],
        F.min("created_at").alias("created_at"),
        F.max("last_updated").alias("last_updated"),
        F.max_by("_title", last).alias("current_title"),
    )


def latest_metadata(rows: DataFrame, fields: list[str], at: Column) -> DataFrame:
    """Page id and a map of descriptive fields per page, both as last written.

    `rows` carry the page key, `page_id` and the fields. Rows written at one time
    are told apart by their content, so the result does not depend on row order.
    """
    pairs = [part for name in fields for part in (F.lit(name), F.col(name).cast("string"))]
    described = rows.select(*PAGE_KEY, "page_id", F.create_map(*pairs).alias("metadata"), at.alias("_at"))
    last = F.struct("_at", "page_id", F.to_json("metadata"))
    return described.groupBy(*PAGE_KEY).agg(
        F.max_by(F.struct("page_id", "metadata"), last).alias("_last")
    ).select(*PAGE_KEY, "_last.page_id", "_last.metadata")


def page_summaries(facts: DataFrame, metadata: DataFrame) -> DataFrame:
    """The fold together with each page's latest metadata, where there is any."""
    return page_fold(facts).join(metadata, list(PAGE_KEY), "left")


def monthly_and_total(facts: DataFrame) -> DataFrame:
    """The fold at both grains: one row per page and month, and one with a NULL month.

    An element seen in two months counts in each month, and once in the total.
    """
    # Sizes and times need no text: elements are told apart by a 128-bit digest, dropped once per
    # month, and the totals are worked out from what is left.
    digests = facts.withColumn("element", F.unhex(F.md5("element")))
    months = set_add(digests, *PAGE_KEY, "year_month")
    totals = months.groupBy(*PAGE_KEY, "kind", "element").agg(
        F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"))
    grain = (*PAGE_KEY, "grain", "year_month")
    by_month = fold_pages(months.withColumn("grain", F.lit("month")), *grain)
    return by_month.unionByName(fold_pages(totals.withColumns(
        {"grain": F.lit("total"), "year_month": F.lit(None).cast("string")}), *grain))


def page_documents(elements: DataFrame, digits: int = 1) -> DataFrame:
    """Nested documents: one array per kind, a row per page and bucket of its elements.

    The bucket is the first `digits` hexadecimal digits of an element's MD5, the
    same rule for every page; take more digits for larger pages. A page's rows
    together hold every element, and each has the times of the whole page. Pass a
    written element table, as it is read twice.
    """
    bucketed = elements.withColumn("bucket", F.left(F.md5("element"), F.lit(digits)))
    arrays = [
        F.sort_array(F.collect_list(F.when(F.col("kind") == kind, F.col("element")))).alias(kind)
        for kind in fx.ELEMENT_KINDS
    ]
    times = elements.groupBy(*PAGE_KEY).agg(F.min("first_seen").alias("created_at"), F.max("last_seen").alias("last_updated"))
    return bucketed.groupBy(*PAGE_KEY, "bucket").agg(*arrays).join(times, list(PAGE_KEY))


def page_documents_by_size(elements: DataFrame, per_row: int = 20_000) -> DataFrame:
    """Nested documents with as many buckets as a page's elements need, the same rule for every page.

    A page has 1, 16, 256, ... buckets, the fewest of which each is expected to hold
    half of `per_row` elements or less, so that uneven ones stay below `per_row`.
    Every row has that number as `n_buckets`. A bucket is known by the first hexadecimal
    digits of its elements' MD5, '' where there is one. Pass a written element table, as it is read twice.
    """
    half = max(1, per_row // 2)
    size = F.count("*")
    digits = sum(((size > F.lit(half * 16**k)).cast("int") for k in range(1, 12)), (size > F.lit(half)).cast("int"))
    pages = elements.groupBy(*PAGE_KEY).agg(
        digits.alias("_digits"), F.min("first_seen").alias("created_at"), F.max("last_seen").alias("last_updated"))
    bucketed = elements.join(pages, list(PAGE_KEY)).withColumn("bucket", F.left(F.md5("element"), F.col("_digits")))
    arrays = [
        F.sort_array(F.collect_list(F.when(F.col("kind") == kind, F.col("element")))).alias(kind)
        for kind in fx.ELEMENT_KINDS
    ]
    # Digits and times are the same in all rows of a page.
    rows = bucketed.groupBy(*PAGE_KEY, "_digits", "created_at", "last_updated", "bucket").agg(*arrays)
    return rows.withColumn("n_buckets", F.expr("shiftleft(1L, 4 * _digits)")).drop("_digits")


def latest_row(rows: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The whole row that comes last in each group.

    Same result as numbering rows in a window, but partial results are combined
    before the shuffle and no group is gathered in one task.
    """
    others = [c for c in rows.columns if c not in key]
    return rows.groupBy(*key).agg(F.max_by(F.struct(*others), F.struct(*order)).alias("_row")).select(
        *key, *[F.col(f"_row.{c}").alias(c) for c in others]
    )


def drop_equal_facts(facts: DataFrame) -> DataFrame:
    """Facts without repeats of the same page, kind and element in a month.

    The first and the last time seen both stay, as two rows only where they
    differ, so a fold of the result is the fold of all.
    """
    spans = set_add(facts, *PAGE_KEY, "year_month")
    seen = F.explode(F.array_distinct(F.array("first_seen", "last_seen"))).alias("seen_at")
    return spans.select(*PAGE_KEY, "year_month", "kind", "element", seen)
