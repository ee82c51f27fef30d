"""Pageview text: `domain [title] [internal_id] access views [hourly]`."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dumpflow import fixed_values as fx
from dumpflow.functions.codes import access_code, agent_code
from dumpflow.functions.ids import page_identifier
from dumpflow.functions.text import count_or_zero, once, title_prefix, words
from dumpflow.functions.times import file_date


def classify_pageviews(
    lines: DataFrame,
    wiki_filter: Iterable[str] | None = None,
    excluded_prefixes: Iterable[str] | None = None,
) -> DataFrame:
    """Split every line and name the first rule it fails in `reason`.

    `reason` is NULL on rows to keep. Input needs `value`; other columns pass
    through. An empty `wiki_filter` keeps all wikis; `excluded_prefixes` replaces
    the default list.
    """
    wikis = list(wiki_filter or [])
    prefixes = [p.rstrip(":") for p in excluded_prefixes or fx.EXCLUDED_PREFIXES]
    split = once(lines, "_words", words(F.col("value")))

    n = F.size("_words")
    # The access word sits at 1, 2 or 3 depending on how many optional fields
    # stand before it; the view count follows it.
    access_at = F.when(n == 3, 1).when(n == 4, 2).otherwise(3)
    fields = split.select(
        *lines.columns,
        n.alias("_n"),
        F.get("_words", F.lit(0)).alias("domain"),
        F.when(n >= 4, F.get("_words", F.lit(1))).alias("title"),
        F.get("_words", access_at).alias("access_type"),
        F.get("_words", access_at + 1).alias("_views_text"),
    )
    parsed = fields.withColumns(
        {"views": count_or_zero(F.col("_views_text")), "prefix": title_prefix(F.col("title"))}
    )
    reason = F.when(F.col("_n") == 0, fx.EMPTY_LINE).when(~F.col("_n").between(3, 6), fx.INVALID_FORMAT)
    if wikis:
        reason = reason.when(~F.col("domain").isin(wikis), fx.WIKI_NOT_ALLOWED)
    reason = reason.when(F.col("prefix").isin(prefixes), fx.EXCLUDED_PREFIX).when(
        F.col("views") == 0, fx.ZERO_PAGEVIEWS
    )
    return parsed.withColumn("reason", reason).drop("_n", "_views_text")


def parse_pageviews(lines: DataFrame, **options) -> DataFrame:
    """The kept rows of `classify_pageviews`."""
    return classify_pageviews(lines, **options).where(F.col("reason").isNull()).drop("reason", "prefix")


def pageview_records(parsed: DataFrame) -> DataFrame:
    """Envelope rows: keys on top, typed fields in `tuple_struct`. Needs `file_name`."""
    day = file_date(F.col("file_name"))
    return parsed.select(
        page_identifier(F.col("domain"), F.coalesce("title", F.lit(""))).alias("page_hash"),
        "title",
        F.date_format(day, "yyyy-MM").alias("year_month"),
        F.col("domain").alias("wiki_code"),
        F.struct(
            access_code(F.col("access_type")).alias("access_type"),
            agent_code(F.col("file_name")).alias("user_type"),
            day.alias("date"),
            F.col("views"),
        ).alias("tuple_struct"),
    )


def views_per_page_day(parsed: DataFrame) -> DataFrame:
    """Views by page, day and access code.

    Rows are summed under their plain wiki and title first; only the groups that
    remain are hashed, which is far fewer than the lines.
    """
    summed = (
        parsed.select(
            "domain",
            F.coalesce("title", F.lit("")).alias("title"),
            file_date(F.col("file_name")).alias("day"),
            access_code(F.col("access_type")).alias("access_code"),
            "views",
        )
        .groupBy("domain", "title", "day", "access_code")
        .agg(F.sum("views").alias("views"))
    )
    return summed.select(
        page_identifier(F.col("domain"), F.col("title")).alias("page_hash"), "day", "access_code", "views"
    )
