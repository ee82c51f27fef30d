"""Clickstream TSV: `source <tab> target <tab> type <tab> clicks`."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dumpflow import fixed_values as fx
from dumpflow.functions.codes import navigation_type, referer_category
from dumpflow.functions.ids import page_identifier
from dumpflow.functions.text import count_or_zero, once, strip_blanks
from dumpflow.functions.times import file_date, file_wiki_code


def classify_clickstream(
    lines: DataFrame,
    wiki_code: str | None = None,
    wiki_filter: Iterable[str] | None = None,
    strict_referer: bool = False,
) -> DataFrame:
    """Split every line and name the first rule it fails in `reason` (NULL = keep).

    The wiki is `wiki_code`, or the one in the file name. Blanks at both ends of
    a line do not count, fields past the fourth are ignored. Unlike pageviews, an
    empty `wiki_filter` keeps nothing; None keeps all.
    """
    # Splitting is not done by a CSV reader because titles hold quote characters.
    split = once(lines, "_f", F.split(strip_blanks(F.col("value")), "\t"))
    wiki: Column = F.lit(wiki_code) if wiki_code else file_wiki_code(F.col("file_name"))
    nav = navigation_type(F.get("_f", F.lit(2)))
    parsed = split.select(
        *lines.columns,
        F.size("_f").alias("_n"),
        wiki.alias("wiki_code"),
        F.get("_f", F.lit(0)).alias("source"),
        F.get("_f", F.lit(1)).alias("target"),
        nav.alias("type"),
        referer_category(nav, F.get("_f", F.lit(0)), strict_referer).alias("category"),
        count_or_zero(F.get("_f", F.lit(3))).alias("clicks"),
    )
    reason = F.when((F.col("_n") == 1) & (F.col("source") == ""), fx.EMPTY_LINE).when(
        F.col("_n") < 4, fx.INVALID_FORMAT
    )
    if wiki_filter is not None:
        allowed = list(wiki_filter)
        keep = F.col("wiki_code").isin(allowed) if allowed else F.lit(False)
        reason = reason.when(~F.coalesce(keep, F.lit(False)), fx.WIKI_NOT_ALLOWED)
    return parsed.withColumn("reason", reason).drop("_n")


def parse_clickstream(lines: DataFrame, **options) -> DataFrame:
    """The kept rows of `classify_clickstream`."""
    return classify_clickstream(lines, **options).where(F.col("reason").isNull()).drop("reason")


def clickstream_records(parsed: DataFrame) -> DataFrame:
    """Envelope rows keyed by the target page. Needs `file_name`."""
    day = file_date(F.col("file_name"))
    return parsed.select(
        page_identifier(F.col("wiki_code"), F.col("target")).alias("page_hash"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        "wiki_code",
        F.struct(
            F.col("target").alias("target_page"),
            day.alias("date"),
            F.col("clicks"),
            F.col("type").alias("navigation_type"),
            F.col("category").alias("referer_category"),
        ).alias("tuple_struct"),
    )


def clicks_per_target(parsed: DataFrame) -> DataFrame:
    """Clicks by wiki, target page, navigation type and referer category."""
    return parsed.groupBy("wiki_code", "target", "type", "category").agg(F.sum("clicks").alias("clicks"))
