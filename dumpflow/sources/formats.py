"""Registry of dump formats: a name and a function from lines to typed rows.

A format takes a frame with `value` and `file_name` and returns parsed rows, so
files, streams and rendered text share one code path. Users may add their own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dumpflow.sources.clickstream import parse_clickstream
from dumpflow.sources.pageviews import parse_pageviews
from dumpflow.sources.revisions import pages_from_text, parse_revisions
from dumpflow.sources.sqldump import PAGE, PAGELINKS, parse_dump

Format = Callable[[DataFrame], DataFrame]

_FORMATS: dict[str, Format] = {
    "pageviews": parse_pageviews,
    "clickstream": parse_clickstream,
    "pagelinks": lambda lines: parse_dump(lines, PAGELINKS),
    "page": lambda lines: parse_dump(lines, PAGE),
    "revisions": lambda lines: parse_revisions(pages_from_text(lines)),
}


def register_format(name: str, parse: Format) -> None:
    _FORMATS[name] = parse


def parse_as(name: str, lines: DataFrame) -> DataFrame:
    if name not in _FORMATS:
        raise ValueError(f"unknown format {name!r}; known: {sorted(_FORMATS)}")
    return _FORMATS[name](lines)


def tsv_kind(file_name):
    """clickstream or pageviews, told by the file name."""
    return F.when(file_name.contains("clickstream"), "clickstream").otherwise("pageviews")


def route_lines(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Mixed TSV lines as (pageview lines, clickstream lines)."""
    clicks = F.col("file_name").contains("clickstream")
    return lines.where(~clicks), lines.where(clicks)
