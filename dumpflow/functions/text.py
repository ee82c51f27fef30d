"""Text helpers. Blanks follow the wide Unicode definition, digits are ASCII."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Blank characters inside a class of a pattern with the U flag, which makes \s
# cover all Unicode white space. Naming those characters one by one in the class
# gives the same result several times slower.
BLANKS = r"\s\x1c-\x1f"


def words(text: Column) -> Column:
    """Non-blank runs of a line; an empty array for a blank line."""
    return F.regexp_extract_all(text, F.lit(f"(?U)[^{BLANKS}]+"), F.lit(0))


def strip_blanks(text: Column) -> Column:
    """Remove blanks from both ends."""
    # One pass from the front: an alternation would try every inner run of blanks.
    return F.regexp_extract(text, f"(?sU)^[{BLANKS}]*+(.*[^{BLANKS}])?", 1)


def is_blank(text: Column) -> Column:
    return ~text.rlike(f"(?U)[^{BLANKS}]")


def count_or_zero(text: Column) -> Column:
    """Digits as a BIGINT; anything else, and what does not fit, is 0."""
    return F.coalesce(F.when(text.rlike("^[0-9]+$"), text.try_cast("bigint")), F.lit(0).cast("bigint"))


def title_prefix(title: Column) -> Column:
    """The part before the first colon, or NULL without a colon."""
    return F.when(title.contains(":"), F.substring_index(title, ":", 1))


def url_netloc(url: Column) -> Column:
    """Lower-case network location (user, host and port) of a URL, '' if it has none."""
    return F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1))


def url_host(url: Column) -> Column:
    """Host part of the network location, without user and port; NULL if there is none."""
    bare = F.regexp_replace(url_netloc(url), r"^.*@", "")
    return F.nullif(F.regexp_replace(bare, r":\d*$", ""), F.lit(""))


def first_match(text: Column, ordered: tuple[tuple[str, str], ...], default: str) -> Column:
    """Label of the first needle that `text` contains, in list order."""
    out = F.lit(default)
    for needle, label in reversed(ordered):
        out = F.when(text.contains(needle), F.lit(label)).otherwise(out)
    return out


def once(df, name: str, value: Column):
    """Add a costly column so that later filters reuse it.

    A filter on a plain projected column is pushed below the projection and the
    expression is then run again inside the filter, once per mention. A column
    made by a generator stays put, so it is computed once per row.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))
