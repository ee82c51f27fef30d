"""Words and shingles as columns. A word is a run of anything but ASCII white space."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """Words in order; an empty array for NULL and for text without a word."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def let(value: Column, body) -> Column:
    """`body(value)` with the value computed once per row.

    A lambda reads its own argument, while an outer expression named inside a
    lambda would run again for every element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def shingle_hashes(words: Column, size: int) -> Column:
    """XXH64 of every run of `size` words, repeats included.

    Fewer words than `size` make one shingle of all of them, no word makes none.
    """
    def hashes(w: Column) -> Column:
        last = F.greatest(F.size(w) - size, F.lit(0))
        return F.when(F.size(w) > 0, F.transform(
            F.sequence(F.lit(0), last),
            lambda i: F.xxhash64(F.concat_ws(" ", F.slice(w, i + 1, size))),
        )).otherwise(F.array().cast("array<bigint>"))

    return let(words, hashes)
