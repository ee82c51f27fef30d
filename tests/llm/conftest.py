from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = [a + b for a in ("the", "on", "ra", "Mi", "so", "é") for b in ("n", "ta", "lo", "ke", "du", "")]


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    out = [rng.choice(WORDS) for _ in range(words)]
    for at in range(9, words, 11):
        out[at] += ".\n"
    return " ".join(out)


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a frame of documents: prose, copies, near copies and awkward rows, or given rows."""
    def make(rows=None):
        if rows is None:
            rows = [(i, prose(i, 30 + 7 * i), "en" if i % 2 else "fr", f"s{i % 3}", None) for i in range(24)]
            rows += [(100 + i, prose(i, 30 + 7 * i), "en", "s0", 3) for i in range(4)]  # copies
            rows += [(200 + i, prose(i, 30 + 7 * i) + " more", "en", None, 3) for i in range(4, 8)]
            rows += [(300, None, None, None, None), (301, "", "en", "s9", 0), (302, "\t \r\n\x0b", None, "", 5), (303, "One", "en", "s1", 3)]
            rows += [(5, prose(5, 65), "en", "s2", None)] * 2  # rows that repeat an id and a text
            rows += [(None, "no id here at all", "en", "s1", None), (400, "x" * 300_000, "fr", "s1", None), (401, "a b " * 40_000, "fr", "s1", None)]
        return spark.createDataFrame(rows, SCHEMA)

    return make
