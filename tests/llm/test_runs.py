from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dumpflow.llm import runs


def next_smaller(word):
    """The longest Lyndon word at a place ends where the next smaller suffix begins."""
    n = len(word)
    return [next((j for j in range(i + 1, n) if word[j:] < word[i:]), n) - i for i in range(n)]


def every_run(words, exponent=4, shortest=6):
    """All periods at all places."""
    n, found = len(words), {}
    for p in range(1, n // exponent + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j > i and j + p - i >= max(shortest, exponent * p):
                found.setdefault((i, j + p - i), p)  # the smallest period comes first
            i = j + 1
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))


def dense(values):
    kinds = sorted(set(values))
    return [kinds.index(v) for v in values]


@settings(deadline=None, max_examples=500)
@given(st.lists(st.integers(0, 3), max_size=40))
def test_lyndon_array(values):
    word = dense(values)
    assert list(runs.lyndon_array(word)) == next_smaller(word)


def test_long_pieces(monkeypatch):
    rng = random.Random(3)
    word = dense([rng.randrange(3) for _ in range(300)])
    monkeypatch.setattr(runs, "LONG", 10)
    assert list(runs.lyndon_array(word)) == next_smaller(word)


@settings(deadline=None, max_examples=500)
@given(st.lists(st.integers(0, 2), min_size=1, max_size=60), st.integers(2, 5), st.integers(0, 8))
def test_runs_of_a_piece(values, exponent, shortest):
    assert runs.runs_of(np.array(values), exponent, shortest) == every_run(values, exponent, shortest)


def collapse(words, found):
    gone = {i for s, n, p in found for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def periodic_texts():
    rng = random.Random(5)
    rows = []
    for k in range(60):
        words = []
        for _ in range(rng.randint(0, 6)):
            unit = [rng.choice("ab") + str(rng.randrange(3)) for _ in range(rng.randint(1, 7))]
            words += unit * rng.randint(1, 7) + unit[: rng.randint(0, len(unit))]
        rows.append((k if k % 9 else None, rng.choice([" ", "\n", "\t\x0b"]).join(words)))
    return rows


def test_frame(documents):
    docs = documents([(i, t, "runs", "x", None) for i, t in [*periodic_texts(), (900, None), (901, ""), (902, "a " * 9_000)]]).withColumnRenamed("lang", "runs")
    rows = docs.collect()
    got = runs.find(docs).collect()
    want = []
    for r in rows:
        words = (r.text or "").split()
        found = every_run(words) if len(words) < 9_000 else [(0, 9_000, 1)]
        want.append((r.doc_id, len(words), found, collapse(words, found)))
    assert [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got] == want
    assert sum(len(r.runs) for r in got) > 40


def test_query_columns(documents):
    docs = documents()
    got = runs.digests(runs.find(runs.with_planted_runs(docs))).collect()
    want, some = [], 0
    for r in docs.collect():
        words = (r.text or "").split()
        h = 1 if r.doc_id is None else zlib.crc32(str(r.doc_id).encode())
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        found = every_run(words) if len(words) < 9_000 else [tuple(x) for x in runs.runs_of(np.array([hash(w) for w in words]), 4, 6)]
        best = min(found, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=(None,) * 3)
        some += bool(found)
        text = "".join(f"{s},{n},{p}\n" for s, n, p in found)
        want.append((r.doc_id, len(found), *best, best[1] and 1000 * best[1] // best[2],
                     hashlib.sha256(text.encode()).hexdigest(), hashlib.sha256(collapse(words, found).encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert some


def test_no_documents(documents):
    assert runs.find(documents([])).count() == 0
    with pytest.raises(ValueError):
        runs.find(documents([]), exponent=1)
