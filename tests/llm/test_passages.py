from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dumpflow.llm import blocks, passages


def brute(rows, size):
    """Every window as a tuple of words."""
    texts = [(i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, words in texts:
        for k in range(len(words) - size + 1) if i is not None else ():
            key = tuple(words[k : k + size])
            first[key] = min(i, first.get(key, i))
    out = []
    for i, words in texts:
        gone = set()
        for k in range(len(words) - size + 1) if i is not None else ():
            if first[tuple(words[k : k + size])] < i:
                gone |= set(range(k, k + size))
        out.append((i, len(words), len(gone), b" ".join(w for k, w in enumerate(words) if k not in gone).decode()))
    return sorted(out, key=str)


def shared_passages(seed, n, size):
    rng = random.Random(seed)
    word = lambda: rng.choice(["a", "b", "ü", "cd"]) + str(rng.randrange(40))
    pool = [[word() for _ in range(rng.randint(size - 1, 3 * size))] for _ in range(6)]
    rows = []
    for i in range(n):
        words = [w for _ in range(rng.randint(0, 4)) for w in (rng.choice(pool) if rng.random() < 0.5 else [word() for _ in range(rng.randint(0, 2 * size))])]
        rows.append((rng.choice([i, i, i, i // 2, None]), rng.choice([" ", "\n", " \t "]).join(words)))
    return [*rows, (9_000, None), (9_001, ""), (9_002, " \n")]


@pytest.mark.parametrize("size, block_bytes, shard_cells", [(5, 600, 1 << 22), (5, 1, 512), (50, 4_000, 1 << 22)])
def test_against_every_window(documents, size, block_bytes, shard_cells):
    rows = shared_passages(size, 80, size)
    docs = documents([(i, t, None, None, None) for i, t in rows])
    got = passages.without_repeats(docs, size, block_bytes, shard_cells, 2_000).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got), key=str) == brute(rows, size)
    assert sum(r.n_removed for r in got) > 0
    assert all(r.n_removed == sum(s.end - s.start for s in r.removed) for r in got)


def test_awkward_rows(documents):
    docs = documents()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = passages.without_repeats(docs.withColumnRenamed("source", "block")).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got), key=str) == brute(rows, 50)


def test_no_documents(documents):
    assert passages.without_repeats(documents([])).count() == 0


def test_sketch_never_counts_too_little():
    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 300, 4_000).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    cells = passages.cells_of(hashes, 500)
    counts = np.bincount(cells.ravel(), minlength=1_000)
    values, true = np.unique(hashes, return_counts=True)
    estimate = counts[passages.cells_of(values, 500)].min(axis=0)
    assert (estimate >= true).all()


@settings(deadline=None, max_examples=200)
@given(st.lists(st.integers(0, 400_000), unique=True, min_size=1))
def test_gaps(values):
    values = np.array(sorted(values), np.int64)
    assert (blocks.from_gaps(blocks.gaps_of(values)) == values).all()


def test_hashes_do_not_depend_on_pieces():
    line, starts, ends = passages.words_of(" ".join(str(i % 37) * (1 + i % 5) for i in range(500)))
    whole = passages.window_hashes(line, starts, ends, 7)
    words = line.split()
    assert len(set(whole.tolist())) == len({tuple(words[i : i + 7]) for i in range(len(words) - 6)})
    for at_once in (1, 40, 333):
        assert (passages.window_hashes(line, starts, ends, 7, at_once) == whole).all()
