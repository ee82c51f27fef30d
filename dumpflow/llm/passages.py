"""Passages that repeat across documents, found behind a count-min prefilter.

A window is `size` consecutive words of one text. Every block of documents
adds its windows to a sketch of `DEPTH` rows of counters, kept as the sorted
cells it touches; shards of the cell space merge these sketches and tell each
block which of its cells hold two or more. A window's true count is never
above the least of its cells, so windows with a cell below two occur once and
go no further. Only the others are grouped, exactly, by a 128-bit BLAKE2
digest of their words: shards of the digest space learn the smallest document
of each block and tell each block where another one is before it.

The sketch has half a cell per byte of text and row, so it grows with the
corpus and lets through about one unique window in sixteen at any size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dumpflow.llm import blocks as B
from dumpflow.llm.stages import arrow_ready

#: Rows of the sketch; cells of a row per byte of text.
DEPTH, CELLS_PER_BYTE = 2, 0.5
#: Cells of a shard of the sketch, and bytes of text for each shard of the digests.
SHARD_CELLS, SHARD_BYTES = 1 << 22, 8 << 20
#: Bytes of text in a block, and those whose windows are hashed at once.
BLOCK_BYTES, AT_ONCE = 8 << 20, 1 << 18

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
MIXERS = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xC2B2AE3D27D4EB4F))
SCHEMA = "doc_id bigint, n_words bigint, n_removed bigint, kept string, removed array<struct<start:bigint,end:bigint>>"
SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])


class Powers:
    """Powers of the base and of its inverse modulo 2^64, as many as were needed so far."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            self.up, self.down = (np.cumprod(np.r_[np.uint64(1), np.full(n - 1, b, np.uint64)]) for b in (BASE, INVERSE))
        return self.up, self.down


POWERS = Powers()


def words_of(text: str | None) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words of a text joined by one space, with the first byte of each and the one after it."""
    line = b" ".join((text or "").encode().split())
    blanks = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    if not line:
        return line, blanks, blanks
    return line, np.r_[0, blanks + 1], np.r_[blanks, len(line)]


def window_hashes(line: bytes, starts: np.ndarray, ends: np.ndarray, size: int, at_once: int = AT_ONCE) -> np.ndarray:
    """A 64-bit hash of each window's bytes, rolled over the text in pieces of about `at_once` bytes."""
    n = len(starts) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.empty(n, np.uint64)
    raw, i = np.frombuffer(line, np.uint8), 0
    while i < n:
        origin = starts[i]
        to = max(i + 1, min(n, int(np.searchsorted(starts[:n], origin + at_once))))
        end = int(ends[to + size - 2])
        up, down = POWERS(int(end - origin) + 1)
        sums = np.zeros(end - origin + 1, np.uint64)
        np.cumsum((raw[origin:end].astype(np.uint64) + np.uint64(1)) * up[: end - origin], out=sums[1:])
        first = starts[i:to] - origin
        out[i:to] = (sums[ends[i + size - 1 : to + size - 1] - origin] - sums[first]) * down[first]
        i = to
    return out


def cells_of(hashes: np.ndarray, width: int) -> np.ndarray:
    """The cell of each hash in every row of the sketch; rows lie one after the other."""
    out = np.empty((DEPTH, len(hashes)), np.int64)
    for row in range(DEPTH):
        h = (hashes ^ (hashes >> np.uint64(31))) * MIXERS[2 * row]
        h = (h ^ (h >> np.uint64(29))) * MIXERS[2 * row + 1]
        out[row] = ((h >> np.uint64(11)) % np.uint64(width)).astype(np.int64) + row * width
    return out


class Block:
    """Documents of one block with the windows that may count: those of rows with an id."""

    def __init__(self, content: tuple[list, list], size: int, shard_cells: int = SHARD_CELLS):
        order = sorted(range(len(content[0])), key=lambda i: (content[0][i] is None, content[0][i] or 0))
        self.ids = [content[0][i] for i in order]
        self.words = [words_of(content[1][i]) for i in order]
        self.size, self.shard_cells = size, shard_cells
        counts = [max(0, len(w[1]) - size + 1) if i is not None else 0 for i, w in zip(self.ids, self.words, strict=True)]
        self.at = np.cumsum([0, *counts])

    def hashes(self) -> np.ndarray:
        found = [window_hashes(*w, self.size) for w, a, b in zip(self.words, self.at, self.at[1:], strict=False) if a < b]
        return np.concatenate(found) if found else np.empty(0, np.uint64)

    def sketch(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Touched cells in ascending order, how often each was touched, and the (row, window) places in the order of their cells."""
        cells = cells_of(self.hashes(), width).ravel()
        order = np.argsort(cells)
        cells = cells[order]
        first = np.flatnonzero(np.diff(cells, prepend=-1))
        return cells[first], np.diff(first, append=len(cells)), order

    def estimated(self, width: int, answers: dict[int, bytes]) -> np.ndarray:
        """The windows all of whose cells hold two or more in the merged sketch."""
        touched, counts, order = self.sketch(width)
        repeated = np.zeros(len(touched), bool)
        for shard, start, stop in B.spans(touched // self.shard_cells):
            repeated[start:stop] = np.unpackbits(np.frombuffer(answers[shard], np.uint8), count=stop - start)
        hit = np.empty(len(order), bool)
        hit[order] = np.repeat(repeated, counts)
        return np.flatnonzero(hit.reshape(DEPTH, -1).all(axis=0))

    def digests(self, windows: np.ndarray) -> np.ndarray:
        """128-bit digests as two numbers."""
        out = []
        bounds = np.searchsorted(windows, self.at)
        for (line, starts, ends), base, a, b in zip(self.words, self.at, bounds, bounds[1:], strict=False):
            if a < b:
                i = windows[a:b] - base
                out += [hashlib.blake2b(line[s:e], digest_size=16).digest()
                        for s, e in zip(starts[i].tolist(), ends[i + self.size - 1].tolist(), strict=True)]
        return np.frombuffer(b"".join(out), ">u8").reshape(-1, 2).astype(np.uint64)

    def docs_of(self, windows: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.at, windows, side="right") - 1


def merge_sketches(given: list[bytes], shard_cells: int) -> list[bytes]:
    """Add the blocks' counters of a shard; per block a bit for each of its cells, set where the sum is two or more."""
    sums = np.zeros(shard_cells, np.uint8)
    cells = []
    for raw in given:
        steps, twice, n = B.unpack(raw)
        at = B.from_gaps(steps)
        sums[at] = np.minimum(sums[at] + 1 + np.unpackbits(twice, count=n), 2)
        cells.append(at)
    return [np.packbits(sums[at] > 1).tobytes() for at in cells]


def find_first(given: list[bytes]) -> list[bytes]:
    """Per block a bit for each of its digests, set where another block has it in a smaller document."""
    parts = [B.unpack(raw) for raw in given]
    digests = np.concatenate([d for d, _, _ in parts])
    docs = np.concatenate([ids[at] for _, ids, at in parts])
    order = np.lexsort((docs, digests[:, 1], digests[:, 0]))
    same = digests[order]
    new = np.r_[True, (same[1:] != same[:-1]).any(axis=1)]
    first = np.empty(len(docs), bool)
    sorted_docs = docs[order]
    smallest = sorted_docs[np.flatnonzero(new)][np.cumsum(new) - 1]
    first[order] = sorted_docs > smallest
    ends = np.cumsum([len(at) for _, _, at in parts])
    return [np.packbits(bits).tobytes() for bits in np.split(first, ends[:-1])]


class Groups:
    """The estimated windows of a block by digest: `kinds` ascend, `kind` is that of each window, `first` its first document's place."""

    def __init__(self, block: Block, width: int, answers: dict[int, bytes], shards: int):
        self.windows = block.estimated(width, answers)
        self.docs = block.docs_of(self.windows)
        digests = block.digests(self.windows)
        order = np.lexsort((digests[:, 1], digests[:, 0]))  # stable, and windows come by document
        digests = digests[order]
        new = np.r_[True, (digests[1:] != digests[:-1]).any(axis=1)][: len(digests)]
        self.kinds, self.first = digests[new], self.docs[order][new]
        self.kind = np.empty(len(digests), np.int64)
        self.kind[order] = np.cumsum(new) - 1
        top = (self.kinds[:, 0] >> np.uint64(32)).astype(np.int64)
        self.shards = list(B.spans(top * shards >> 32))


def pack_documents(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Blocks of whole rows with about `block_bytes` of text each; a longer text is a block of its own."""
    schema = B.arrow_schema(B.BLOCK)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count = TaskContext.get().partitionId(), 0
        ids, texts, held = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids.append(doc_id)
                texts.append(text)
                held += len(text or "") + 1
                if held >= block_bytes:
                    yield B.batch_of([(f"{part}-{count}", held, B.pack((ids, texts)))], schema)
                    ids, texts, held, count = [], [], 0, count + 1
        if ids:
            yield B.batch_of([(f"{part}-{count}", held, B.pack((ids, texts)))], schema)

    arrow_ready(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(of, B.BLOCK)


def without_repeats(docs: DataFrame, size: int = 50, block_bytes: int = BLOCK_BYTES,
                    shard_cells: int = SHARD_CELLS, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Every row of `docs` (doc_id, text) with its words that no earlier document has in a window of `size`.

    A word goes if a window over it also starts in a document with a smaller
    doc_id; windows are judged on the input. Returns doc_id, n_words, n_removed,
    `kept` (the kept words joined by one space) and `removed`, the word spans
    that went. NULL and empty texts have no words. Rows of one doc_id do not
    judge each other; a row without doc_id has no smaller one and is smaller
    than none, so it stays whole. Other columns are ignored.
    """
    stored = B.write_blocks(pack_documents(docs, block_bytes), "passages")
    total = stored.agg(F.sum("n_bytes")).first()[0] or 0
    width, shards = max(1024, int(total * CELLS_PER_BYTE)), max(1, -(-total // shard_bytes))
    question = B.arrow_schema(B.QUESTION)

    def add_up(name: str, content, _: list[dict]) -> Iterator[pa.RecordBatch]:
        touched, counts, _ = Block(content, size).sketch(width)
        for shard, a, b in B.spans(touched // shard_cells):
            steps, twice = B.gaps_of(touched[a:b] - shard * shard_cells), np.packbits(counts[a:b] > 1)
            yield B.batch_of([(shard, name, B.pack((steps, twice, b - a)))], question)

    def candidates(name: str, content, answers: list[dict]) -> Iterator[pa.RecordBatch]:
        block = Block(content, size, shard_cells)
        groups = Groups(block, width, answers[0], shards)
        first = np.array([-1 if i is None else i for i in block.ids], np.int64)[groups.first]
        for shard, a, b in groups.shards:
            ids, at = np.unique(first[a:b], return_inverse=True)
            yield B.batch_of([(shard, name, B.pack((groups.kinds[a:b], ids, at.astype(np.min_scalar_type(len(ids))))))], question)

    def remove(name: str, content, answers: list[dict]) -> Iterator[pa.RecordBatch]:
        block = Block(content, size, shard_cells)
        groups = Groups(block, width, answers[0], shards)
        earlier = np.zeros(len(groups.kinds), bool)
        for shard, a, b in groups.shards:
            earlier[a:b] = np.unpackbits(np.frombuffer(answers[1][shard], np.uint8), count=b - a)
        ids = block.ids
        number = np.array([-1 if i is None else i for i in ids], np.int64)
        gone = earlier[groups.kind] | (number[groups.docs] > number[groups.first[groups.kind]])
        windows, docs_at = groups.windows[gone], groups.docs[gone]
        bounds = np.searchsorted(docs_at, np.arange(len(ids) + 1))
        rows = []
        for doc, (line, starts, ends) in enumerate(block.words):
            found, n = windows[bounds[doc] : bounds[doc + 1]] - block.at[doc], len(starts)
            cover = np.zeros(n + 1, np.int64)
            np.add.at(cover, found, 1)
            np.add.at(cover, found + size, -1)
            edges = np.diff((np.cumsum(cover)[:-1] > 0).astype(np.int8), prepend=0, append=0) if len(found) else np.zeros(0, np.int8)
            a, b = np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()
            rest = zip([0, *b], [*a, n], strict=True)
            kept = b" ".join(line[starts[i] : ends[j - 1]] for i, j in rest if i < j) if a else line
            rows.append((ids[doc], n, sum(b) - sum(a), kept.decode(), list(zip(a, b, strict=True))))
        for i in range(0, len(rows), 500):
            doc_id, n_words, n_removed, kept, removed = zip(*rows[i : i + 500], strict=True)
            spans_of = pa.array([[{"start": s, "end": e} for s, e in r] for r in removed], pa.list_(SPAN))
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_id, pa.int64()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string()), spans_of],
                ["doc_id", "n_words", "n_removed", "kept", "removed"])

    repeated = B.kept(B.answered(B.over_blocks(stored, add_up, B.QUESTION), lambda given: merge_sketches(given, shard_cells)), "passages-estimates")
    earlier = B.kept(B.answered(B.over_blocks(stored, candidates, B.QUESTION, repeated), find_first), "passages-first")
    return B.over_blocks(stored, remove, SCHEMA, repeated, earlier)


#: `op11_passage_dedup` as DuckDB SQL.
REMOVED_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents),
w AS (SELECT r, doc_id, i, array_to_string(words[i + 1 : i + 50], ' ') AS s
      FROM (SELECT r, doc_id, words, unnest(range(len(words) - 49)) AS i FROM d WHERE len(words) >= 50)),
f AS (SELECT s, min(doc_id) AS first FROM w GROUP BY s),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 50)) AS p FROM w JOIN f USING (s) WHERE doc_id > first),
g AS (SELECT r, list(p) AS ps, count(*) AS n FROM gone GROUP BY r),
k AS (SELECT r, array_to_string(list(word ORDER BY p), ' ') AS kept
      FROM (SELECT d.r, unnest(words) AS word, unnest(range(len(words))) AS p FROM d JOIN g USING (r)) x
      WHERE NOT EXISTS (FROM gone WHERE gone.r = x.r AND gone.p = x.p) GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
       sha256(CASE WHEN n IS NULL THEN array_to_string(words, ' ') ELSE coalesce(kept, '') END) AS kept_sha256
FROM d LEFT JOIN g USING (r) LEFT JOIN k USING (r)
"""
