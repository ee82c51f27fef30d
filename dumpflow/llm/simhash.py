"""SimHash near-duplicates through a Gray-order hierarchical index.

Equal fingerprints are one class. Two fingerprints within four bits agree on at
least one of five blocks of bits, so classes are dealt to tasks by block value;
a block value with too many classes is dealt once more by the other bits. A
task sorts what it has by block value and Gray rank and stacks an index on it:
a node holds the bits that all fingerprints below it share, less those that its
parent holds already. A search adds up the bits in which it differs from node
to node and leaves a whole group as soon as there are too many.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dumpflow.llm.components import components
from dumpflow.llm.stages import arrow_ready, written

SHINGLE, SEED, MAX_BITS = 4, 42, 4
#: Children of an index node.
FANOUT = 8
#: Classes of one block value that are dealt once more beyond this.
DEAL_AGAIN = 20_000
#: Rows that a task gathers before it searches, and comparisons it makes at a time.
GATHER, AT_ONCE = 100_000, 2_000_000


def fingerprint_of(text: bytes | None) -> int:
    """SimHash of the runs of four words, A-Z lower-cased; 0 for no word."""
    w = (text or b"").lower().split()
    if not w:
        return 0
    runs = zip(*(w[i:] for i in range(SHINGLE)), strict=False) if len(w) >= SHINGLE else [w]
    digest = xxhash.xxh64_intdigest
    ones, n = np.zeros(64, np.int64), 0
    hashes = (digest(x, SEED) for x in map(b" ".join, runs))
    while len(part := np.fromiter(islice(hashes, 65_536), np.uint64)):
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(part)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, more: dict[str, Column] | None = None) -> DataFrame:
    """`doc_id` and `fp`, the fingerprint as a BIGINT, of every whole text, and BIGINT columns `more`."""
    more = more or {}
    names = ["doc_id", *more, "fp"]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = pa.array([fingerprint_of(t) for t in batch.column(len(names) - 1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], fp], names)

    arrow_ready(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("bigint"), *(c.alias(n) for n, c in more.items()), F.col("text").cast("binary"))
    return rows.mapInArrow(of, ", ".join(f"{n} bigint" for n in names))


def gray_rank(fp: Column) -> Column:
    """Place of the fingerprint in Gray order, as a BIGINT that sorts like it."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, shift))
    return fp.bitwiseXOR(F.lit(-(2**63)))


def _blocks(width: int, count: int) -> list[tuple[int, int]]:
    """(lowest bit, bits) of `count` blocks that cover `width` bits."""
    ends = [width * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(ends, ends[1:], strict=False)]


def _value(x: Column, low: int, bits: int) -> Column:
    return F.shiftrightunsigned(x, low).bitwiseAND(F.lit((1 << bits) - 1))


def dealt(classes: DataFrame, max_bits: int = MAX_BITS, deal_again: int = DEAL_AGAIN) -> DataFrame:
    """Rows (key, fp, node): any two fingerprints within `max_bits` share a key."""
    count = max_bits + 1
    first = _blocks(64, count)
    keys = F.array(*(F.struct(F.lit(i).alias("block"), _value(F.col("fp"), low, bits).alias("value")) for i, (low, bits) in enumerate(first)))
    rows = classes.select("fp", "node", F.explode(keys).alias("at")).select("fp", "node", "at.block", "at.value")
    large = written(rows.groupBy("block", "value").count().where(F.col("count") > deal_again).select("block", "value", F.lit(True).alias("large")), "simhash-large")
    rows = rows.join(large, ["block", "value"], "left")
    # The fingerprint without its block, and a key for each block of the rest.
    again = F.lit(None)
    for i, (low, bits) in enumerate(first):
        rest = F.when(F.lit(low + bits < 64), F.shiftleft(F.shiftrightunsigned("fp", min(low + bits, 63)), low)).otherwise(0).bitwiseOR(F.col("fp").bitwiseAND(F.lit((1 << low) - 1)))
        keys = F.array(*(F.lit(j + 1 << 16).cast("bigint").bitwiseOR(_value(rest, lo, b)) for j, (lo, b) in enumerate(_blocks(64 - bits, count))))
        again = F.when(F.col("block") == i, keys).otherwise(again)
    deep = F.when(F.col("large"), again).otherwise(F.array(F.lit(0).cast("bigint")))
    key = F.shiftleft(F.col("block").cast("bigint"), 56).bitwiseOR(F.shiftleft("value", 24)).bitwiseOR(F.col("deep"))
    return rows.select("fp", "node", "block", "value", F.explode(deep).alias("deep")).select(key.alias("key"), "fp", "node")


class GrayIndex:
    """Index over fingerprints sorted by key and Gray rank; keys do not meet."""

    def __init__(self, keys: np.ndarray, fps: np.ndarray):
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        ends = np.r_[starts[1:], len(keys)]
        self.fps, self.ends = fps, np.repeat(ends, ends - starts)
        # From the leaves up: shared bits and pattern of each node, and its children's range.
        level = {"mask": np.full(len(fps), 2**64 - 1, np.uint64), "bits": fps, "last": np.arange(1, len(fps) + 1)}
        self.levels = [level]
        own, size = starts, ends - starts
        while (size > 1).any():
            ranges = -(-size // FANOUT)
            first = np.repeat(own, ranges) + FANOUT * (np.arange(ranges.sum()) - np.repeat(np.cumsum(ranges) - ranges, ranges))
            below = self.levels[-1]
            low, high = (f.reduceat(below[k], first) for f, k in ((np.bitwise_and, "bits"), (np.bitwise_or, "high" if "high" in below else "bits")))
            to = np.r_[first[1:], len(below["bits"])]
            level = {"mask": ~(low ^ high), "bits": low, "high": high, "first": first, "to": to, "last": below["last"][to - 1]}
            # A child keeps what its parent does not share.
            below["rest"] = below["mask"] & ~np.repeat(level["mask"], to - first)
            self.levels.append(level)
            own, size = np.cumsum(ranges) - ranges, ranges
        self.levels[-1]["rest"] = self.levels[-1]["mask"]
        self.root = np.repeat(np.arange(len(starts)), ends - starts)

    def within(self, queries: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of positions (query, later one of its key) within `max_bits`."""
        q, node, far = queries, self.root[queries], np.zeros(len(queries), np.int64)
        for depth in range(len(self.levels) - 1, -1, -1):
            level = self.levels[depth]
            far = far + np.bitwise_count((self.fps[q] ^ level["bits"][node]) & level["rest"][node])
            near = (far <= max_bits) & (level["last"][node] > q + 1)
            q, node, far = q[near], node[near], far[near]
            if depth:
                n = level["to"][node] - level["first"][node]
                node = np.repeat(level["first"][node], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                q, far = np.repeat(q, n), np.repeat(far, n)
        return q, node

    def roots(self, max_bits: int) -> np.ndarray:
        """Smallest position that each fingerprint reaches inside its key."""
        root = np.arange(len(self.fps))
        cost = np.cumsum(self.ends - root)
        at = 0
        while at < len(root):
            to = max(at + 1, int(np.searchsorted(cost, (cost[at - 1] if at else 0) + AT_ONCE)))
            a, b = self.within(np.arange(at, to), max_bits)
            while len(a):
                ra, rb = root[a], root[b]
                apart = ra != rb
                a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
                np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
                while (root[root] != root).any():
                    root = root[root]
            at = to
        return root


def _search(max_bits: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def links(rows: np.ndarray) -> pa.RecordBatch:
            root = GrayIndex(rows[0], rows[1].view(np.uint64)).roots(max_bits)
            linked = root != np.arange(len(root))
            nodes = rows[2]
            return pa.RecordBatch.from_arrays([pa.array(nodes[linked]), pa.array(nodes[root[linked]])], ["a", "b"])

        for batch in batches:
            held.append(np.stack([batch.column(i).to_numpy() for i in range(3)]))
            if sum(x.shape[1] for x in held) >= GATHER and held[-1].shape[1]:
                rows = np.concatenate(held, axis=1)
                cut = int(np.searchsorted(rows[0], rows[0, -1]))  # the last key may go on
                if cut:
                    yield links(rows[:, :cut])
                held = [rows[:, cut:]]
        if held and sum(x.shape[1] for x in held):
            yield links(np.concatenate(held, axis=1))

    return search


def links_within(classes: DataFrame, max_bits: int = MAX_BITS, deal_again: int = DEAL_AGAIN) -> DataFrame:
    """Links `a`, `b` that join all classes (fp, node) within `max_bits`, without all pairs of a group."""
    arrow_ready(classes.sparkSession, 10_000)
    rows = dealt(classes, max_bits, deal_again)
    return rows.repartition("key").sortWithinPartitions("key", gray_rank(F.col("fp"))).mapInArrow(_search(max_bits), "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, max_bits: int = MAX_BITS, deal_again: int = DEAL_AGAIN) -> DataFrame:
    """A row per document: doc_id, fp, and component_id, the smallest doc_id that it reaches.

    NULL and empty texts have fingerprint 0 and link like any other. Repeated
    rows and equal texts are one class. A row without a doc_id gets the
    component of its fingerprint, NULL if no row with an id has that one.
    """
    prints = written(fingerprints(docs), "simhash-prints")
    classes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("node")).where(F.col("node").isNotNull()), "simhash-classes")
    found = components(links_within(classes, max_bits, deal_again))
    named = classes.join(found, "node", "left").select("fp", F.coalesce("root", "node").alias("component_id"))
    return prints.join(named, "fp", "left").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each component, with all its columns: the one with the smallest id.

    Rows are told apart by id and text. An id that comes with several texts is a
    document for each, so texts that are not alike stay, all of them; of alike
    ones under one id the least by hash stays. Rows without an id are compared
    like any other and come after those with one. Of rows with equal id and text
    the least by the other columns stays.
    """
    key = {"__of": F.col("doc_id").cast("bigint"), "__a": F.xxhash64("text"), "__b": F.xxhash64(F.lit(1), "text")}
    prints = written(fingerprints(docs, {"a": key["__a"], "b": key["__b"]}), "simhash-prints")
    classes = written(prints.select("fp", F.col("fp").alias("node")).distinct(), "simhash-classes")
    found = components(links_within(classes, max_bits))
    named = prints.join(found, prints["fp"] == found["node"], "left").select(F.coalesce("root", "fp").alias("root"), "doc_id", "a", "b")
    order = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "a", "b")
    kept = named.groupBy("root").agg(F.min(order).alias("least")).select(*(F.col(f"least.{c}").alias(k) for c, k in zip(("doc_id", "a", "b"), key, strict=True)))
    rows = docs.withColumns(key).alias("x").join(kept.alias("y"), F.col("x.__of").eqNullSafe(F.col("y.__of")) & (F.col("x.__a") == F.col("y.__a")) & (F.col("x.__b") == F.col("y.__b")), "left_semi")
    return rows.groupBy(*key).agg(F.min(F.struct(*docs.columns)).alias("row")).select("row.*")
