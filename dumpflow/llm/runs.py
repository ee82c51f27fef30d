"""Periodic runs of words, from Lyndon arrays that Baier's grouping yields.

Phase one of Baier's suffix sorter refines groups of suffixes from the
greatest group down. When a group is reached, its context is the longest
Lyndon word at each of its places, so the Lyndon array falls out without a
suffix array: the places not reached yet form a linked list, in which the
neighbour to the right of a place is the next smaller suffix and the one to
the left the place whose context the group extends. This is done under the
order of words and under its reverse, as each run holds a Lyndon root that is
the longest Lyndon word at its place under one of them. The longest common
extension (LCE) of a root and its next copy, both ways, gives the whole run.

Runs of at least `exponent` periods hold each of their words that often, and
so does any stretch that extends them. Texts are therefore first cut at words
that occur fewer times in their piece, until no such word is left; no run is
lost, and only the pieces are sorted.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dumpflow.llm.stages import arrow_ready
from dumpflow.llm.text import words_of

#: Pieces longer than this are held in 32-bit arrays instead of lists.
LONG = 1 << 16
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def lyndon_array(word: list[int]) -> list[int]:
    """Length of the longest Lyndon word at each place; `word` uses every number from 0 to its greatest."""
    n, kinds = len(word), max(word, default=-1) + 1
    numbers = list if n <= LONG else (lambda values: array("i", values))
    members: list[list[int]] = [[] for _ in range(kinds)]  # of each group, in ascending order
    for i, w in enumerate(word):
        members[w].append(i)
    group, out = numbers(word), numbers(word)
    below, above = list(range(-1, kinds - 1)), list(range(1, kinds + 1))
    left, right = numbers(range(-1, n - 1)), numbers(range(1, n + 1))
    g = kinds - 1
    while g >= 0:  # whatever is below g has a group above it, g at most
        extended: dict[int, int] = {}  # places whose context this group's goes on from, and how many times in a row
        for i in members[g]:
            if group[i] != g:  # in a greater group by now
                continue
            before, after = left[i], right[i]
            out[i] = after - i
            if after < n:
                left[after] = before
            if before >= 0:
                right[before] = after
                extended[before] = extended.get(before, 0) + 1
        parts: dict[tuple[int, int], list[int]] = {}
        for j, times in extended.items():
            parts.setdefault((group[j], times), []).append(j)
        # Each part becomes a group right above its old one; more copies of the context make it greater.
        for (old, _), places in sorted(parts.items(), reverse=True):
            new, over = len(members), above[old]
            members.append(places)
            below.append(old)
            above.append(over)
            above[old] = new
            below[over] = new
            for j in places:
                group[j] = new
        g = below[g]
    return out


def extension(word: np.ndarray, i: int, j: int, step: int) -> int:
    """Length of the longest common extension of places i < j, to the right (step 1) or to the left of them (-1)."""
    done, most, at_once = 0, (len(word) - j if step > 0 else i), 64
    while done < most:
        k = min(at_once, most - done)
        if step > 0:
            differ = np.flatnonzero(word[i + done : i + done + k] != word[j + done : j + done + k])
        else:
            differ = np.flatnonzero(word[i - done - k : i - done][::-1] != word[j - done - k : j - done][::-1])
        if len(differ):
            return done + int(differ[0])
        done, at_once = done + k, 2 * at_once
    return done


def runs_of(word: np.ndarray, exponent: int, shortest: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs in a piece with `exponent` periods and `shortest` words at least.

    Such a run holds exponent - 1 copies of its root in a row, each the longest Lyndon word at its place.
    """
    _, ranks = np.unique(word, return_inverse=True)
    found = set()
    for numbers in (ranks, ranks.max() - ranks):
        periods = np.asarray(lyndon_array(numbers.tolist()))
        places = np.arange(len(word))
        ahead, root = places, np.ones(len(word), bool)
        for _ in range(exponent - 2):
            ahead = ahead + periods
            root &= ahead < len(word)
            root &= periods[np.minimum(ahead, len(word) - 1)] == periods
        last: dict[int, int] = {}  # end of the newest run of a period
        for i in np.flatnonzero(root).tolist():
            p = int(periods[i])
            if i + p <= last.get(p, 0):
                continue
            if i + p >= len(word):
                continue
            start = i - extension(word, i, i + p, -1)
            last[p] = end = i + p + extension(word, i, i + p, 1)
            if end - start >= max(shortest, exponent * p):
                found.add((start, end - start, p))
    return sorted(found, key=lambda r: (r[0], r[2]))


def pieces_of(words: np.ndarray, texts: np.ndarray, fewest: int, shortest: int) -> Iterator[tuple[int, int]]:
    """Stretches, as (first, one after the last), of one text each in which every word occurs `fewest` times."""
    at = np.arange(len(words))
    while len(at):
        piece = np.cumsum(np.r_[False, (np.diff(at) != 1) | (np.diff(texts[at]) != 0)])
        _, kind, counts = np.unique(piece * (int(words.max()) + 1) + words[at], return_inverse=True, return_counts=True)
        often = counts[kind] >= fewest
        if often.all():
            edges = np.r_[0, np.flatnonzero(np.diff(piece)) + 1, len(at)]
            for a, b in zip(edges.tolist(), edges[1:].tolist(), strict=False):
                if b - a >= shortest:
                    yield int(at[a]), int(at[b - 1]) + 1
            return
        at = at[often]


def find(docs: DataFrame, exponent: int = 4, shortest: int = 6) -> DataFrame:
    """doc_id, n_words, `runs` and `collapsed` of every row of `docs` (doc_id, text).

    A run is a stretch of words with smallest period p (words p apart are the
    same), at least `exponent` * p and `shortest` words long, that no
    neighbouring word goes on; runs come by start, then period, places count
    from 0. `collapsed` is the text without the words that any run holds after
    its first period, joined by one space. Each row is worked out on its own:
    NULL and empty texts have no words and no runs, rows that repeat an id or
    lack one are kept, other columns are ignored.
    """
    if exponent < 2:
        raise ValueError("a run has two periods at least")

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            split = [(t or "").encode().split() for t in batch.column(1).to_pylist()]
            number: dict[bytes, int] = {}
            coded = np.array([number.setdefault(w, len(number)) for words in split for w in words], np.int64)
            starts = np.cumsum([0, *map(len, split)])
            texts = np.repeat(np.arange(len(split)), np.diff(starts))
            runs: list[list[tuple[int, int, int]]] = [[] for _ in split]
            for a, b in pieces_of(coded, texts, exponent, shortest):
                text = int(texts[a])
                runs[text] += [(s + a - int(starts[text]), n, p) for s, n, p in runs_of(coded[a:b], exponent, shortest)]
            collapsed = []
            for words, found in zip(split, runs, strict=True):
                kept = np.ones(len(words), bool)
                for s, n, p in found:
                    kept[s + p : s + n] = False
                rest = words if not found else [words[i] for i in np.flatnonzero(kept)]
                collapsed.append(b" ".join(rest).decode())
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([len(w) for w in split], pa.int64()),
                pa.array([[{"start": s, "length": n, "period": p} for s, n, p in found] for found in runs], pa.list_(RUN)),
                pa.array(collapsed, pa.string()),
            ], ["doc_id", "n_words", "runs", "collapsed"])

    arrow_ready(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("bigint"), "text")
    return rows.mapInArrow(of, f"doc_id bigint, n_words bigint, runs {RUNS}, collapsed string")


def strongest(runs: Column) -> Column:
    """The run with the greatest length by period; of equal ones the first. NULL where there is none."""
    return F.aggregate(runs, F.get(runs, F.lit(0)), lambda best, r: F.when(
        r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Texts of every tenth document, by the CRC-32 of its id, made periodic from a place that this number gives."""
    h = F.crc32(F.col("doc_id").cast("string"))
    planted = docs.select("doc_id", "text", (h % 10 == 0).alias("planted"), F.floor(h / 10).alias("g"),
                          F.when(h % 10 == 0, words_of(F.col("text"))).alias("words")).withColumn("n", F.size("words"))
    planted = planted.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    planted = planted.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    head = F.slice("words", F.lit(1), F.col("a").cast("int"))
    tail = F.transform(F.sequence(F.lit(0), F.col("n") - 1 - F.col("a")), lambda i: F.get("words", (F.col("a") + i % F.col("p")).cast("int")))
    text = F.when(F.col("planted") & (F.col("n") > 0), F.array_join(F.concat(head, tail), " ")).otherwise(F.col("text"))
    return planted.select("doc_id", text.alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """The columns of `op12_word_runs` from what `find` gives."""
    best = strongest(F.col("runs"))
    rows = found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.alias("best"), F.sha2(F.array_join(F.transform(
        "runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), ""), 256)
        .alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return rows.select("doc_id", "n_runs", "best.start", "best.length", "best.period",
                       F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


#: `op12_word_runs` as DuckDB SQL: words equal at a distance, and stretches of such places.
RUNS_SQL = r"""
WITH b AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[ 	-]+'), lambda w: w <> '') AS words,
         xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT)),
             lambda c, x: list_reduce(list_prepend(xor(c, x), [0, 0, 0, 0, 0, 0, 0, 0]), lambda v, z: xor(v >> 1, (v & 1) * 3988292384))), 4294967295) AS h
  FROM documents),
e AS (SELECT *, CASE WHEN h % 10 = 0 AND len(words) > 0 THEN (h // 10) % len(words) END AS a FROM b),
d AS (SELECT r, doc_id, CASE WHEN a IS NULL THEN words ELSE list_transform(range(len(words)), lambda i:
             CASE WHEN i < a THEN words[i + 1] ELSE words[a + (i - a) % (1 + (len(words) - a) // (3 + (h // 10) % 8)) + 1] END) END AS words FROM e),
w AS (SELECT r, len(words) AS n, unnest(words) AS word, unnest(range(len(words))) AS i FROM d),
m AS (SELECT x.r, y.i - x.i AS p, x.i FROM w x JOIN w y ON x.r = y.r AND x.word = y.word AND y.i > x.i AND (y.i - x.i) * 4 <= x.n),
s AS (SELECT r, p, min(i) AS start, count(*) + p AS length
      FROM (SELECT *, i - row_number() OVER (PARTITION BY r, p ORDER BY i) AS k FROM m) GROUP BY r, p, k
      HAVING count(*) + p >= greatest(6, 4 * p)),
u AS (SELECT r, start, length, min(p) AS p FROM s GROUP BY r, start, length),
o AS (SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || p || chr(10), '' ORDER BY start, p) AS t,
             arg_min({'start': start, 'length': length, 'p': p}, {'k': -length::DOUBLE / p, 'start': start, 'p': p}) AS best FROM u GROUP BY r),
gone AS (SELECT DISTINCT r, unnest(range(start + p, start + length)) AS i FROM u),
c AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS t FROM w WHERE r IN (SELECT r FROM u) AND NOT EXISTS (FROM gone WHERE gone.r = w.r AND gone.i = w.i) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best.start::BIGINT AS start, best.length::BIGINT AS length, best.p::BIGINT AS period,
       (1000 * best.length // best.p)::BIGINT AS exponent_milli, sha256(coalesce(o.t, '')) AS runs_sha256,
       sha256(coalesce(c.t, array_to_string(words, ' '))) AS collapsed_sha256
FROM d LEFT JOIN o USING (r) LEFT JOIN c USING (r)
"""
