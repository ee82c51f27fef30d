"""Alignment of two tokenizers over the same bytes, by an associative fragment monoid.

Tokens of tokenizers A and B cover the same bytes; where one of each ends at
the same offset, a group of tokens ends. A `Fragment` stands for a stretch of bytes
whose neighbours are not known: an open head up to its first common end, closed groups,
and an open tail after its last one. `combine` joins neighbouring fragments and is
associative, so that fragments of a very long text, encoded by many tasks, are put
together in a tree of any shape.

Ordinary texts are cut where neither tokenizer can join bytes across the cut; such a
segment is a run of closed groups that a worker works out once and remembers.
How often two ids are linked in the whole corpus is asked of shards by B id, by
block, see `blocks`.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain, islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dumpflow.llm import blocks as B
from dumpflow.llm.stages import arrow_ready

MARK = "▁"
#: Texts with more code points are cut into ranges of about that many, and so many fragments are combined in a task.
RANGE, FAN = 1 << 16, 8
#: Bytes of text in a block, and for each shard of the link counts.
BLOCK_BYTES, SHARD_BYTES = 4 << 20, 8 << 20
#: Segments that a worker process remembers, from task to task, and the longest of them; texts in one call of a tokenizer.
REMEMBERED, LONGEST, AT_ONCE = 200_000, 64, 4_096
#: A segment goes to where a space or line end follows a character that is no white space.
SEGMENT = re.compile(r"\s*\S+(?:[^\S\n ]\s*\S+)*(?:\s+\Z)?|\s+\Z")
#: Where tokens of A, and of B, surely end: B's pieces may hold other white space inside, and a mark in the text is a space to B.
A_CUT, B_CUT = re.compile(r"(?<=\S)(?=\s)"), re.compile(rf"(?<=[^\s{MARK}])(?=[ \n]\S)")
SCHEMA = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups string"

Tokens = tuple[list[int], list[int]]


class Closed(NamedTuple):
    """Closed groups: their text, the tokens and groups in them, and their links as packed 64-bit numbers, B id * 2^32 + A id."""

    text: str = ""
    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    links: bytes = b""

    def __add__(self, other: Closed) -> Closed:
        text = self.text + ";" + other.text if self.text and other.text else self.text or other.text
        return Closed(text, self.n_a + other.n_a, self.n_b + other.n_b, self.n_groups + other.n_groups, self.links + other.links)


class Fragment(NamedTuple):
    """`head` holds tokens (ids and end offsets) of A and of B to the first common end, or all where there is none."""

    cut: bool
    head: tuple[Tokens, Tokens]
    closed: Closed = Closed()
    tail: tuple[Tokens, Tokens] = (([], []), ([], []))


def close(a: Tokens, b: Tokens) -> Closed:
    """The groups of tokens that start at a common offset and end at one.

    Inside a group the byte ranges of A and B overlap like two interleaved rulers: the token that ends first
    is left, so a group of n and m tokens has n + m - 1 links.
    """
    (a_ids, a_ends), (b_ids, b_ends) = a, b
    groups, links, i, j, i0, j0 = [], [], 0, 0, 0, 0
    n = len(a_ids)
    while i < n:
        x, y = a_ids[i], b_ids[j]
        links.append(y << 32 | x)
        if a_ends[i] < b_ends[j]:
            i += 1
        elif a_ends[i] > b_ends[j]:
            j += 1
        else:
            single, i, j = i == i0 and j == j0, i + 1, j + 1
            groups.append(f"{x}|{y}" if single else ",".join(map(str, a_ids[i0:i])) + "|" + ",".join(map(str, b_ids[j0:j])))
            i0, j0 = i, j
    return Closed(";".join(groups), n, len(b_ids), len(groups), array("q", links).tobytes())


def _split(tokens: Tokens, end: int) -> tuple[Tokens, Tokens]:
    """The tokens up to an end offset, and those after it."""
    k = int(np.searchsorted(tokens[1], end, side="right"))
    return (tokens[0][:k], tokens[1][:k]), (tokens[0][k:], tokens[1][k:])


def fragment_of(a: Tokens, b: Tokens) -> Fragment:
    common = np.intersect1d(a[1], b[1])
    if not len(common):
        return Fragment(False, (a, b))
    (a_head, a_rest), (b_head, b_rest) = _split(a, common[0]), _split(b, common[0])
    (a_mid, a_tail), (b_mid, b_tail) = _split(a_rest, common[-1]), _split(b_rest, common[-1])
    return Fragment(True, (a_head, b_head), close(a_mid, b_mid), (a_tail, b_tail))


def combine(left: Fragment, right: Fragment) -> Fragment:
    """The fragment of two neighbouring stretches; the tokens between their common ends are looked at again."""
    seam = fragment_of(*(
        (x[0] + y[0], x[1] + y[1]) for x, y in zip(left.tail if left.cut else left.head, right.head, strict=True)))
    if not seam.cut:
        return Fragment(True, left.head, left.closed, seam.head) if left.cut else seam
    # Behind a left cut the seam starts at a common offset, so its head is a group as well.
    closed = left.closed + close(*seam.head) + seam.closed if left.cut else seam.closed
    head = left.head if left.cut else seam.head
    return Fragment(True, head, closed + right.closed, right.tail) if right.cut else Fragment(True, head, closed, seam.tail)


def whole(fragment: Fragment) -> Closed:
    """The groups of a whole text, whose start is a common offset and whose end must be one."""
    if not fragment.cut or fragment.tail[0][0] or fragment.tail[1][0]:
        raise ValueError("the tokens do not end together")
    return close(*fragment.head) + fragment.closed


def byte_of_char() -> dict[str, int]:
    """Bytes by the characters that stand for them in byte-level vocabularies: visible Latin-1 ones for themselves, the rest from U+0100 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(rest)}


class Aligner:
    """Both tokenizers with the bytes of their ids, and the groups of segments seen so far."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        chars = byte_of_char()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(chars[c] for c in token) if all(c in chars for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        self.a_sizes, self.b_sizes = (np.array([len(t) for t in table]) for table in (self.a_bytes, self.b_bytes))
        #: Decimal ids with what follows them in the text of groups; a line end closes a segment.
        self.shown = [[f"{i}{after}" for i in range(max(len(self.a_bytes), len(self.b_bytes)))] for after in (",", "|", ";", "\n")]
        self.mark = self.b.piece_to_id(MARK)
        plain = [p for i, p in enumerate(pieces) if not self.b.is_byte(i)]
        split = json.loads(self.a.to_str()).get("pre_tokenizer") or {}
        probe = "".join(self.b_bytes[i].decode() for i in self.b.encode("a  b "))
        #: Whether texts may be cut into segments.
        self.cuts = (split.get("type"), split.get("use_regex")) == ("ByteLevel", True) and probe == " a  b " and not any(
            re.search(f"[^{MARK}]{MARK}", p) or "\n" in p for p in plain)
        self.known: dict[str, Closed | None] = {}

    def segments(self, text: str) -> list[str]:
        """The parts of space + text that both tokenizers encode on their own. A text with a mark, a space to B, is one part."""
        return SEGMENT.findall(" " + text) if self.cuts and MARK not in text else [" " + text]

    def tokens_a(self, texts: list[str]) -> list[list[int]]:
        """A's ids of whole texts, or of parts that start at a cut."""
        return [e.ids for i in range(0, len(texts), AT_ONCE) for e in self.a.encode_batch_fast(texts[i : i + AT_ONCE], add_special_tokens=False)]

    def tokens_b(self, texts: list[str]) -> list[list[int]]:
        """B's ids of parts of space + text: the space that B puts in front stands for the first one, or is dropped."""
        out = self.b.encode([t[1:] if t[:1] == " " else t for t in texts], num_threads=1)
        return [ids if t[:1] == " " or ids[:1] != [self.mark] else ids[1:] for t, ids in zip(texts, out, strict=True)]

    @staticmethod
    def ended(ids: list[int], table: list[bytes], text: str, start: int = 0) -> Tokens | None:
        """Ids with end offsets; None if their bytes are not those of the text."""
        parts = [table[i] for i in ids]
        if b"".join(parts) != text.encode():
            return None
        ends = list(accumulate(map(len, parts), initial=start))
        return ids, ends[1:]

    def close_all(self, segments: list[str], a_lists: list[list[int]], b_lists: list[list[int]]) -> list[Closed | None]:
        """`close` of each segment, all in one go, as if they were one text."""
        raw = [s.encode() for s in segments]
        ends = np.cumsum([len(r) for r in raw])
        sides = []
        for lists, table, sizes in ((a_lists, self.a_bytes, self.a_sizes), (b_lists, self.b_bytes, self.b_sizes)):
            ids = np.fromiter(chain.from_iterable(lists), np.int64)
            at = np.cumsum(sizes[ids])
            last = np.cumsum([len(x) for x in lists]) - 1
            if b"".join(map(table.__getitem__, ids.tolist())) != b"".join(raw) or not all(lists) or (at[last] != ends).any():
                good = [k for k, (s, a, b) in enumerate(zip(segments, a_lists, b_lists, strict=True))
                        if a and b and self.ended(a, self.a_bytes, s) and self.ended(b, self.b_bytes, s)]
                some = self.close_all(*([x[k] for k in good] for x in (segments, a_lists, b_lists))) if good else []
                found = dict(zip(good, some, strict=True))
                return [found.get(k) for k in range(len(segments))]
            sides.append((ids, at))
        (a, a_at), (b, b_at) = sides
        # Between two neighbouring ends of either side lie one token of A and one of B: a link.
        a_common = b_at[np.searchsorted(b_at, a_at)] == a_at
        b_common = a_at[np.searchsorted(a_at, b_at)] == b_at
        common = a_at[a_common]
        marks = np.sort(np.r_[a_at, b_at[~b_common]], kind="stable")
        links = (b[np.searchsorted(b_at, marks)] << 32) | a[np.searchsorted(a_at, marks)]
        # The text: of each group A's ids, then B's, each with what follows it.
        ids, group = np.r_[a, b], np.r_[np.searchsorted(common, a_at) * 2, np.searchsorted(common, b_at) * 2 + 1]
        after = np.r_[a_common * 1, b_common * 2]
        after[len(a) + np.searchsorted(b_at, ends)] = 3
        order = np.argsort(group, kind="stable")
        texts = "".join([self.shown[k][i] for k, i in zip(after[order].tolist(), ids[order].tolist(), strict=True)]).split("\n")
        places = [np.r_[0, np.searchsorted(x, ends, side="right")].tolist() for x in (a_at, b_at, common, marks)]
        packed = links.tobytes()
        return [Closed(texts[k], a1 - a0, b1 - b0, g1 - g0, packed[8 * m0 : 8 * m1]) for k, (a0, a1, b0, b1, g0, g1, m0, m1) in enumerate(zip(
            *(x for p in places for x in (p, p[1:])), strict=False))]

    def closed(self, segments: list[str]) -> list[Closed | None]:
        """The groups of different segments; None where a tokenizer does not give a segment's bytes back."""
        if len(self.known) > REMEMBERED:  # the older half goes
            self.known = dict(islice(self.known.items(), len(self.known) // 2, None))
        known = self.known
        out = [known.get(s, 0) for s in segments]
        new = [k for k, c in enumerate(out) if c == 0]
        for i in range(0, len(new), AT_ONCE):  # ids of few segments are held at a time
            places = new[i : i + AT_ONCE]
            part = [segments[k] for k in places]
            for k, s, c in zip(places, part, self.close_all(part, self.tokens_a(part), self.tokens_b(part)), strict=True):
                out[k] = c
                if len(s) <= LONGEST:
                    known[s] = c
        return out


@lru_cache(maxsize=2)
def aligner_of(a_path: str, b_path: str) -> Aligner:
    """One per worker process, so that tasks share its memory."""
    return Aligner(a_path, b_path)


class Table(NamedTuple):
    """A block: `at` lists the parts of each document, `links` the pairs of ids of each part as places in `pairs`, which ascend."""

    doc_ids: list[int | None]
    at: np.ndarray
    doc_ends: np.ndarray
    texts: list[str]
    sizes: np.ndarray
    links: np.ndarray
    link_ends: np.ndarray
    pairs: np.ndarray


def table_of(doc_ids: list, parts: list[list[int]], closed: list[Closed]) -> Table:
    pairs, links = np.unique(np.frombuffer(b"".join(c.links for c in closed), np.int64), return_inverse=True)
    n_links = [len(c.links) // 8 for c in closed]
    return Table(
        doc_ids, np.array([k for p in parts for k in p], np.uint32), np.cumsum([0, *map(len, parts)]), [c.text for c in closed],
        np.array([(c.n_a, c.n_b, c.n_groups, n) for c, n in zip(closed, n_links, strict=True)], np.int64).reshape(-1, 4),
        links.astype(np.uint32), np.cumsum([0, *n_links]), pairs)


def counted(table: Table) -> np.ndarray:
    """How often each pair of a block is linked in it."""
    times = np.bincount(table.at, minlength=len(table.texts))
    weights = np.repeat(times, np.diff(table.link_ends))
    return np.bincount(table.links, weights, len(table.pairs)).astype(np.int64)


def add_counts(given: list[bytes]) -> list[bytes]:
    """Add the counts of all blocks; per block the sum of each of its pairs, and whether its B id has none higher."""
    parts = [B.unpack(raw) for raw in given]
    pairs, at = np.unique(np.concatenate([p for p, _ in parts]), return_inverse=True)
    sums = np.zeros(len(pairs), np.int64)
    np.add.at(sums, at, np.concatenate([n for _, n in parts]))
    starts = np.flatnonzero(np.diff(pairs >> 32, prepend=-1))
    best = sums == np.repeat(np.maximum.reduceat(sums, starts), np.diff(np.r_[starts, len(pairs)]))
    return [B.pack((sums[k], best[k])) for k in np.split(at, np.cumsum([len(p) for p, _ in parts])[:-1])]


def _short_blocks(docs: DataFrame, a_path: str, b_path: str, block_bytes: int) -> DataFrame:
    """Blocks of texts that one task encodes whole."""
    schema = B.arrow_schema(B.BLOCK)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, part, count = aligner_of(a_path, b_path), TaskContext.get().partitionId(), 0

        def block() -> pa.RecordBatch:
            groups = aligner.closed(list(number))
            bad = {k for k, c in enumerate(groups) if c is None}
            kept = [[] if bad and not bad.isdisjoint(p) else p for p in parts]
            table = table_of(ids, kept, [c or Closed() for c in groups])
            return B.batch_of([(f"whole-{part}-{count}", held, B.pack(table))], schema)

        ids, parts, number, held = [], [], {}, 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids.append(doc_id)
                parts.append([number.setdefault(s, len(number)) for s in aligner.segments(text)] if text else [])
                held += len(text or "") + 1
                if held >= block_bytes:
                    yield block()
                    ids, parts, number, held, count = [], [], {}, 0, count + 1
        if ids:
            yield block()

    return docs.mapInArrow(of, B.BLOCK)


def ranges_of(text: str, size: int, cuts: bool) -> Iterator[tuple[int, str, int, str]]:
    """For each range of `size` code points: the byte offset and the text of what A encodes of it, and of what B does.

    Either part goes from the first sure cut of its tokenizer at or after the start of the range to that of the
    next range, so it may be empty, and the parts of A and B differ.
    """
    whole_text = " " + text

    def edges(pattern: re.Pattern) -> list[int]:
        out = [0]
        for k in range(size, len(whole_text), size) if cuts else ():
            if out[-1] < k:  # else the same cut
                found = pattern.search(whole_text, k)
                out.append(found.start() if found else len(whole_text))
            else:
                out.append(out[-1])
        return [*out, len(whole_text)]

    a_edges, b_edges = edges(A_CUT), edges(B_CUT)
    a_at = b_at = 0
    for a0, a1, b0, b1 in zip(a_edges, a_edges[1:], b_edges, b_edges[1:], strict=False):
        a_part, b_part = whole_text[a0:a1], whole_text[b0:b1]
        yield a_at, a_part, b_at, b_part
        a_at, b_at = a_at + len(a_part.encode()), b_at + len(b_part.encode())


RANGES = "key bigint, doc_id bigint, place bigint, a_from bigint, a_part string, b_from bigint, b_part string"
FRAGMENTS = "key bigint, doc_id bigint, place bigint, payload binary"


def _long_blocks(docs: DataFrame, a_path: str, b_path: str, size: int, fan: int, block_bytes: int) -> DataFrame:
    """Blocks of very long texts: byte ranges dealt to all tasks, their fragments combined in a tree."""
    ranges, fragments, block_schema = B.arrow_schema(RANGES), B.arrow_schema(FRAGMENTS), B.arrow_schema(B.BLOCK)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = aligner_of(a_path, b_path).cuts
        for batch in batches:
            for row in batch.to_pylist():
                for place, part in enumerate(ranges_of(row["text"], size, cuts)):
                    yield B.batch_of([(row["key"], row["doc_id"], place, *part)], ranges)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = aligner_of(a_path, b_path)
        for batch in batches:
            for r in batch.to_pylist():
                a = aligner.ended(aligner.tokens_a([r["a_part"]])[0], aligner.a_bytes, r["a_part"], r["a_from"])
                b = aligner.ended(aligner.tokens_b([r["b_part"]])[0] if r["b_part"] else [], aligner.b_bytes, r["b_part"], r["b_from"])
                found = None if a is None or b is None else fragment_of(a, b)
                yield B.batch_of([(r["key"], r["doc_id"], r["place"], B.pack(found))], fragments)

    def join(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["place"])
        out = B.unpack(rows[0]["payload"])
        for r in rows[1:]:
            right = B.unpack(r["payload"])
            out = None if out is None or right is None else combine(out, right)
        first = rows[0]
        return pa.Table.from_batches([B.batch_of([(first["key"], first["doc_id"], first["place"] // fan, B.pack(out))], fragments)])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count, ids, closed, held = TaskContext.get().partitionId(), 0, [], [], 0

        def block() -> pa.RecordBatch:
            parts = [[k] if c.n_groups else [] for k, c in enumerate(closed)]
            return B.batch_of([(f"combined-{part}-{count}", held, B.pack(table_of(ids, parts, closed)))], block_schema)

        for batch in batches:
            for r in batch.to_pylist():
                fragment = B.unpack(r["payload"])
                ids.append(r["doc_id"])
                closed.append(Closed() if fragment is None else whole(fragment))
                held += len(closed[-1].text) // 2 + 1
                if held >= block_bytes:
                    yield block()
                    ids, closed, held, count = [], [], 0, count + 1
        if ids:
            yield block()

    keyed = docs.withColumn("key", F.monotonically_increasing_id())
    dealt = keyed.mapInArrow(cut, RANGES).repartition(F.xxhash64("key", "place"))
    rows = B.kept(dealt.mapInArrow(encode, FRAGMENTS), "fragments")
    places = (rows.agg(F.max("place")).first()[0] or 0) + 1
    while places > 1:
        rows = rows.groupBy("key", F.floor(F.col("place") / fan).alias("part")).applyInArrow(join, FRAGMENTS)
        places = -(-places // fan)
    return rows.mapInArrow(gather, B.BLOCK)


def align(docs: DataFrame, a_path: str, b_path: str, size: int = RANGE, fan: int = FAN,
          block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Token groups and links of every row of `docs` (doc_id, text), read as space + text.

    A is a byte-level tokenizers file, B a sentencepiece model, neither with special tokens. Returns
    doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and `groups`, such as `a1,a2|b1;a3|b2,b3`. A
    link is a pair of tokens whose bytes overlap, a pair's count the links of its two ids in the
    corpus; n_best are the links whose count is the highest of their B id. NULL and empty texts, and
    those whose bytes a tokenizer does not give back, have no tokens: zeros and ''. Rows are worked out each
    on its own, whatever their doc_id; other columns are ignored.
    """
    arrow_ready(docs.sparkSession, 200)
    rows = docs.select(F.col("doc_id").cast("bigint"), "text")
    is_long = F.coalesce(F.length("text"), F.lit(0)) > size
    packed = _short_blocks(rows.where(~is_long), a_path, b_path, block_bytes).unionByName(
        _long_blocks(rows.where(is_long), a_path, b_path, size, fan, block_bytes))
    stored = B.write_blocks(packed, "alignment")
    shards = max(1, -(-(stored.agg(F.sum("n_bytes")).first()[0] or 0) // shard_bytes))
    question = B.arrow_schema(B.QUESTION)

    def of_shards(table: Table) -> Iterator[tuple[int, np.ndarray]]:
        """(shard, places of its pairs); a shard has whole B ids."""
        used = np.flatnonzero(counted(table))
        shard = (table.pairs[used] >> 32) % shards
        used = used[np.argsort(shard, kind="stable")]
        for k, a, b in B.spans(np.sort(shard)):
            yield k, used[a:b]

    def count(name: str, table: Table, _: list[dict]) -> Iterator[pa.RecordBatch]:
        times = counted(table)
        for shard, at in of_shards(table):
            yield B.batch_of([(shard, name, B.pack((table.pairs[at], times[at])))], question)

    def resolve(name: str, table: Table, answers: list[dict]) -> Iterator[pa.RecordBatch]:
        sums, best = np.zeros(len(table.pairs), np.int64), np.zeros(len(table.pairs), np.int64)
        for shard, at in of_shards(table):
            sums[at], best[at] = B.unpack(answers[0][shard])
        # Per part, then per document, as differences of running sums.
        ends = table.link_ends
        of_part = np.column_stack([table.sizes, *(np.diff(np.r_[0, np.cumsum(x[table.links])][ends]) for x in (best, sums))])
        running = np.concatenate([np.zeros((1, 6), np.int64), np.cumsum(of_part[table.at], axis=0)])
        totals = np.diff(running[table.doc_ends], axis=0)
        rows, held = [], 0
        for k, doc_id in enumerate(table.doc_ids):
            text = ";".join([table.texts[p] for p in table.at[table.doc_ends[k] : table.doc_ends[k + 1]].tolist()])
            rows.append((doc_id, *totals[k].tolist(), text))
            held += len(text)
            if held > 4 << 20:
                yield B.batch_of(rows, B.arrow_schema(SCHEMA))
                rows, held = [], 0
        if rows:
            yield B.batch_of(rows, B.arrow_schema(SCHEMA))

    counts = B.kept(B.answered(B.over_blocks(stored, count, B.QUESTION), add_counts), "alignment-counts")
    return B.over_blocks(stored, resolve, SCHEMA, counts)
