"""SentencePiece encoding and decoding.

An Aho-Corasick automaton over all pieces reads a text once. At every position
it has, through its output links, each piece that ends there; the best score up
to the position is relaxed from where that piece starts. A character that no
piece covers falls back to its bytes. Scores of a BPE model are merge ranks, not
log probabilities, so a piece of rank r scores -log(r + 2), the frequency that
Zipf's law gives that rank; a unigram model's own scores are used as they are.

Spaces become the mark U+2581, with one more in front of the text. The mark
itself, where a text has it, is spelled in bytes, so decoding gives the text
back exactly.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from dumpflow.llm.stages import arrow_ready

MARK = "▁"
#: Scores are whole millionths, so that sums are exact and ties are ties.
UNIT = 1_000_000
#: Segments that a worker process remembers, from task to task, and the longest of them in characters.
REMEMBERED, LONGEST = 700_000, 48


class Pieces:
    """Pieces of a model file with their integer scores."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(model.get_piece_size())
        self.piece = {i: model.id_to_piece(i) for i in every}
        raw = {i: model.get_score(i) for i in every}
        bytes_ = {i: int(self.piece[i][3:5], 16) for i in every if model.is_byte(i)}
        self.byte_id = {b: i for i, b in bytes_.items()}
        self.unknown = model.unk_id()
        plain = [i for i in every if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        ranks = all(float(raw[i]).is_integer() for i in plain)
        self.score = {i: round(UNIT * (-math.log(2 - raw[i]) if ranks else raw[i])) for i in plain}
        self.fallback = min(self.score.values()) - 10 * UNIT  # a byte, or an unknown character
        self.text = [b""] * len(every)
        for i in plain:
            self.text[i] = self.piece[i].replace(MARK, " ").encode()
        for i, b in bytes_.items():
            self.text[i] = bytes([b])
        self.automaton = ahocorasick.Automaton()
        for i in plain:
            self.automaton.add_word(self.piece[i], (len(self.piece[i]), i, self.score[i]))
        self.automaton.make_automaton()
        self.single = {p for i, p in self.piece.items() if i in self.score and len(p) == 1}
        # A text may be cut where no piece can lie across: before a mark, and around line ends.
        self.cut = None
        if not any(re.search(f"[^{MARK}]{MARK}", self.piece[i]) or "\n" in self.piece[i] for i in plain):
            self.cut = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n+")
        self.known: dict[str, bytes] = {}

    def _char(self, c: str) -> tuple[list[int], int]:
        """Ids and score of a character spelled in bytes."""
        raw = c.encode()
        if all(b in self.byte_id for b in raw):
            return [self.byte_id[b] for b in raw], self.fallback * len(raw)
        return [self.unknown], self.fallback

    def viterbi(self, text: str) -> list[int]:
        """Ids of the best path; of equal ones the one with the longer last piece."""
        n = len(text)
        best: list[int | None] = [0] + [None] * n
        back = [(0, -1)] * (n + 1)
        done = 0  # positions up to here are settled

        def spell(to: int) -> None:
            for i in range(done, to):
                if text[i] in self.single:  # its own piece scores more than its bytes
                    continue
                score = best[i] + self._char(text[i])[1]
                if best[i + 1] is None or score > best[i + 1]:
                    best[i + 1], back[i + 1] = score, (i, -1)

        for end, (length, piece, score) in self.automaton.iter(text):
            if end > done:
                spell(end)  # positions before the last character of this piece
                done = end
            total = best[end + 1 - length] + score
            if best[end + 1] is None or total > best[end + 1]:
                best[end + 1], back[end + 1] = total, (end + 1 - length, piece)
        spell(n)
        ids: list[int] = []
        while n:
            start, piece = back[n]
            ids += [piece] if piece >= 0 else self._char(text[start])[0][::-1]
            n = start
        return ids[::-1]

    def _segment(self, text: str) -> bytes:
        ids = array("i", self.viterbi(text)).tobytes()
        if len(text) <= LONGEST:
            if len(self.known) >= REMEMBERED:  # the older half goes
                self.known = dict(islice(self.known.items(), REMEMBERED // 2, None))
            self.known[text] = ids
        return ids

    def encode_raw(self, text: str | None) -> bytes:
        """Ids of a text as 32-bit integers of this machine; none for NULL and for an empty text."""
        if not text:
            return b""
        out: list[bytes] = []
        # The mark in a text is no space: it goes in as bytes between its neighbours.
        for k, part in enumerate(text.split(MARK)):
            if k:
                out.append(array("i", self._char(MARK)[0]).tobytes())
            part = (MARK if k == 0 else "") + part.replace(" ", MARK)
            for segment in self.cut.findall(part) if self.cut else [part]:
                out.append(self.known.get(segment) or self._segment(segment))
        return b"".join(out)

    def encode(self, text: str | None) -> list[int]:
        return array("i", self.encode_raw(text)).tolist()

    def decode(self, ids) -> str:
        """The text of ids; broken UTF-8, which no encoding gives, becomes U+FFFD."""
        return b"".join(map(self.text.__getitem__, ids)).decode(errors="replace")[1:]


@lru_cache(maxsize=2)
def pieces_of(path: str) -> Pieces:
    """One automaton and memory per worker process and model."""
    return Pieces(path)


def _schema(rows: DataFrame, added: dict[str, str]) -> str:
    return ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema] + [f"{n} {t}" for n, t in added.items()])


def encode(docs: DataFrame, model: str, text: str = "text") -> DataFrame:
    """`docs` with `ids`, the piece ids of every whole text, in place of a column of that name.

    NULL and empty texts have no ids.
    """
    docs = docs.drop("ids")
    at, names = docs.columns.index(text), [*docs.columns, "ids"]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(model)
        for batch in batches:
            found = [pieces.encode_raw(t) for t in batch.column(at).to_pylist()]
            ends = np.cumsum([0, *(len(x) // 4 for x in found)], dtype=np.int32)
            flat = np.frombuffer(b"".join(found), np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names)

    arrow_ready(docs.sparkSession)
    return docs.mapInArrow(of, _schema(docs, {"ids": "array<int>"}))


def decode(rows: DataFrame, model: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """`rows` with the text of their ids, in place of a column of that name; '' for no ids."""
    rows = rows.drop(text)
    at, names = rows.columns.index(ids), [*rows.columns, text]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(model)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([pieces.decode(x or []) for x in batch.column(at).to_pylist()], pa.string())], names)

    arrow_ready(rows.sparkSession)
    return rows.mapInArrow(of, _schema(rows, {text: "string"}))
