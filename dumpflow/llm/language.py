"""Language identification by error-correcting output codes.

Every language has a codeword. For each bit a binary classifier over hashed
byte n-grams tells the languages with a one from those with a zero: its weights
are the log odds of an n-gram between the two sides, each side the even mixture
of its languages. A text's language is the one whose codeword loses least,
every bit's logistic loss weighted by how reliable its classifier proved to be.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dumpflow.llm.stages import arrow_ready

BUCKET_BITS, SIZES, PAD = 15, (2, 3), 2
MULTIPLIER = {2: 0x9E3779B1, 3: 0x85EBCA6B}
#: Positions worked on at a time, so that one long text stays small in memory.
AT_ONCE = 1 << 19
#: Labelled texts on which the reliability of the bits is measured, about; no text leaves its task.
MEASURED_ON = 5_000
UNKNOWN = "und"
ALNUM = re.compile(r"[^\W\d_]+")
#: Letters are what Unicode calls so; the class above also takes superscript digits and fractions.
LETTERS = regex.compile(r"\p{L}+")


def codewords(count: int, seed: int = 1) -> np.ndarray:
    """A row of bits per language: all splits up to seven languages, else the best of random codes."""
    if count < 2:
        return np.zeros((count, 0), bool)
    if count <= 7:
        columns = np.arange(1, 1 << (count - 1))
        return (columns[None, :] >> np.arange(count)[:, None] & 1).astype(bool)
    rng, bits, best = np.random.default_rng(seed), max(31, 6 * math.ceil(math.log2(count))), None
    for _ in range(200):
        code = rng.random((count, bits)) < 0.5
        code[0], code[1] = False, code[1] | ~code[1:].any(axis=0)  # both sides of each bit have a language
        apart = min((code[i] ^ code[i + 1 :]).sum(axis=1).min() for i in range(count - 1))
        if best is None or apart > best[0]:
            best = (apart, code)
    return best[1]


def _letters(text: str | None) -> bytes:
    text = (text or "").lower()
    found = ALNUM.findall(text)
    if not all(map(str.isalpha, found)):
        found = LETTERS.findall(text)
    return b" " + " ".join(found).encode() + b" " * PAD if found else b""


def _buckets(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Slices of all n-grams: (text number, bucket). N-grams do not reach into the next text."""
    length = np.array([len(t) for t in texts], np.int64)
    raw = np.frombuffer(b"".join(texts), np.uint8)
    if not len(raw):
        return
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), length)
    starts = np.ones(len(raw), bool)
    for k in range(1, PAD + 1):
        starts[np.cumsum(length)[length > 0] - k] = False
    for at in range(0, len(raw), AT_ONCE):
        part = raw[at : at + AT_ONCE + PAD].astype(np.uint32)
        ok = np.flatnonzero(starts[at : at + AT_ONCE][: max(0, len(part) - PAD)])
        value = part[ok] << 8 | part[ok + 1]
        for size in SIZES:
            if size == 3:
                value = value << 8 | part[ok + 2]
            yield owner[at + ok], value * np.uint32(MULTIPLIER[size]) >> np.uint32(32 - BUCKET_BITS)


def ngram_counts(docs: DataFrame) -> DataFrame:
    """(lang, bucket, n) over whole texts with a language; one sum per task and pair is shuffled."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), [_letters(t) for t in batch.column(1).to_pylist()]
            for lang in set(langs):
                counts = total.setdefault(lang, np.zeros(1 << BUCKET_BITS, np.int64))
                for _, bucket in _buckets([t for t, x in zip(texts, langs, strict=True) if x == lang]):
                    counts += np.bincount(bucket, minlength=len(counts))
        for lang, counts in total.items():
            bucket = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(bucket), pa.string()), pa.array(bucket.astype(np.int32)), pa.array(counts[bucket])], ["lang", "bucket", "n"])

    arrow_ready(docs.sparkSession)
    rows = docs.where(F.col("lang").isNotNull()).select("lang", "text")
    return rows.mapInArrow(count, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    langs: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # buckets x bits
    trust: np.ndarray  # bits

    def margins(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Mean log odds of each text and bit, times the root of the n-grams; and their number."""
        sums, n = np.zeros((len(texts), self.weights.shape[1])), np.zeros(len(texts), np.int64)
        for owner, bucket in _buckets(texts):
            if len(owner):
                first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
                sums[owner[first]] += np.add.reduceat(self.weights[bucket], first, axis=0)
                n += np.bincount(owner, minlength=len(n))
        return sums / np.sqrt(np.maximum(n, 1))[:, None], n

    def losses(self, margins: np.ndarray) -> np.ndarray:
        """Weighted logistic loss of each text and language."""
        sign = np.where(self.code, 1.0, -1.0)
        return np.stack([np.logaddexp(0, -margins * s) @ self.trust for s in sign], axis=1)


def learn(docs: DataFrame, measured_on: int = MEASURED_ON) -> Model:
    """Model of the rows that have a language, from the n-grams of all of them.

    What comes to the driver is one count per language and bucket.
    """
    table = ngram_counts(docs).orderBy("lang", "bucket").toArrow()
    lang = table.column("lang").to_pylist()
    langs = sorted(set(lang))
    counts = np.zeros((len(langs), 1 << BUCKET_BITS))
    row = {x: i for i, x in enumerate(langs)}
    counts[np.array([row[x] for x in lang], int), table.column("bucket").to_numpy()] = table.column("n").to_numpy()
    share = (counts + 0.5) / (counts + 0.5).sum(axis=1, keepdims=True) if langs else counts
    code = codewords(len(langs))
    odds = [np.log(share[bit].mean(axis=0) / share[~bit].mean(axis=0)) for bit in code.T]
    weights = np.stack(odds, axis=1).astype(np.float32) if odds else np.zeros((1 << BUCKET_BITS, 0), np.float32)
    model = Model(langs, code, weights, np.ones(code.shape[1]))
    if code.shape[1]:
        model.trust = _trust(docs, model, measured_on)
    return model


def _trust(docs: DataFrame, model: Model, measured_on: int) -> np.ndarray:
    """Half the log odds that a bit is right, over about `measured_on` labelled texts, chosen by a hash of their ids."""
    row = {x: i for i, x in enumerate(model.langs)}

    def right(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [_letters(t) for t in batch.column(1).to_pylist()]
            truth = model.code[[row[x] for x in batch.column(0).to_pylist()]]
            margins, n = model.margins(texts)
            good = ((margins > 0) == truth)[n > 0].sum(axis=0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(good)), pa.int32()), pa.array(good, pa.int64()), pa.array([int((n > 0).sum())] * len(good), pa.int64())], ["bit", "good", "n"])

    labelled = docs.where(F.col("lang").isin(model.langs))
    # A threshold, not a sorted limit, which would bring that many texts of every task to one.
    share = min(1.0, measured_on / max(1, labelled.count()))
    sample = labelled.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < math.ceil(share * 1_000_000))
    found = {r["bit"]: r for r in sample.select("lang", "text").mapInArrow(right, "bit int, good bigint, n bigint").groupBy("bit").agg(F.sum("good").alias("good"), F.sum("n").alias("n")).collect()}
    rate = np.array([(found[b]["good"] + 1) / (found[b]["n"] + 2) if b in found else 0.5 for b in range(model.code.shape[1])])
    return np.maximum(np.log(rate / (1 - rate)) / 2, 0.01)


def predict(docs: DataFrame, model: Model, least_lead: float = 0.5) -> DataFrame:
    """`docs` rows with lang_pred, score, runner_up and ambiguous; only `text` is looked at.

    A NULL text, or one without a letter, is `und` with score 0, as is every text
    of a model without languages. With one language every other text is of that.
    The score is the share of the language among all, by the negative exponent
    of the loss; a text is ambiguous if the runner-up's loss is within
    `least_lead`. Ties go to the language that sorts first. Columns of these
    names are replaced, others stay.
    """
    added = {"lang_pred": "string", "score": "double", "runner_up": "string", "ambiguous": "boolean"}
    docs = docs.drop(*added)
    at, names = docs.columns.index("text"), [*docs.columns, *added]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margins, n = model.margins([_letters(t) for t in batch.column(at).to_pylist()])
            known = (n > 0) & bool(model.langs)
            langs = np.array([*model.langs, None], object)
            loss = model.losses(margins) if model.langs else np.zeros((len(n), 1))
            order = np.argsort(loss, axis=1, kind="stable")
            best = order[:, 0]
            lead = np.sort(loss, axis=1)
            second = order[:, 1] if loss.shape[1] > 1 else np.full(len(n), len(model.langs))
            close = lead[:, 1] - lead[:, 0] < least_lead if loss.shape[1] > 1 else np.zeros(len(n), bool)
            share = 1 / np.exp(lead[:, :1] - loss).sum(axis=1)
            yield pa.RecordBatch.from_arrays([
                *batch.columns,
                pa.array(np.where(known, langs[best], UNKNOWN), pa.string()), pa.array(np.where(known, share, 0.0)),
                pa.array(np.where(known, langs[second], None), pa.string()), pa.array(known & close),
            ], names)

    arrow_ready(docs.sparkSession)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema] + [f"{n} {t}" for n, t in added.items()])
    return docs.mapInArrow(of, schema)


def remainder(divisor: int) -> Column:
    """crc32 of the id as text, modulo `divisor`."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


def with_held_out(docs: DataFrame, divisor: int = 4, held: int = 2) -> DataFrame:
    """Languages learned from the documents whose remainder is not `held`, predicted for all.

    A NULL doc_id counts as not held out.
    """
    rows = docs.withColumn("held_out", F.coalesce(remainder(divisor) == held, F.lit(False)))
    model = learn(rows.where(~F.col("held_out")).select("doc_id", "lang", "text"))
    return predict(rows.select("doc_id", "text", "held_out"), model).drop("text")
