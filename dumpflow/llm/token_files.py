"""Token ids in flat binary files that training reads memory-mapped.

A part has two files: `<part>.bin`, the ids of its documents as little-endian
unsigned integers without a header, 16 bits each where the vocabulary allows
it and else 32, and `<part>.idx`, 64-bit offsets in ids, one more than there
are documents. Documents lie in ascending order of doc_id, part after part; a
part's base is the prefix sum of the ids in the parts before it.

A task writes its files under a name of its own and reports it; the manifest
that is made of the reports names the files that count, so a task that ran
twice leaves stray files but no wrong ones.
"""

from __future__ import annotations

import os
import uuid
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dumpflow.llm.stages import arrow_ready

#: Words that a worker process remembers the ids of, from task to task, and the longest of them in bytes.
REMEMBERED, LONGEST = 700_000, 64
#: Words or texts in one call of the tokenizer.
AT_ONCE = 4_096
MANIFEST = "part int, name string, n_docs bigint, n_tokens bigint, doc_ids array<bigint>"


class WordEncoder:
    """Ids of whole texts, word by word.

    Exact for tokenizers that drop white space and never let a token cross it,
    such as BPE with word ends; `by_word=False` hands whole texts over. The
    library encodes each new word, repeats come from a bounded memory.
    """

    def __init__(self, path: str, by_word: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.by_word, self.known = by_word, {}
        small = self.tokenizer.get_vocab_size() <= 1 << 16
        self.dtype, self.code = np.dtype("<u2" if small else "<u4"), "H" if small else "I"

    def _call(self, texts: list[str]) -> list[bytes]:
        out = []
        for i in range(0, len(texts), AT_ONCE):
            out += (array(self.code, e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts[i : i + AT_ONCE], add_special_tokens=False))
        return out

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each UTF-8 text as bytes."""
        if not self.by_word:
            return self._call([t.decode() for t in texts])
        split = [t.split() for t in texts]
        if len(self.known) > REMEMBERED:  # the older half goes
            self.known = dict(islice(self.known.items(), len(self.known) // 2, None))
        new = list(set().union(*split).difference(self.known))
        found = dict(zip(new, self._call([w.decode() for w in new]), strict=True))
        short = {w: ids for w, ids in found.items() if len(w) <= LONGEST}
        self.known |= short
        ids = self.known if len(short) == len(found) else self.known | found
        return [b"".join(map(ids.__getitem__, words)) for words in split]


@lru_cache(maxsize=2)
def encoder_of(tokenizer: str, by_word: bool) -> WordEncoder:
    """One encoder per worker process and tokenizer, so that tasks share its memory."""
    return WordEncoder(tokenizer, by_word)


def _local(folder: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder; any scheme that Arrow can open works."""
    if "://" in folder or folder.startswith("file:"):
        return pafs.FileSystem.from_uri(folder)
    return pafs.LocalFileSystem(), folder


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int, parts: int, by_word: bool = True) -> DataFrame:
    """Encode every whole text, write the files, and return the manifest with bases.

    NULL and empty texts are just the end id. Rows are ordered by doc_id, those
    without one first, rows that share one by a hash of the text. Every part has a row, also
    one without documents. The manifest is stored as `<folder>/manifest`.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _local(folder)
        fs.create_dir(root, recursive=True)
        encode = encoder_of(tokenizer, by_word)
        end = np.array([end_id], encode.dtype).tobytes()
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}"
        ids_at, doc_ids = [0], []
        with fs.open_output_stream(f"{root}/{name}.bin") as out:
            for batch in batches:
                for ids in encode(batch.column(1).to_pylist()):
                    out.write(ids)
                    out.write(end)
                    ids_at.append(ids_at[-1] + len(ids) // encode.dtype.itemsize + 1)
                doc_ids += batch.column(0).to_pylist()
        with fs.open_output_stream(f"{root}/{name}.idx") as out:
            out.write(np.array(ids_at, "<i8").tobytes())
        yield pa.RecordBatch.from_arrays([
            pa.array([part], pa.int32()), pa.array([name]), pa.array([len(doc_ids)], pa.int64()),
            pa.array([ids_at[-1]], pa.int64()), pa.array([doc_ids], pa.list_(pa.int64())),
        ], ["part", "name", "n_docs", "n_tokens", "doc_ids"])

    arrow_ready(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    # The hash also cuts a run of rows with one id; range bounds are sampled, so the text itself is no key.
    order = ["doc_id", F.xxhash64("text")]
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    spark = docs.sparkSession
    dealt.mapInArrow(write, MANIFEST).write.parquet(f"{folder}/reports")
    reports = spark.read.schema(MANIFEST).parquet(f"{folder}/reports")
    # A row per part, so this window orders as many rows as there were tasks.
    bases = reports.select("part", "name", "n_tokens").withColumn("base", F.sum("n_tokens").over(Window.orderBy("part")) - F.col("n_tokens")).select(F.col("name").alias("of"), "base")
    reports.join(F.broadcast(bases) if parts <= 100_000 else bases, F.col("name") == F.col("of")).drop("of").write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def open_part(folder: str, name: str, dtype: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids and offsets of a part, memory-mapped where the folder is local."""
    fs, root = _local(folder)
    def opened(path: str, kind: str) -> np.ndarray:
        if fs.get_file_info(path).size == 0:
            return np.empty(0, kind)
        if isinstance(fs, pafs.LocalFileSystem):
            return np.memmap(path, kind, mode="r")
        with fs.open_input_file(path) as f:
            return np.frombuffer(f.read(), kind)
    return opened(f"{root}/{name}.bin", dtype), opened(f"{root}/{name}.idx", "<i8")


def dtype_of(tokenizer: str) -> str:
    return WordEncoder(tokenizer).dtype.str


def read_tokens(manifest: DataFrame, folder: str, dtype: str, at_once: int = 2_000) -> DataFrame:
    """A row per document from the files: doc_id, part, place, start and the ids as bytes.

    The ids come as little-endian unsigned 32-bit integers whatever the files hold.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, at = open_part(folder, row["name"], dtype)
                doc_ids = row["doc_ids"]
                for i in range(0, len(doc_ids), at_once):
                    to = min(i + at_once, len(doc_ids))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(doc_ids[i:to], pa.int64()), pa.array([row["part"]] * (to - i), pa.int32()),
                        pa.array(range(i, to), pa.int64()), pa.array(row["base"] + np.asarray(at[i:to]), pa.int64()),
                        pa.array([ids[a:b].astype("<u4").tobytes() for a, b in zip(at[i:to], at[i + 1 : to + 1], strict=True)], pa.binary()),
                    ], ["doc_id", "part", "place", "start", "ids"])

    arrow_ready(manifest.sparkSession, 1)
    return manifest.repartition(max(1, manifest.sparkSession.sparkContext.defaultParallelism), "name").mapInArrow(
        read, "doc_id bigint, part int, place bigint, start bigint, ids binary")


def digests(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the CRC-32 of the ids of each document read back."""
    return tokens.select("doc_id", "start", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def part_count(docs: DataFrame, bytes_per_part: int = 64 << 20) -> int:
    """Parts so that each holds about `bytes_per_part` of text, as many as the shuffle has at least."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // bytes_per_part))


def as_written(docs: DataFrame, folder: str, tokenizer: str, end_id: int) -> DataFrame:
    """Write all documents and return what reading the files back gives."""
    manifest = write_tokens(docs, folder, tokenizer, end_id, part_count(docs))
    return digests(read_tokens(manifest, folder, dtype_of(tokenizer)))


