"""Blocks of rows, and questions that blocks put to shards.

A block is some megabytes of rows packed into one value and kept in a file of
its own in the shared folder. A step that must compare all blocks sends each
shard of a key space one packed question per block; the shard sees the
questions of all blocks and answers each. Rows cross the network packed and
reduced by block, so a key that fills a third of all rows is one entry per
block, and the texts themselves never move.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dumpflow.llm.stages import arrow_ready, written
from dumpflow.session import fresh_folder

BLOCK = "block string, n_bytes bigint, payload binary"
QUESTION = "shard bigint, block string, payload binary"
ESCAPE = 65_535


def pack(value) -> bytes:
    return zstandard.compress(pickle.dumps(value, protocol=5), 1)


def unpack(raw: bytes):
    return pickle.loads(zstandard.decompress(raw))


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "double": pa.float64(), "boolean": pa.bool_()}
    return pa.schema([(n, kinds[t]) for n, t in (c.split() for c in ddl.split(", "))])


def write_blocks(rows: DataFrame, purpose: str) -> DataFrame:
    """Store rows of BLOCK, each in a file of its own; gives block, n_bytes and the file's path."""
    folder = fresh_folder(rows.sparkSession, purpose)
    rows.write.option("maxRecordsPerFile", 1).parquet(folder, compression="uncompressed")
    stored = rows.sparkSession.read.schema(rows.schema).parquet(folder)
    return stored.select("block", "n_bytes", F.col("_metadata.file_path").alias("path"))


def read_block(path: str):
    fs, name = pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)
    with fs.open_input_file(name) as f:
        return unpack(pq.read_table(f, columns=["payload"]).column(0)[0].as_py())


def over_blocks(blocks: DataFrame, of: Callable[[str, object, list[dict]], Iterator[pa.RecordBatch]], schema: str,
                *answers: DataFrame) -> DataFrame:
    """`of(block, content, answers)` over every block; answers: for each frame the payloads by shard."""
    arrow_ready(blocks.sparkSession, 1)
    rows, frames = blocks.select("block", "path"), len(answers)
    for k, frame in enumerate(answers):
        by_block = frame.groupBy("block").agg(F.collect_list(F.struct("shard", "payload")).alias(f"answers{k}"))
        rows = rows.join(by_block, "block", "left")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = [{a["shard"]: a["payload"] for a in row[f"answers{k}"] or []} for k in range(frames)]
                yield from of(row["block"], read_block(row["path"]), found)

    tasks = max(1, min(blocks.count(), 50_000))
    return rows.repartition(tasks).mapInArrow(each, schema)


def answered(questions: DataFrame, answer: Callable[[list[bytes]], list[bytes]]) -> DataFrame:
    """The answers to rows of QUESTION, as rows of the same kind; `answer` sees all of a shard."""
    schema = arrow_schema(QUESTION)

    def of(table: pa.Table) -> pa.Table:
        given = table.column("payload").to_pylist()
        return pa.table([table.column("shard"), table.column("block"), pa.array(answer(given), pa.binary())], schema=schema)

    arrow_ready(questions.sparkSession, 1)
    return questions.groupBy("shard").applyInArrow(of, QUESTION)


def spans(keys: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(key, start, stop) of each stretch of equal numbers."""
    if len(keys):
        edges = np.r_[0, np.flatnonzero(np.diff(keys)) + 1, len(keys)]
        for a, b in zip(edges.tolist(), edges[1:].tolist(), strict=False):
            yield int(keys[a]), a, b


def gaps_of(values: np.ndarray) -> np.ndarray:
    """Ascending numbers as 16-bit steps; a step of ESCAPE goes on without a number."""
    steps = np.diff(values, prepend=values.dtype.type(0)).astype(np.int64)
    many, rest = np.divmod(steps, ESCAPE)
    if not many.any():
        return rest.astype(np.uint16)
    out = np.full(len(steps) + int(many.sum()), ESCAPE, np.uint16)
    out[np.cumsum(many + 1) - 1] = rest
    return out


def from_gaps(steps: np.ndarray) -> np.ndarray:
    return np.cumsum(steps, dtype=np.int64)[steps != ESCAPE]


def kept(rows: DataFrame, purpose: str) -> DataFrame:
    """Rows of QUESTION stored once; their payloads are packed already or do not pack."""
    return written(rows, purpose, "uncompressed")
