"""Message topics kept as a log of files: a Spark data source and sink, `topic_log`.

A log is a folder of any store that Arrow can open. Tasks write messages as
Parquet files, a file per topic and task; the driver then adds one commit, which
gives each file its place in its topic. So every message has an offset, a
stream reads from where its checkpoint stands, and files of a task that died
or ran twice are in no commit and are never read.

    <path>/data/<topic>/<name>.parquet    key, value
    <path>/commits/<number>.json          files with their first offsets, ends of all topics, last batch of each writer

One query or job at a time may write to a log. A stream names itself by the
option `writer`; a batch that it commits a second time after a restart is passed over.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamArrowWriter,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)

SCHEMA = "topic string, key string, value string, offset bigint"
ARROW = pa.schema([("topic", pa.string()), ("key", pa.string()), ("value", pa.string()), ("offset", pa.int64())])
STORED = pa.schema([("key", pa.string()), ("value", pa.string())])


class Log:
    """The commits of a log."""

    def __init__(self, path: str):
        self.path = path
        if path.startswith("file:"):
            self.fs, self.root = pafs.LocalFileSystem(), "/" + path[5:].strip("/")
        elif "://" in path:
            self.fs, self.root = pafs.FileSystem.from_uri(path)
        else:
            self.fs, self.root = pafs.LocalFileSystem(), path.rstrip("/")

    def numbers(self) -> list[int]:
        found = self.fs.get_file_info(pafs.FileSelector(f"{self.root}/commits", allow_not_found=True))
        return sorted(int(f.base_name[:-5]) for f in found if f.base_name.endswith(".json"))

    def commit(self, number: int) -> dict:
        with self.fs.open_input_file(f"{self.root}/commits/{number:012d}.json") as f:
            return json.loads(f.read())

    def newest(self) -> tuple[int, dict]:
        numbers = self.numbers()
        return (numbers[-1], self.commit(numbers[-1])) if numbers else (-1, {"files": [], "ends": {}, "writers": {}})

    def ends(self) -> dict[str, int]:
        return self.newest()[1]["ends"]

    def files(self, start: dict[str, int], end: dict[str, int]) -> Iterator[tuple[str, str, int, int]]:
        """(topic, name, first offset, messages) of files that reach into the ranges, newest commit first."""
        for number in reversed(self.numbers()):
            commit = self.commit(number)
            if all(commit["ends"].get(t, 0) <= start.get(t, 0) for t in end):
                return  # all older ones are read
            yield from ((t, name, at, n) for t, name, at, n in commit["files"] if t in end and at < end[t] and at + n > start.get(t, 0))

    def add(self, written: list[tuple[str, str, int]], writer: str | None = None, batch: int = 0) -> None:
        """Commit files (topic, name, messages), unless the writer has committed this batch."""
        number, last = self.newest()
        if writer is not None and last["writers"].get(writer, -1) >= batch:
            return
        ends, files = dict(last["ends"]), []
        for topic, name, n in sorted(written):
            files.append((topic, name, ends.get(topic, 0), n))
            ends[topic] = ends.get(topic, 0) + n
        writers = last["writers"] | ({writer: batch} if writer is not None else {})
        self.fs.create_dir(f"{self.root}/commits", recursive=True)
        with self.fs.open_output_stream(f"{self.root}/commits/{number + 1:012d}.json") as out:
            out.write(json.dumps({"files": files, "ends": ends, "writers": writers}).encode())


@dataclass
class Part(InputPartition):
    """Messages `first` to `last` (exclusive) of a topic, all in the file that begins at offset `at`."""

    topic: str
    name: str
    at: int
    first: int
    last: int


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, str, int]]


def _parts(log: Log, start: dict[str, int], end: dict[str, int]) -> list[Part]:
    return [Part(t, name, at, max(at, start.get(t, 0)), min(at + n, end[t])) for t, name, at, n in log.files(start, end)]


def _read(path: str, part: Part) -> Iterator[pa.RecordBatch]:
    log, at = Log(path), part.at
    with log.fs.open_input_file(f"{log.root}/data/{part.topic}/{part.name}") as f:
        for batch in pq.ParquetFile(f).iter_batches(8_192):
            a, b = max(part.first - at, 0), min(part.last - at, len(batch))
            if a < b:
                rows = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.topic] * len(rows)), *rows.columns, pa.array(range(at + a, at + b), pa.int64())], schema=ARROW)
            at += len(batch)


def _write(path: str, batches: Iterator[pa.RecordBatch]) -> Written:
    log, files, open_files = Log(path), {}, {}
    for batch in batches:
        table = pa.Table.from_batches([batch])
        topics = table.column("topic")
        for topic in topics.unique().to_pylist():
            rows = table.filter(pc.equal(topics, topic)).select(["key", "value"]).cast(STORED)
            if topic not in open_files:
                log.fs.create_dir(f"{log.root}/data/{topic}", recursive=True)
                files[topic] = [f"{uuid.uuid4().hex}.parquet", 0]
                out = log.fs.open_output_stream(f"{log.root}/data/{topic}/{files[topic][0]}", compression=None)
                open_files[topic] = (out, pq.ParquetWriter(out, STORED))
            open_files[topic][1].write_table(rows)
            files[topic][1] += len(rows)
    for out, writer in open_files.values():
        writer.close()
        out.close()
    return Written([(topic, name, n) for topic, (name, n) in files.items()])


class _Batch(DataSourceReader):
    def __init__(self, path: str, topics: list[str] | None):
        self.path, self.topics = path, topics

    def partitions(self) -> list[Part]:
        log = Log(self.path)
        ends = log.ends()
        return _parts(log, {}, {t: n for t, n in ends.items() if self.topics is None or t in self.topics})

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        # Spark plans one empty part where there is no file.
        return _read(self.path, partition) if isinstance(partition, Part) else iter(())


class _Stream(DataSourceStreamReader):
    """Offsets are the next message of each topic."""

    def __init__(self, path: str, topics: list[str] | None):
        self.path, self.topics = path, topics

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return {t: n for t, n in Log(self.path).ends().items() if self.topics is None or t in self.topics}

    def partitions(self, start: dict, end: dict) -> list[Part]:
        return _parts(Log(self.path), start, end)

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        return _read(self.path, partition) if isinstance(partition, Part) else iter(())

    def commit(self, end: dict) -> None:
        """Messages stay in the log."""


class _BatchWriter(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return _write(self.path, iterator)

    def commit(self, messages: list[Written | None]) -> None:
        Log(self.path).add([f for m in messages if m is not None for f in m.files])

    def abort(self, messages: list[Written | None]) -> None:
        """Files without a commit are not read."""


class _StreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, path: str, writer: str):
        self.path, self.writer = path, writer

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return _write(self.path, iterator)

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        Log(self.path).add([f for m in messages if m is not None for f in m.files], self.writer, batchId)

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        """Files without a commit are not read."""


class TopicLog(DataSource):
    """Options: `path`; `topic`, the topics to read, comma-separated (all); `writer`, the name of a stream that writes."""

    @classmethod
    def name(cls) -> str:
        return "topic_log"

    def schema(self) -> str:
        return SCHEMA

    def _given(self) -> tuple[str, list[str] | None]:
        topics = self.options.get("topic")
        return self.options["path"], None if topics is None else topics.split(",")

    def reader(self, schema) -> _Batch:
        return _Batch(*self._given())

    def streamReader(self, schema) -> _Stream:
        return _Stream(*self._given())

    def writer(self, schema, overwrite: bool) -> _BatchWriter:
        if overwrite:
            raise ValueError("messages are only added to a log")
        return _BatchWriter(self.options["path"])

    def streamWriter(self, schema, overwrite: bool) -> _StreamWriter:
        return _StreamWriter(self.options["path"], self.options["writer"])


def use_topic_log(spark: SparkSession) -> SparkSession:
    """Make `topic_log` known to a session."""
    spark.dataSource.register(TopicLog)
    return spark
