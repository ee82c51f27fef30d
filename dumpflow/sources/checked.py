"""Lines of dump files with their numbers, one broken file not stopping the others.

Each file is read by one task from start to end, decompressed in bounded
pieces, so every line knows its number and a file that is cut short or damaged
gives the lines in front of the damage and one more row that says what is wrong
and where. Splittable files that need neither are better read by `read_lines`.
"""

from __future__ import annotations

import bz2
import codecs
import gzip
import io
import zlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

OPENERS = {".gz": lambda raw: gzip.GzipFile(fileobj=raw), ".bz2": bz2.BZ2File}
DAMAGE = (OSError, EOFError, zlib.error)
PIECE, ROWS = 1 << 20, 8_192
SCHEMA = "value string, file_name string, file_path string, line_number bigint, error string, position bigint"
ARROW = pa.schema([("value", pa.string()), ("file_name", pa.string()), ("file_path", pa.string()),
                   ("line_number", pa.int64()), ("error", pa.string()), ("position", pa.int64())])


def _open(path: str) -> io.RawIOBase:
    """A stored file by the path that Spark gives it; any store that Arrow can open."""
    if path.startswith("file:"):
        fs, name = pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    elif "://" in path:
        fs, name = pafs.FileSystem.from_uri(path)
    else:
        fs, name = pafs.LocalFileSystem(), path
    return fs.open_input_file(name)


def lines_of(raw, suffix: str, piece: int = PIECE) -> Iterator[tuple[list[str], str | None, int]]:
    """(lines, None, 0) for each piece of a file, at the end (the begun line, what is wrong, bytes read) if it is broken.

    Lines end with a line feed, a carriage return or both; bytes that are not UTF-8 become U+FFFD.
    """
    decode = io.IncrementalNewlineDecoder(codecs.getincrementaldecoder("utf-8")("replace"), translate=True).decode
    begun: list[str] = []  # parts of the line that has not ended
    try:
        stream = OPENERS[suffix](raw) if suffix in OPENERS else None
        while data := stream.read1(piece) if stream else raw.read(piece):
            first, *others = decode(data).split("\n")
            begun.append(first)
            if others:
                yield ["".join(begun), *others[:-1]], None, 0
                begun = [others[-1]]
    except DAMAGE as error:
        yield ["".join(begun)], f"{type(error).__name__}: {error}", raw.tell()
        return
    first, *others = decode(b"", final=True).split("\n")
    lines = ["".join(begun) + first, *others]
    if not lines[-1]:
        lines.pop()
    if lines:
        yield lines, None, 0


def _batches(path: str) -> Iterator[pa.RecordBatch]:
    name = path.rsplit("/", 1)[-1]
    suffix, number = "." + name.rsplit(".", 1)[-1], 0
    with _open(path) as raw:
        for lines, error, position in lines_of(raw, suffix):
            for i in range(0, len(lines), ROWS):
                part = lines[i : i + ROWS]
                n = len(part)
                yield pa.RecordBatch.from_arrays([
                    pa.array(part, pa.string()), pa.array([name] * n), pa.array([path] * n),
                    pa.array(range(number + 1, number + n + 1), pa.int64()), pa.array([error] * n, pa.string()),
                    pa.array([position if error else None] * n, pa.int64())], schema=ARROW)
                number += n


def read_checked(spark: SparkSession, paths: str | Sequence[str], recursive: bool = False) -> DataFrame:
    """Lines of plain, gzip and bzip2 files: value, file_name, file_path, line_number from 1, error, position.

    A row with `error` stands for a broken file, after its good lines: `value` is
    the begun line that cannot be trusted, `position` the bytes of the file that were read until
    the damage showed. A file that cannot be listed or opened at all stops the
    job. Empty files give no row.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    # Only names and sizes are read here. Files of one task are few, as a task reads each to its end.
    files = reader.load([paths] if isinstance(paths, str) else list(paths)).where("length > 0").select("path")
    tasks = max(1, min(files.count(), 20_000))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                yield from _batches(path)

    return files.repartition(tasks).mapInArrow(read, SCHEMA)


def good_lines(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("error").isNull()).drop("error", "position")


def broken_files(rows: DataFrame) -> DataFrame:
    """A row per broken file: its good lines, the position of the damage, and what is wrong."""
    return rows.where(F.col("error").isNotNull()).select(
        "file_path", "file_name", (F.col("line_number") - 1).alias("good_lines"), "position", "error", F.col("value").alias("begun_line"))
