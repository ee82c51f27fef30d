"""Line reading that keeps count and tells broken files apart."""

from __future__ import annotations

import bz2
import gzip
import io
import random

import pytest

from dumpflow.sources import checked
from dumpflow.sources.lines import read_lines


def read(raw, suffix, piece=7):
    found, lines, error, at = list(checked.lines_of(io.BytesIO(raw), suffix, piece)), [], None, 0
    for part, wrong, position in found:
        if wrong is None:
            lines += part
        else:
            error, at = wrong, position
    return lines, error, at


@pytest.mark.parametrize("suffix, squeeze", [(".txt", bytes), (".gz", gzip.compress), (".bz2", bz2.compress)])
def test_lines_in_pieces(suffix, squeeze):
    rng = random.Random(4)
    for _ in range(60):
        text = "".join(rng.choice(["a", "é", "漢", "\n", "\r\n", "\r", " ", "x" * 30]) for _ in range(rng.randint(0, 60)))
        want = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
        want = want[:-1] if want[-1] == "" else want
        for piece in (1, 3, 1_000):
            assert read(squeeze(text.encode()), suffix, piece) == (want, None, 0)


def test_members_and_bad_bytes():
    assert read(gzip.compress(b"a\nb") + gzip.compress(b"c\nd\n"), ".gz")[0] == ["a", "bc", "d"]
    assert read(b"a\xff\n\xc3", ".txt")[0] == ["a�", "�"]


def test_damage_shows_after_good_lines():
    lines = [f"line {i} " + "abc"[i % 3] * (i % 50) for i in range(3_000)]
    raw = gzip.compress("\n".join(lines).encode())
    for cut in (0.2, 0.7, 0.99):
        got, error, at = read(raw[: int(len(raw) * cut)], ".gz", 500)
        assert got == lines[: len(got)] and len(got) > 3_000 * cut * 0.4
        assert error.startswith("EOFError") and 0 < at <= len(raw) * cut
    got, error, _ = read(gzip.compress(b"one\ntw") + b"garbage!", ".gz")
    assert got == ["one"] and error
    got, error, _ = read(b"no gzip at all", ".gz")
    assert got == [] and error
    got, error, _ = read(bz2.compress(b"one\n" * 9)[:-4], ".bz2")
    assert error and set(got) <= {"one"}


def test_files(spark, tmp_path):
    good = {"a.txt": b"1\n2\n\n4", "b.gz": gzip.compress(b"x\r\ny\n"), "sub/c.bz2": bz2.compress("ü\n".encode())}
    for name, raw in {**good, "bad.gz": gzip.compress(b"k\nl\n") + gzip.compress(b"m\n" * 99)[:11], "empty.gz": b""}.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(raw)
    rows = checked.read_checked(spark, str(tmp_path), recursive=True)
    got = sorted((r.file_name, r.line_number, r.value) for r in checked.good_lines(rows).collect())
    assert got == [("a.txt", 1, "1"), ("a.txt", 2, "2"), ("a.txt", 3, ""), ("a.txt", 4, "4"), ("b.gz", 1, "x"), ("b.gz", 2, "y"),
                   ("bad.gz", 1, "k"), ("bad.gz", 2, "l"), ("c.bz2", 1, "ü")]
    (bad,) = checked.broken_files(rows).collect()
    assert (bad.file_name, bad.good_lines, bad.begun_line) == ("bad.gz", 2, "") and "EOFError" in bad.error and bad.position > 0
    # The lines of whole files are those that Spark's own reader gives.
    for name in good:
        path = str(tmp_path / name)
        assert sorted(r.value for r in checked.read_checked(spark, path).collect()) == sorted(r.value for r in read_lines(spark, path).collect())


def test_numbers_need_no_window(spark, tmp_path):
    (tmp_path / "a.gz").write_bytes(gzip.compress(b"\n".join(str(i).encode() for i in range(1, 20_001))))
    rows = checked.good_lines(checked.read_checked(spark, str(tmp_path)))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Sort" not in plan.replace("sort", "") .replace("RoundRobin", "")
    assert rows.where("cast(line_number AS string) <> value").count() == 0 and rows.count() == 20_000


def test_a_file_that_is_gone_stops_the_job(spark, tmp_path):
    (tmp_path / "a.gz").write_bytes(gzip.compress(b"x\n"))
    rows = checked.read_checked(spark, str(tmp_path))
    (tmp_path / "a.gz").unlink()
    with pytest.raises(Exception, match="No such file|does not exist|FileNotFound"):
        rows.collect()
