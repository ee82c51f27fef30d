"""The page fold that a stream keeps current."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from dumpflow.operators import pages
from dumpflow.streaming import kept
from tests.test_operators import FOLD_COLUMNS, random_facts, rows


def folders(path, part):
    """(version, bucket) folders with the files in each."""
    return {(v, b): sorted(os.listdir(f"{path}/{part}/{v}/{b}")) for v in os.listdir(f"{path}/{part}") if v.startswith("version=")
            for b in os.listdir(f"{path}/{part}/{v}") if b.startswith("bucket=")}


def fold(frame):
    return rows(pages.page_fold(frame), *FOLD_COLUMNS)


def test_only_touched_buckets_are_written(spark, tmp_path):
    path = str(tmp_path / "t")
    kept.create_kept(spark, path, buckets=32)
    assert kept.read_kept(spark, path).count() == 0
    a = random_facts(spark, 21)
    first = kept.merge_batch(a, path, "a")
    before = folders(path, "elements"), folders(path, "pages")
    assert rows(kept.read_kept(spark, path), *FOLD_COLUMNS) == fold(a)
    page = a.select(*pages.PAGE_KEY).orderBy(*pages.PAGE_KEY).first()
    b = random_facts(spark, 22).where((F.col("wiki_code") == page.wiki_code) & (F.col("page_hash") == page.page_hash))
    b = b.unionByName(a.where(F.col("page_hash") == page.page_hash).limit(3))
    touched = kept.merge_batch(b, path, "b")
    assert len(touched) <= b.select(*pages.PAGE_KEY).distinct().count() < len(first)
    for part, old in zip(("elements", "pages"), before, strict=True):
        now = folders(path, part)
        assert {k: v for k, v in now.items() if k[0] == "version=a"} == old  # no file of the first batch has changed
        assert {k for k in now if k not in old} == {("version=b", f"bucket={n}") for n in touched}
    both = a.unionByName(b)
    assert rows(kept.read_kept(spark, path), *FOLD_COLUMNS) == fold(both)
    assert rows(kept.read_elements(spark, path)) == rows(pages.page_elements(both).select(*kept.read_elements(spark, path).columns))
    # One page is looked up in one bucket.
    wanted = spark.createDataFrame([tuple(page), ("enwiki", "no such page")], "wiki_code string, page_hash string")
    one = kept.read_kept(spark, path, wanted)
    assert rows(one, *FOLD_COLUMNS) == [r for r in fold(both) if r[0] == page.page_hash]
    assert {f.rsplit("/", 2)[-2] for f in one.inputFiles()} <= {f"bucket={n}" for n in range(32)} and len({f.rsplit("/", 2)[-2] for f in one.inputFiles()}) <= 2


def test_batches_count_once_and_old_versions_go(spark, tmp_path):
    path = str(tmp_path / "t")
    kept.create_kept(spark, path, buckets=4)
    a, b = random_facts(spark, 23), random_facts(spark, 24)
    kept.merge_batch(a, path, "a")
    assert kept.merge_batch(b, path, "b")
    number, versions = kept.current_versions(spark, path)
    assert kept.merge_batch(b, path, "b") == [] and kept.current_versions(spark, path) == (number, versions)
    assert kept.merge_batch(a.limit(0), path, "none") == []
    want = fold(a.unionByName(b))
    assert kept.drop_old_versions(spark, path) > 0
    assert {k[0] for k in folders(path, "elements")} == {f"version={v}" for v in versions.values()}
    assert rows(kept.read_kept(spark, path), *FOLD_COLUMNS) == want
    kept.merge_batch(a, path, "again")
    assert rows(kept.read_kept(spark, path), *FOLD_COLUMNS) == want


def test_a_batch_that_died_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    kept.create_kept(spark, path, buckets=4)
    a, b = random_facts(spark, 25), random_facts(spark, 26)
    kept.merge_batch(a, path, "a")

    def die(*_):
        raise RuntimeError("the driver is gone")

    with monkeypatch.context() as patch:
        patch.setattr(kept, "_commit", die)
        with pytest.raises(RuntimeError):
            kept.merge_batch(b, path, "b")
    assert rows(kept.read_kept(spark, path), *FOLD_COLUMNS) == fold(a)
    kept.merge_batch(b, path, "b")
    assert rows(kept.read_kept(spark, path), *FOLD_COLUMNS) == fold(a.unionByName(b))


def test_stream_goes_on_from_its_checkpoint(spark, tmp_path):
    path, source = str(tmp_path / "t"), str(tmp_path / "in")
    kept.create_kept(spark, path, buckets=8)
    parts = [random_facts(spark, 27), random_facts(spark, 28)]
    lost = parts[0].limit(2).withColumn("page_hash", F.lit(None).cast("string"))
    bad = []
    for part in (parts[0].unionByName(lost), parts[1]):
        part.write.mode("append").parquet(source)
        stream = spark.readStream.schema(part.schema).parquet(source)
        kept.keep_stream(stream, path, str(tmp_path / "c"), on_bad=lambda rows, _: bad.append(rows.count())).awaitTermination()
    assert kept.current_versions(spark, path)[0] == 2 and bad == [2, 0]
    assert rows(kept.read_kept(spark, path), *FOLD_COLUMNS) == fold(parts[0].unionByName(parts[1]))


def test_a_batch_without_a_handler_is_read_once_and_not_kept(spark, tmp_path, monkeypatch):
    path, source, facts = str(tmp_path / "t"), str(tmp_path / "in"), random_facts(spark, 29)
    kept.create_kept(spark, path, buckets=8)
    facts.write.parquet(source)

    def persist(*_):
        raise AssertionError("kept in memory")

    monkeypatch.setattr(type(facts), "persist", persist)
    kept.keep_stream(spark.readStream.schema(facts.schema).parquet(source), path, str(tmp_path / "c")).awaitTermination()
    assert rows(kept.read_kept(spark, path), *FOLD_COLUMNS) == fold(facts)
