"""Whole jobs over folders of dump files."""

from __future__ import annotations

import bz2
import gzip

import pytest
from pyspark.sql import functions as F

from dumpflow.operators import pages
from dumpflow.plans import jobs
from dumpflow.sinks.tables import read_facts
from dumpflow.sources.topics import open_messages
from dumpflow.operators.records import route_schema
from tests.test_sources import EXPORT, PAGE_SQL, PAGELINKS_SQL, PAGEVIEWS, rows


@pytest.fixture()
def dumps(tmp_path):
    files = {
        "pageviews/2024/pageviews-20240101-user.bz2": bz2.compress(PAGEVIEWS),
        "pageviews/2024/pageviews-20240201-user.bz2": bz2.compress(PAGEVIEWS),
        "clickstream/clickstream-enwiki-2024-03.tsv.gz": gzip.compress(b"a\tMain_Page\tlink\t5\nbad\n"),
        "clickstream/clickstream-dewiki-2024-03.tsv.gz": gzip.compress(b"a\tMain_Page\tlink\t5\nbad\n"),
        "pagelinks/enwiki-20250101-pagelinks.sql.gz": gzip.compress(PAGELINKS_SQL.encode()),
        "revisions/enwiki-20240101-stub-meta-history.xml.gz": gzip.compress(EXPORT.encode()),
        "notes.txt": b"not a dump",
    }
    for name, content in files.items():
        (tmp_path / "in" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / name).write_bytes(content)
    return str(tmp_path / "in"), str(tmp_path / "out")


def test_process_all_types(spark, dumps):
    source, out = dumps
    for data_type in ("pageviews", "clickstream", "pagelinks", "revisions"):
        jobs.process(spark, source, out, data_type, "1")
    facts = read_facts(spark, f"{out}/facts")
    kinds = {r.kind: r["count"] for r in facts.groupBy("kind").count().collect()}
    assert kinds == {"pageviews": 10,  # two lines have no title
                      "historical_titles": 6, "clickstreams_in": 2,
                     "pagelinks_outbound": 5, "pagelinks_inbound": 5, "revisions": 4}
    folded = pages.page_fold(facts).agg(*[F.sum(f"n_{k}").alias(k) for k in kinds]).first().asDict()
    assert folded == {**kinds, "historical_titles": 3}  # the same titles in both months
    before = rows(facts, *facts.columns)
    jobs.process(spark, source, out, "pagelinks", "1")  # run again
    assert rows(read_facts(spark, f"{out}/facts"), *facts.columns) == before


def test_process_selects_files_and_keeps_a_quarantine(spark, dumps):
    source, out = dumps
    written = jobs.process(spark, source, out, "clickstream", "a", wiki_codes=["dewiki"])
    assert rows(written, "file_name", "reason") == [
        ("clickstream-dewiki-2024-03.tsv.gz", "invalid_format"), ("clickstream-dewiki-2024-03.tsv.gz", "kept")
    ]
    written = jobs.process(spark, source, out, "pageviews", "a", years=[2024], months=[2])
    assert {r.file_name for r in written.collect()} == {"pageviews-20240201-user.bz2"}
    assert written.where("reason = 'kept'").count() == 6 and written.count() == 12
    with pytest.raises(ValueError):
        jobs.process(spark, source, out, "images", "a")


def test_stored_pages_have_one_key(spark, dumps, tmp_path):
    """A page's links and revisions come under the hash of its title; unknown pages stay."""
    source, out = dumps
    (tmp_path / "in" / "enwiki-20250501-page.sql").write_text(PAGE_SQL)
    for data_type in ("page", "pageviews", "clickstream", "pagelinks", "revisions"):
        jobs.process(spark, source, out, data_type, "1")
    pages_ = jobs.stored_pages(spark, out)
    assert pages_.count() == read_facts(spark, f"{out}/facts").count()
    titles = pages_.where("kind = 'historical_titles' AND is_known").select("page_hash").distinct()
    assert titles.count() > 0 and titles.where("length(page_hash) = 22").count() == titles.count()
    assert pages_.where("NOT is_known AND kind = 'pageviews'").count() == 0
    views = read_facts(spark, f"{out}/facts").where("kind = 'pageviews'").select("wiki_code").distinct().collect()
    assert all("." not in r.wiki_code for r in views)
    assert {r.file_name for r in jobs.unknown_files(spark, source).collect()} == {"notes.txt"}


def test_codes_with_underscores_are_dumps_too(spark):
    names = spark.createDataFrame([("zh_yuewiki-20250101-pagelinks.sql.gz",), ("clickstream-be_x_oldwiki-2024-03.tsv.gz",)], "file_name string")
    assert names.where(jobs.selected("pagelinks", wiki_codes=["zh_yuewiki"])).count() == 1
    assert names.where(jobs.selected("clickstream", wiki_codes=["be_x_oldwiki"])).count() == 1


def test_whole_page_dump_is_replayed(spark, tmp_path):
    (tmp_path / "enwiki-20250501-page.sql").write_text(PAGE_SQL)
    jobs.replay_page_sample(spark, str(tmp_path / "enwiki-20250501-page.sql"), str(tmp_path / "topics"), F.lit("2025-06-01 00:00:00").cast("timestamp"))
    pages_ = jobs.parse_dump(jobs.read_statements(spark, str(tmp_path / "enwiki-20250501-page.sql")), jobs.PAGE)
    assert spark.read.parquet(str(tmp_path / "topics")).count() == pages_.count() > 3


def test_other_files_are_not_opened(spark, dumps):
    source, _ = dumps
    lines = jobs.read_lines(spark, source, recursive=True).where(jobs.selected("pageviews", months=[2]))
    assert lines.select("file_name").distinct().count() == 1
    assert lines.rdd.getNumPartitions() == 1


def test_page_sample_is_replayed(spark, tmp_path):
    (tmp_path / "enwiki-20250501-page.sql").write_text(PAGE_SQL)
    jobs.replay_page_sample(spark, str(tmp_path / "enwiki-20250501-page.sql"), str(tmp_path / "topics"),
                            F.lit("2025-06-01 00:00:00").cast("timestamp"), limit=3)
    sent = spark.read.parquet(str(tmp_path / "topics"))
    assert sent.count() == 3
    routed = route_schema(open_messages(sent))
    assert {(r.topic, r.schema_name) for r in routed.collect()} == {("pageinfo_topic", "PageInfo")}
    assert sent.where("key RLIKE '^.{22}[|]2025-05$' AND value LIKE '%2025-06-01T00:00:00%'").count() == 3
