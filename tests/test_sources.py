"""Real dump files, plain and compressed, through the readers and parsers."""

from __future__ import annotations

import bz2
import gzip
import json

import pytest
from pyspark.sql import functions as F

from dumpflow.operators.quality import count_reasons
from dumpflow.sources import clickstream, formats, lines, manifest, pageviews, revisions, sqldump
from dumpflow.sources.schemas import SCHEMAS, schema_of

PAGEVIEWS = (
    b"en.wikipedia desktop 3\n"
    b"en.wikipedia Main_Page desktop 4\n"
    b"en.wikipedia Main_Page 15580374 mobile-web 5\n"
    b"en.wikipedia Main_Page 15580374 mobile-app 12 A3B9\n"
    b"en.wikipedia Main_Page\n"
    b"a b c d e f g\n"
    b"en.wikipedia Zero 1 desktop 0\n"
    b"en.wikipedia Bad 1 desktop many\n"
    b"en.wikipedia Special:Search 1 desktop 9\n"
    b"en.wikipedia Star_Trek:_Picard 1 kiosk 9\n"
    b"   \n"
    b"en.wikipedia Caf\xff 1 desktop 2\n"
)


def rows(frame, *columns):
    return sorted(tuple(r) for r in frame.select(*columns).collect())


@pytest.fixture()
def pageview_files(tmp_path):
    (tmp_path / "pageviews-20240101-user.bz2").write_bytes(bz2.compress(PAGEVIEWS))
    (tmp_path / "pageviews-20240202-010000.gz").write_bytes(gzip.compress(PAGEVIEWS))
    (tmp_path / "pageviews-20240303-spider").write_bytes(PAGEVIEWS)
    return tmp_path


def test_pageview_files(spark, pageview_files):
    read = lines.read_lines(spark, str(pageview_files))
    assert read.count() == 3 * 12
    classified = pageviews.classify_pageviews(read)
    assert rows(count_reasons(classified), "reason", "n") == [
        ("empty_lines", 3), ("excluded_prefix", 3), ("invalid_format", 6), ("kept", 18), ("zero_pageviews", 6)
    ]
    records = pageviews.pageview_records(pageviews.parse_pageviews(read))
    # The date comes from each row's own file, NULL where the name has none.
    per_file = records.groupBy(F.coalesce("year_month", F.lit("-")).alias("month"), "tuple_struct.user_type").count()
    assert rows(per_file, "month", "user_type", "count") == [("-", 1, 6), ("2024-01", 0, 6), ("2024-02", -1, 6)]
    broken = records.where(F.col("title").startswith("Caf")).select("title").distinct().collect()
    assert [r.title for r in broken] == ["Caf\ufffd"]
    codes = rows(records.where("title = 'Star_Trek:_Picard'").select("tuple_struct.access_type").distinct(), "access_type")
    assert codes == [(-1,)]


def test_gzip_lines_can_be_dealt_out(spark, pageview_files):
    read = lines.read_lines(spark, str(pageview_files / "pageviews-20240202-010000.gz"), spread=5)
    assert read.rdd.getNumPartitions() == 5 and read.count() == 12


def test_corrupt_file_is_isolated(spark, tmp_path):
    (tmp_path / "pageviews-20240101.gz").write_bytes(gzip.compress(PAGEVIEWS))
    (tmp_path / "pageviews-20240102.gz").write_bytes(b"\x1f\x8b\x08garbage that is not gzip")
    assert lines.read_lines(spark, str(tmp_path), skip_corrupt=True).count() == 12


def test_user_prefixes_replace_the_default(spark, lines_of):
    frame = lines_of(["en.wikipedia Special:X desktop 1", "en.wikipedia Foo:X desktop 1"])
    kept = pageviews.parse_pageviews(frame, excluded_prefixes=["Foo"])
    assert rows(kept, "title") == [("Special:X",)]


def test_wiki_filters(spark, lines_of):
    views = lines_of(["en.wikipedia A desktop 1", "de.wikipedia A desktop 1"])
    assert pageviews.parse_pageviews(views, wiki_filter=[]).count() == 2
    assert rows(pageviews.parse_pageviews(views, wiki_filter=["de.wikipedia"]), "domain") == [("de.wikipedia",)]
    clicks = lines_of(["a\tb\tlink\t1"], "clickstream-enwiki-2024-03.tsv.gz")
    assert clickstream.parse_clickstream(clicks).count() == 1
    assert clickstream.parse_clickstream(clicks, wiki_filter=[]).count() == 0
    assert clickstream.parse_clickstream(clicks, wiki_filter=["enwiki"]).count() == 1
    assert clickstream.parse_clickstream(clicks, wiki_code="frwiki", wiki_filter=["enwiki"]).count() == 0


def test_clickstream_file(spark, tmp_path):
    text = (
        'https://www.google.com/\tMain_Page\texternal\t40\n'
        'other-google\tMain_Page\texternal\t2\textra\n'
        'Foo_"bar"\tMain_Page\tlink\tmany\n'
        'Foo\tMain_Page\tweird\t3\n'
        'Foo\tMain_Page\tlink\n'
        '\tMain_Page\tother\t5\n'
        '\n'
    )
    (tmp_path / "clickstream-enwiki-2024-03.tsv.gz").write_bytes(gzip.compress(text.encode()))
    read = lines.read_lines(spark, str(tmp_path))
    classified = clickstream.classify_clickstream(read)
    assert rows(count_reasons(classified), "reason", "n") == [("empty_lines", 1), ("invalid_format", 2), ("kept", 4)]
    kept = clickstream.parse_clickstream(read)
    assert rows(kept, "source", "type", "category", "clicks") == [
        ("Foo", "other", "other-empty", 3), ('Foo_"bar"', "link", "article", 0),
        ("https://www.google.com/", "external", "other-google", 40), ("other-google", "external", "other-google", 2),
    ]
    record = clickstream.clickstream_records(kept).first()
    assert (record.wiki_code, record.year_month, str(record.tuple_struct.date)) == ("enwiki", "2024-03", "2024-03-01")


def test_routing_by_file_name(spark, lines_of):
    mixed = lines_of(["x"], "pageviews-20240101.bz2").unionByName(lines_of(["y"], "clickstream-enwiki-2024-01.tsv"))
    views, clicks = formats.route_lines(mixed)
    assert rows(views, "value") == [("x",)] and rows(clicks, "value") == [("y",)]


PAGELINKS_SQL = """-- MySQL dump
/*!40101 SET NAMES utf8 */;

DROP TABLE IF EXISTS `pagelinks`;
INSERT INTO `pagelinks` VALUES (1,0,20),(2,0,30);
insert into pagelinks VALUES (3,0,40),
-- a comment inside
 ( 4 , 1 , 50 );
INSERT INTO `templatelinks` VALUES (9,9,9);
INSERT INTO `pagelinks` (`pl_from`,`pl_from_namespace`,`pl_target_id`) VALUES (5,0,60),(x,0,1),(6,0);
"""


def test_pagelinks_file(spark, tmp_path):
    (tmp_path / "enwiki-20250101-pagelinks.sql.gz").write_bytes(gzip.compress(PAGELINKS_SQL.encode()))
    statements = sqldump.read_statements(spark, str(tmp_path))
    links = sqldump.parse_dump(statements, sqldump.PAGELINKS)
    assert rows(links, "pl_from", "pl_from_namespace", "pl_target_id") == [
        (1, 0, 20), (2, 0, 30), (3, 0, 40), (4, 1, 50), (5, 0, 60)
    ]
    assert rows(links.select("wiki_code", "year_month").distinct(), "wiki_code", "year_month") == [("enwiki", "2025-01")]
    bad = sqldump.classify_dump(statements, sqldump.PAGELINKS).where("reason IS NOT NULL")
    assert rows(bad, "tuple_text", "reason") == [("6,0", "invalid_tuple"), ("x,0,1", "invalid_tuple")]


PAGE_SQL = (
    "INSERT INTO `page` VALUES "
    r"(1,0,'Foo_(bar)',0,0,0.5,'20250101000000',NULL,5,6,'wikitext',NULL),"
    r"(2,0,'It\'s_a,b;c)',1,0,.25,'20250101000001','20250102000000',7,8,NULL,'en'),"
    r"(3,4,'Back\\slash_\"q\"',0,1,0.5,'20250101000002',NULL,9,10,'wikitext',NULL),"
    r"(4,0,'Doubled''quote',0,1,0.5,'20250101000002',NULL,9,10,'wikitext',NULL),"
    r"(5,0,'NULL',0,1,0.5,'20250101000002',NULL,9,10,'wikitext',NULL),"
    r"(6,0,NULL,0,1,0.5,'20250101000002',NULL,9,10,'wikitext',NULL);"
    "\n"
)


def test_page_file(spark, tmp_path):
    (tmp_path / "enwiki-20250501-page.sql").write_text(PAGE_SQL)
    pages = sqldump.parse_dump(sqldump.read_statements(spark, str(tmp_path)), sqldump.PAGE)
    assert rows(pages, "page_id", "page_title", "page_is_redirect") == [
        (1, "Foo_(bar)", 0), (2, "It's_a,b;c)", 1), (3, 'Back\\slash_"q"', 0), (4, "Doubled'quote", 0), (5, "NULL", 0)
    ]
    second = pages.where("page_id = 2").first()
    assert second.page_content_model is None and second.page_lang == "en" and second.page_random == 0.25
    assert str(second.page_links_updated) == "2025-01-02 00:00:00" and len(second.page_hash) == 22
    info = sqldump.page_info_records(pages)
    assert [f.name for f in info.schema["tuple_struct"].dataType] == [
        f.name for f in schema_of("PageInfo")["tuple_struct"].dataType
    ]


def test_long_statement_does_not_overflow(spark, lines_of):
    title = "x(')".replace("'", "\\'") * 20000
    values = ",".join(f"({i},0,'{title if i == 1 else 'T'}',0,0,0.5,'20250101000000',NULL,5,6,NULL,NULL)" for i in range(1, 3000))
    pages = sqldump.parse_dump(lines_of([f"INSERT INTO `page` VALUES {values}"]), sqldump.PAGE)
    assert pages.count() == 2999
    assert pages.where("page_id = 1").select(F.length("page_title")).first()[0] == 80000


def test_custom_dump_table(spark, lines_of):
    table = sqldump.DumpTable("redirect", (("rd_from", "bigint"), ("rd_title", "string")),
                              post=lambda df: df.withColumn("twice", F.col("rd_from") * 2))
    parsed = sqldump.parse_dump(lines_of(["INSERT INTO `redirect` VALUES (4,'A'),(5,'B')"]), table)
    assert rows(parsed, "rd_title", "twice") == [("A", 8), ("B", 10)]


EXPORT = """<mediawiki xmlns="http://www.mediawiki.org/xml/export-0.11/" version="0.11">
<page><title>A &amp; B</title><ns>0</ns><id>10</id>
 <revision><id>1</id><timestamp>2024-01-01T00:00:00Z</timestamp><contributor><username>u</username><id>7</id></contributor></revision>
 <revision><id>2</id><timestamp>2024-01-02T00:00:00Z</timestamp><minor /><contributor><ip>1.2.3.4</ip></contributor></revision>
 <revision><id>3</id><timestamp>2024-01-03T01:00:00+01:00</timestamp><contributor><ip>1.2.3.4</ip></contributor></revision>
 <revision><id>4</id><contributor deleted="deleted" /></revision>
 <revision><id>5</id><timestamp>never</timestamp><contributor deleted="deleted" /></revision>
 <revision><id>6</id><timestamp>2024-02-01T00:00:00Z</timestamp><contributor deleted="deleted" /></revision>
</page>
<page><title>Talk:A</title><ns>1</ns><id>11</id><revision><id>8</id><timestamp>2024-01-01T00:00:00Z</timestamp></revision></page>
<page><title>R</title><ns>0</ns><id>12</id><redirect title="A" /><revision><id>9</id><timestamp>2024-03-01T00:00:00Z</timestamp></revision></page>
<page><title>Odd</title><ns>x</ns><id>13</id><revision><id>10</id><timestamp>2024-03-01T00:00:00Z</timestamp></revision></page>
</mediawiki>
"""


@pytest.mark.parametrize("suffix, pack", [("xml", bytes), ("xml.gz", gzip.compress), ("xml.bz2", bz2.compress)])
def test_revision_file(spark, tmp_path, suffix, pack):
    (tmp_path / f"enwiki-20240101-stub-meta-history.{suffix}").write_bytes(pack(EXPORT.encode()))
    pages = revisions.read_pages(spark, str(tmp_path))
    kept = revisions.parse_revisions(pages)
    assert rows(kept, "rev_id", "contributor_kind", "year_month") == [
        ("1", "registered", "2024-01"), ("3", "anonymous", "2024-01"), ("6", "deleted", "2024-02"), ("9", "missing", "2024-03")
    ]
    assert [r.contributor_id for r in kept.orderBy("rev_id").collect()] == ["7", None, None, None]
    assert {r.title for r in kept.collect()} == {"A & B", "R"}
    assert str(kept.where("rev_id = '3'").first().timestamp) == "2024-01-03 00:00:00"
    reasons = revisions.classify_revisions(pages).where("reason IS NOT NULL")
    assert rows(reasons, "rev_id", "reason") == [("2", "minor_edit"), ("4", "missing_timestamp"), ("5", "bad_timestamp")]
    stats = revisions.revision_stats(pages).first()
    assert (stats.pages, stats.skipped_pages, stats.revisions, stats.skipped_revisions) == (4, 2, 4, 3)
    assert rows(revisions.page_rows(pages), "page_id", "is_redirect", "skipped") == [
        ("10", False, False), ("11", False, True), ("12", True, False), ("13", False, True)
    ]
    assert str(revisions.last_updated(kept).first().last_updated) == "2024-03-01 00:00:00"
    documents = revisions.document_records(pages)
    assert rows(documents.select("tuple_struct.title", "tuple_struct.is_redirect"), "title", "is_redirect") == [
        ("A & B", False), ("R", True)
    ]


def test_text_pages_equal_file_pages(spark, tmp_path, lines_of):
    name = "enwiki-20240101-stub-meta-history.xml"
    (tmp_path / name).write_text(EXPORT)
    from_file = revisions.parse_revisions(revisions.read_pages(spark, str(tmp_path)))
    elements = [f"<page>{part.split('</page>')[0]}</page>" for part in EXPORT.split("<page>")[1:]]
    from_text = revisions.parse_revisions(revisions.pages_from_text(lines_of(elements, name)))
    columns = ("page_hash", "rev_id", "timestamp", "title")
    assert rows(from_file, *columns) == rows(from_text, *columns)


def test_schemas_have_the_declared_fields(spark):
    wanted = {
        "PageView": ["access_type", "user_type", "date", "views"],
        "ClickStream": ["target_page", "date", "clicks", "navigation_type", "referer_category"],
        "OutboundPageLinks": ["pl_from", "pl_from_namespace", "pl_target_id", "timestamp"],
        "InboundPageLinks": ["pl_from", "pl_from_namespace", "pl_target_id", "timestamp"],
        "RevisionData": ["hash_id", "rev_id", "timestamp", "contributor_id"],
        "WikiDocument": ["title", "timestamp", "is_redirect", "hash_id", "last_updated"],
        "PageInfo": ["page_id", "page_namespace", "page_title", "page_is_redirect", "page_touched"],
    }
    assert set(SCHEMAS) == set(wanted)
    for name, fields in wanted.items():
        assert [f.name for f in schema_of(name)["tuple_struct"].dataType] == fields


def test_records_have_the_declared_types(spark, lines_of):
    views = pageviews.pageview_records(pageviews.parse_pageviews(lines_of(["en.wikipedia A desktop 1"])))
    clicks = clickstream.clickstream_records(clickstream.parse_clickstream(lines_of(["a\tb\tlink\t1"])))
    for name, records in (("PageView", views), ("ClickStream", clicks)):
        declared = schema_of(name)["tuple_struct"].dataType
        built = records.schema["tuple_struct"].dataType
        assert [(f.name, f.dataType) for f in built] == [(f.name, f.dataType) for f in declared]


def test_file_catalogue(spark, tmp_path):
    for name in ("pageviews/2024/pageviews-20240101-user.bz2", "clickstream/clickstream-enwiki-2024-03.tsv.gz",
                 "pagelinks/enwiki-20250101-pagelinks.sql.gz", "pagelinks/notes.txt",
                 "revisions/dewiki-20250101-stub-articles.xml.gz"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"x")
    files = manifest.list_files(spark, str(tmp_path))
    assert files.count() == 5
    matched = manifest.match_files(files).withColumn("wiki_code", F.coalesce("wiki_code", F.lit("-")))
    assert rows(matched, "data_type", "wiki_code") == [
        ("clickstream", "enwiki"), ("pagelinks", "enwiki"), ("pageviews", "-"), ("revisions", "dewiki")
    ]
    found = manifest.match_files(files, "pageviews", years=[2024], months=[1], wiki_codes=["frwiki"])
    assert rows(found, "file_name") == [("pageviews-20240101-user.bz2",)]
    assert manifest.match_files(files, "pageviews", years=[2023]).count() == 0
    assert manifest.match_files(files, "revisions", wiki_codes=["enwiki"]).count() == 0


def test_index_pages(spark):
    html = ('<a href="20240101/">20240101/</a> <a href="20240201/">x</a> '
            '<a href="pageviews-20240101-user.bz2">p</a> <a href="/enwiki/20240101/enwiki-20240101-pagelinks.sql.gz">l</a> '
            '<a href="/enwiki/20240101/enwiki-20240101-stub-meta-history.xml.gz">r</a> '
            '<a href="clickstream-enwiki-2024-03.tsv.gz">c</a>')
    pages = spark.createDataFrame([(html,)], "html string")
    assert rows(manifest.index_dates(pages), "dump_date") == [("20240101",), ("20240201",)]
    assert rows(manifest.index_files(pages, "pageviews"), "file_name") == [("pageviews-20240101-user.bz2",)]
    assert rows(manifest.index_files(pages, "pagelinks"), "file_name") == [("enwiki-20240101-pagelinks.sql.gz",)]
    assert rows(manifest.index_files(pages, "revisions"), "file_name") == [("enwiki-20240101-stub-meta-history.xml.gz",)]
    assert rows(manifest.index_files(pages, "clickstream"), "file_name") == [("clickstream-enwiki-2024-03.tsv.gz",)]


def test_batch_request_file(spark, tmp_path):
    path = tmp_path / "batch.json"
    path.write_text(json.dumps([
        {"data_type": "pageviews", "years": [2023], "months": [1, 2]},
        {"data_type": "clickstream", "wiki_codes": ["enwiki", "dewiki"]},
        {"data_type": "revisions", "wiki_codes": ["enwiki"]}, {"data_type": "pagelinks"}, {"data_type": "images"},
    ], indent=1))
    jobs = manifest.expand_requests(manifest.read_requests(spark, str(path)), default_year=2024)
    counts = {r.data_type: r["count"] for r in jobs.groupBy("data_type").count().collect()}
    assert counts == {"pageviews": 2, "clickstream": 24, "revisions": 1}
    assert jobs.where("data_type = 'revisions' AND year IS NULL AND month IS NULL").count() == 1


def test_own_format_can_be_registered(spark, lines_of):
    formats.register_format("upper", lambda df: df.select(F.upper("value").alias("v")))
    assert rows(formats.parse_as("upper", lines_of(["a"])), "v") == [("A",)]
    with pytest.raises(ValueError):
        formats.parse_as("unknown", lines_of(["a"]))


def test_latest_revision_equals_the_last_kept_row(spark, tmp_path):
    from dumpflow.operators.pages import latest_row

    for name in ("enwiki-20240101-stub-meta-history.xml", "enwiki-20240201-stub-meta-history.xml"):
        (tmp_path / name).write_text(EXPORT)
    pages = revisions.read_pages(spark, str(tmp_path))
    kept = revisions.parse_revisions(pages).select("page_hash", "rev_id", "timestamp", "contributor_kind")
    columns = ("page_hash", "rev_id", "timestamp", "contributor_kind")
    by_rows = latest_row(kept, ["page_hash"], [F.col("timestamp"), F.col("rev_id").cast("bigint")])
    assert rows(revisions.latest_revisions(pages), *columns) == rows(by_rows, *columns)


@pytest.mark.parametrize(("suffix", "pack"), [("xml", bytes), ("xml.bz2", bz2.compress)])
def test_exports_are_split(spark, tmp_path, suffix, pack):
    head, page, tail = "<mediawiki>\n<siteinfo><x/></siteinfo>\n", EXPORT[EXPORT.index("<page>"):EXPORT.index("</page>") + 7], "\n</mediawiki>\n"
    n = 20_000
    (tmp_path / f"enwiki-20240101-stub-meta-history.{suffix}").write_bytes(pack((head + "\n".join([page] * n) + tail).encode()))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k" if suffix.endswith("bz2") else "1m")
    try:
        pages = revisions.read_pages(spark, str(tmp_path))
        assert pages.count() == n and pages.where("page.id IS NULL").count() == 0
        if suffix == "xml":
            assert pages.rdd.getNumPartitions() > 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_other_namespaces_can_go_before_parsing(spark, tmp_path):
    (tmp_path / "enwiki-20240101-stub-meta-history.xml").write_text(EXPORT)
    every = revisions.parse_revisions(revisions.read_pages(spark, str(tmp_path)))
    main = revisions.parse_revisions(revisions.read_pages(spark, str(tmp_path), main_only=True))
    assert rows(every, *every.columns) == rows(main, *main.columns)


@pytest.mark.parametrize("spread", [4, 5, 40])
def test_every_scan_is_dealt_out_when_asked(spark, tmp_path, spread):
    for i in range(5):
        (tmp_path / f"pageviews-2024010{i + 1}-user.gz").write_bytes(gzip.compress(PAGEVIEWS))
    read = lines.read_lines(spark, str(tmp_path), spread=spread, files=F.col("file_name").contains("20240102"))
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in plan and read.count() == 12
    scan = next(line for line in plan.split("\n") if "FileScan" in line)
    assert "20240102" in scan
