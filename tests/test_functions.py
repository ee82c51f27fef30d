"""Column functions against plain Python on random and chosen values."""

from __future__ import annotations

import base64
import hashlib
import random
import urllib.parse

import pytest
from pyspark.sql import functions as F

from dumpflow.functions import codes, ids, text, times


def column(spark, values, fn):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.out for r in frame.select("i", fn(F.col("v")).alias("out")).orderBy("i").collect()]


def random_titles(n=300):
    rng = random.Random(7)
    spans = [(32, 126), (0xA1, 0x24F), (0x400, 0x45F), (0x4E00, 0x4FFF), (0x1F300, 0x1F5FF)]
    return ["".join(chr(rng.randint(*rng.choice(spans))) for _ in range(rng.randint(0, 20))) for _ in range(n)]


def test_page_identifier_is_the_published_formula(spark):
    titles = random_titles() + ["", "A/B~c*d e+f", "Main_Page", "%2F%7E"]
    want = []
    for title in titles:
        digest = hashlib.sha256(f"enwiki:{urllib.parse.quote(title)}".encode()).digest()
        want.append(base64.urlsafe_b64encode(digest).decode()[:22])
    assert column(spark, titles, lambda c: ids.page_identifier(F.lit("enwiki"), c)) == want


def test_url_quote(spark):
    titles = random_titles()
    assert column(spark, titles, ids.url_quote) == [urllib.parse.quote(t) for t in titles]


def test_hashes_need_all_parts(spark):
    assert column(spark, ["7", "", None], lambda c: ids.content_hash(F.lit("enwiki"), c)) == [
        hashlib.sha256(b"enwiki-7").hexdigest(), None, None
    ]
    assert column(spark, ["t", ""], lambda c: ids.document_hash(F.lit("enwiki"), F.lit(7), c)) == [
        hashlib.sha256(b"enwiki-7-t").hexdigest(), None
    ]
    assert [len(h) for h in column(spark, ["x"], lambda c: ids.short_hash(c, 99))] == [32]


def test_key_text_prints_null_as_none(spark):
    assert column(spark, ["a", None], lambda c: ids.key_text(c, F.lit(1))) == ["a|1", "None|1"]


@pytest.mark.parametrize(
    "domain, code",
    [("en.wikipedia", "enwiki"), ("en.m.wikipedia", "enwiki"), ("de.wiktionary", "dewiktionary"),
     ("zh-yue.wikipedia", "zh_yuewiki"), ("commons.wikimedia", "commonswiki"), ("wikidata", "wikidatawiki"),
     ("enwiki", "enwiki")],
)
def test_normalize_wiki_code(spark, domain, code):
    assert column(spark, [domain], ids.normalize_wiki_code) == [code]


FILE_DATES = [
    ("pageviews-20240101-user.bz2", "2024-01-01"),
    ("pageviews-20240101-010000.gz", "2024-01-01"),
    ("pagecounts-2016-01-01-000000.gz", "2016-01-01"),
    ("clickstream-enwiki-2024-03.tsv.gz", "2024-03-01"),
    ("enwiki-20250101-pagelinks.sql.gz", "2025-01-01"),
    ("enwiki-20250501-page.sql", "2025-05-01"),
    ("/a/202401/x", "2024-01-01"),
    ("pageviews-20240101-user", None),
    ("enwiki-20240101-stub-meta-history.xml.gz", "2024-01-01"),
]


@pytest.mark.parametrize("name, want", FILE_DATES)
def test_file_dates(spark, name, want):
    assert column(spark, [name], times.file_date_text) == [want]
    assert column(spark, [name], times.file_year_month) == [want and want[:7]]


def test_impossible_file_date_is_null(spark):
    name = "pageviews-20241340.bz2"
    assert column(spark, [name], times.file_date_text) == ["2024-13-40"]
    assert column(spark, [name], times.file_date) == [None]


def test_file_wiki_code(spark):
    names = ["enwiki-20240101-page.sql", "clickstream-dewiki-2024-01.tsv.gz", "20240101.txt"]
    assert column(spark, names, times.file_wiki_code) == ["enwiki", "dewiki", None]


@pytest.mark.parametrize(
    "stamp, want",
    [("2024-01-02T03:04:05Z", "2024-01-02T03:04:05Z"), ("2024-01-02T03:04:05+02:00", "2024-01-02T01:04:05Z"),
     ("2024-01-02T03:04:05-0130", "2024-01-02T04:34:05Z"), ("2024-01-02 03:04:05", "2024-01-02T03:04:05Z"),
     ("2024-01-02", "2024-01-02T00:00:00Z"), ("2024-01-02T03:04", "2024-01-02T03:04:00Z"),
     ("2024-01-02T03:04:05.123Z", "2024-01-02T03:04:05Z"), ("2024-02-30T00:00:00Z", None),
     ("soon", None), ("2024", None), ("", None), (None, None)],
)
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_parse_iso_in_any_session_zone(spark, stamp, want, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert column(spark, [stamp], lambda c: times.iso_text(times.parse_iso(c))) == [want]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_touched_and_normalized(spark):
    assert column(spark, ["20240102030405", "2024010203040", "20241302030405"],
                  lambda c: times.stamp_text(times.parse_touched(c))) == ["2024-01-02 03:04:05", None, None]
    shapes = ["2024-01-02 03:04:05.9", "2024-01-02", "2024-01", "20240102", "2024", "x", None]
    assert column(spark, shapes, times.normalize_timestamp) == [
        "2024-01-02 03:04:05", "2024-01-02 00:00:00", "2024-01-01 00:00:00", "2024-01-02 00:00:00", None, None, None
    ]
    assert column(spark, ["0", "1704164645999"], lambda c: times.normalize_epoch_ms(c.cast("bigint"))) == [
        "1970-01-01 00:00:00", "2024-01-02 03:04:05"
    ]


def test_event_time_takes_seconds_or_iso(spark):
    got = column(spark, ["1704164645", "2024-01-02T03:04:05Z", "soon"],
                 lambda c: times.stamp_text(times.event_time(c)))
    assert got == ["2024-01-02 03:04:05", "2024-01-02 03:04:05", None]


def test_words_and_strip_match_python(spark):
    blanks = [" ", "\t", "\x1c", "\x1f", "\x85", "\xa0", "\u1680", "\u2003", "\u2028", "\u202f", "\u3000", "\x0b"]
    rng = random.Random(3)
    lines = ["", "   ", "a", *["".join(rng.choice([*blanks, "a", "b:c", "\xe9"]) for _ in range(12)) for _ in range(200)]]
    assert column(spark, lines, text.words) == [s.split() for s in lines]
    assert column(spark, lines, text.strip_blanks) == [s.strip() for s in lines]
    assert column(spark, lines, text.is_blank) == [not s.strip() for s in lines]


def test_count_or_zero(spark):
    values = ["12", "007", "-1", "1.5", "n/a", "", None, "9" * 30]
    assert column(spark, values, text.count_or_zero) == [12, 7, 0, 0, 0, 0, 0, 0]


def test_netloc_matches_python(spark):
    urls = ["https://www.Google.com/search?q=1", "http://u:p@Bing.com:80#x", "//host/path", "other-google", "",
            "mailto:a@b.c", "ftp://x?y", "1http://x/"]
    assert column(spark, urls, text.url_netloc) == [urllib.parse.urlparse(u).netloc.lower() for u in urls]
    assert column(spark, urls[:4], text.url_host) == ["www.google.com", "bing.com", "host", None]


def test_referer_category(spark):
    sources = ["https://www.google.co.uk/", "http://m.facebook.com", "http://x.org", "other-yahoo", "", None]
    assert column(spark, sources, lambda c: codes.referer_category(F.lit("external"), c)) == [
        "other-google", "other-facebook", "other-other", "other-yahoo", "other-other", "other-other"
    ]
    assert column(spark, ["other-yahoo"], lambda c: codes.referer_category(F.lit("external"), c, strict=True)) == [
        "other-other"
    ]
    assert column(spark, ["x"], lambda c: codes.referer_category(F.lit("link"), c)) == ["article"]
    assert column(spark, ["x"], lambda c: codes.referer_category(F.lit("other"), c)) == ["other-empty"]


def test_codes(spark):
    assert column(spark, ["desktop", "Mobile-App", "mobile-web", "all-access", "tv", None], codes.access_code) == [
        0, 1, 2, 3, -1, -1
    ]
    names = ["pageviews-20240101-user.bz2", "x-Spider", "x-automated", "x-bot", "pageviews-20240101.bz2"]
    assert column(spark, names, codes.agent_code) == [0, 1, 3, 3, -1]
