"""Dump text rendered from star-schema tables.

No dump files come with the tables, so each query first writes its rows as dump
text and then runs the real parser on that text. Every rendering works row by
row: one table row gives one line, statement, page or message.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dumpflow.sources.lines import spread_out

WIKI_OF = "elt(1 + {key} % 3, 'enwiki', 'dewiki', 'frwiki')"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rows_to_render(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """The columns of a table that a rendering needs, over all cores if the table is small."""
    return spread_out(table(spark, folder, name).select(*columns))


def pageview_lines(spark: SparkSession, folder: str) -> DataFrame:
    """A pageview line per event: all arities, blank and broken lines, dropped namespaces."""
    return rows_to_render(
        spark, folder, "events", "event_id", "ts", "user_id", "event_type", "value"
    ).selectExpr(
        "event_id",
        "concat('pageviews-', date_format(ts, 'yyyyMMdd'), "
        "  elt(1 + event_id div 4 % 5, '-user', '-spider', '-automated', '-bot', ''), '.bz2') AS file_name",
        "elt(1 + user_id % 3, 'en.wikipedia', 'de.wikipedia', 'fr.wikipedia') AS _domain",
        "CASE event_type WHEN 'error' THEN concat('Special:P', user_id) "
        "  WHEN 'signup' THEN concat('User_talk:U', user_id) "
        "  WHEN 'purchase' THEN concat('Page:', user_id) ELSE concat('Page_', user_id) END AS _title",
        "elt(1 + event_id % 4, 'desktop', 'mobile-web', 'Mobile-App', 'tablet') AS _access",
        "concat(if(event_id % 17 = 0, 'x', ''), cast(floor(value) AS bigint)) AS _views",
        "if(event_id % 7 = 0, '\\t', ' ') AS _sep",
    ).selectExpr(
        "event_id",
        "file_name",
        "CASE WHEN event_id % 31 = 0 THEN '  ' ELSE CASE event_id % 5 "
        "  WHEN 0 THEN concat_ws(_sep, _domain, _access, _views) "
        "  WHEN 1 THEN concat_ws(_sep, _domain, _title, _access, _views) "
        "  WHEN 2 THEN concat_ws(_sep, _domain, _title, event_id, _access, _views) "
        "  WHEN 3 THEN concat_ws(_sep, _domain, _title, event_id, _access, _views, 'A3B9') "
        "  ELSE concat_ws(_sep, _domain, _title) END END AS value",
    )


def clickstream_lines(spark: SparkSession, folder: str) -> DataFrame:
    """A clickstream line per event: URL, grouped and empty sources, short lines, bad counts."""
    return rows_to_render(
        spark, folder, "events", "event_id", "ts", "user_id", "event_type", "value"
    ).selectExpr(
        "event_id",
        f"concat('clickstream-', {WIKI_OF.format(key='user_id')}, '-', date_format(ts, 'yyyy-MM'), '.tsv.gz') "
        "  AS file_name",
        "elt(1 + event_id % 5, concat('https://www.Google.com/search?q=', user_id), 'other-google', '', "
        "  concat('http://news.bing.com:80/', user_id), concat('Page_', event_id % 97)) AS _source",
        "concat('Page_', user_id) AS _target",
        "CASE event_type WHEN 'click' THEN 'link' WHEN 'view' THEN 'external' WHEN 'purchase' THEN 'external' "
        "  WHEN 'error' THEN 'other' ELSE 'junk' END AS _type",
        "if(event_id % 11 = 0, 'n/a', cast(cast(floor(value) AS bigint) AS string)) AS _clicks",
    ).selectExpr(
        "event_id",
        "file_name",
        "if(event_id % 13 = 0, concat_ws('\\t', _source, _target, _type), "
        "  concat_ws('\\t', _source, _target, _type, _clicks, if(event_id % 5 = 3, 'extra', NULL))) AS value",
    )


def pagelink_statements(spark: SparkSession, folder: str) -> DataFrame:
    """An INSERT of two links per line item; returned items go to another table's INSERT."""
    return rows_to_render(
        spark, folder, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_shipdate"
    ).selectExpr(
        f"concat({WIKI_OF.format(key='l_linenumber')}, '-', date_format(l_shipdate, 'yyyyMM'), "
        "  '01-pagelinks.sql.gz') AS file_name",
        "concat(if(l_linenumber = 1, '-- links\\n\\n', ''), 'INSERT INTO `', "
        "  if(l_returnflag = 'R', 'templatelinks', 'pagelinks'), '` VALUES (', "
        "  concat_ws(',', l_orderkey, l_linenumber, l_partkey), '),(', "
        "  concat_ws(',', l_orderkey, l_linenumber, l_suppkey), ')') AS value",
    )


def dump_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The same dump as single raw lines."""
    return pagelink_statements(spark, folder).select("file_name", F.explode(F.split("value", "\n")).alias("value"))


def page_statements(spark: SparkSession, folder: str, day: str = "20240501", moved: bool = False, swapped: bool = False) -> DataFrame:
    """An INSERT per part: titles with brackets, quotes, commas and semicolons, and NULLs.

    With `moved`, every fourth page has another title and is a redirect. With
    `swapped`, even pages hold the plain title of the even page next to them.
    """
    move = "p_partkey % 4 = 0" if moved else "false"
    swap = "p_partkey % 2 = 0" if swapped else "false"
    return rows_to_render(
        spark, folder, "part", "p_partkey", "p_name", "p_size"
    ).selectExpr(
        f"'enwiki-{day}-page.sql' AS file_name",
        "concat('INSERT INTO `page` VALUES (', concat_ws(',', p_partkey, p_partkey % 2, "
        f"  concat('''', CASE WHEN {move} THEN concat('Moved_', p_partkey) "
        f"    WHEN {swap} THEN concat('Page_', p_partkey + if(p_partkey % 4 = 0, 2, -2)) "
        "    WHEN p_partkey % 7 = 0 THEN concat(replace(p_name, ' ', '_'), '_(x)') "
        "    WHEN p_partkey % 11 = 0 THEN concat('It\\\\''s_', replace(p_name, ' ', '_'), ',;') "
        "    ELSE concat('Page_', p_partkey) END, ''''), "
        f"  if(p_partkey % 6 = 0 OR {move}, 1, 0), 0, '0.5', "
        "  concat('''20240101', lpad(p_partkey % 24, 2, '0'), lpad(p_partkey % 60, 2, '0'), '00'''), "
        "  if(p_partkey % 3 = 0, 'NULL', '''20240102000000'''), p_partkey * 7, p_size, "
        "  if(p_partkey % 5 = 0, 'NULL', '''wikitext'''), 'NULL'), ')') AS value",
    )


def revision_pages(spark: SparkSession, folder: str) -> DataFrame:
    """A `<page>` per order with one to four revisions."""
    return rows_to_render(
        spark, folder, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus"
    ).selectExpr(
        "concat(elt(1 + o_custkey % 2, 'enwiki', 'dewiki'), '-', date_format(o_orderdate, 'yyyyMM'), "
        "  '01-stub-meta-history.xml.gz') AS file_name",
        "concat('<page><title>Order &amp; ', o_orderkey, '</title><ns>', if(o_orderkey % 3 = 0, 1, 0), "
        "  '</ns><id>', o_orderkey, '</id>', if(o_orderstatus = 'P', '<redirect title=\"T\" />', ''), "
        "  concat_ws('', transform(sequence(1, cast(1 + o_orderkey % 4 AS int)), i -> concat("
        "    '<revision><id>', o_orderkey * 10 + i, '</id>', "
        "    CASE WHEN i = 3 THEN '' WHEN i = 2 AND o_orderkey % 19 = 0 THEN '<timestamp>soon</timestamp>' "
        "      ELSE concat('<timestamp>', date_format(date_add(o_orderdate, i), 'yyyy-MM-dd'), "
        "        'T10:00:0', i, 'Z</timestamp>') END, "
        "    if((o_orderkey + i) % 5 = 0, '<minor />', ''), "
        "    CASE (o_orderkey + i) % 4 "
        "      WHEN 0 THEN concat('<contributor><username>u', o_custkey, '</username><id>', o_custkey, "
        "        '</id></contributor>') "
        "      WHEN 1 THEN '<contributor><ip>10.0.0.1</ip></contributor>' "
        "      WHEN 2 THEN '<contributor deleted=\"deleted\" />' ELSE '' END, "
        "    '</revision>'))), '</page>') AS value",
    )


def event_messages(spark: SparkSession, folder: str, streaming: bool = False) -> DataFrame:
    """Events as `(topic, value)` messages, the value being JSON; every 50th is cut short."""
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    if streaming:
        events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    else:
        events = table(spark, folder, "events")
    return events.selectExpr(
        "CASE event_type WHEN 'click' THEN 'clickstream_topic' WHEN 'view' THEN 'pageview_topic' "
        "  ELSE 'wikidocument_topic' END AS topic",
        "CASE WHEN event_id % 50 = 0 THEN concat('{\"id\": ', user_id) ELSE "
        "  to_json(named_struct('id', user_id, 'event_id', event_id, 'event_type', event_type)) END AS value",
    )


MESSAGE_SCHEMA = "id bigint, event_id bigint, event_type string"


def typed_messages(spark: SparkSession, folder: str) -> DataFrame:
    """JSON envelopes of every record type, one per event."""
    return rows_to_render(
        spark, folder, "events", "event_id", "user_id", "ts"
    ).selectExpr(
        "event_id",
        "elt(1 + event_id % 3, 'pageinfo_topic', 'wikidocument_topic', 'other_topic') AS topic",
        "concat('{\"page_hash\":\"h', user_id, '\",\"year_month\":\"', date_format(ts, 'yyyy-MM'), '\",', "
        "  CASE event_id % 9 WHEN 0 THEN '\"_schema_name\":\"RevisionData\",' WHEN 1 THEN '\"wiki_code\":\"enwiki\",' "
        "    WHEN 4 THEN '\"direction\":\"inbound\",' ELSE '' END, '\"tuple_struct\":{', "
        "  CASE event_id % 9 WHEN 0 THEN '\"x\":1' WHEN 1 THEN '\"title\":\"t\"' WHEN 2 THEN '\"title\":\"t\"' "
        "    WHEN 3 THEN concat('\"pl_from\":', user_id, ',\"pl_target_id\":', event_id) "
        "    WHEN 4 THEN concat('\"pl_from\":', user_id, ',\"pl_target_id\":', event_id) "
        "    WHEN 5 THEN '\"rev_id\":\"7\",\"title\":\"t\"' WHEN 6 THEN '\"access_type\":0' "
        "    WHEN 7 THEN '\"target_page\":null' ELSE '\"y\":2' END, '}}') AS value",
    )


def dump_file_names(spark: SparkSession, folder: str) -> DataFrame:
    """A dump file name per order, of every type, with some names of no type."""
    return rows_to_render(
        spark, folder, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus"
    ).selectExpr(
        "o_orderkey",
        "o_orderstatus",
        "CASE o_orderkey % 7 "
        "  WHEN 0 THEN concat('pageviews-', date_format(o_orderdate, 'yyyyMMdd'), '-user.bz2') "
        "  WHEN 1 THEN concat('pageviews-', date_format(o_orderdate, 'yyyyMMdd'), '-010000.gz') "
        "  WHEN 2 THEN concat('pagecounts-', date_format(o_orderdate, 'yyyy-MM-dd'), '-000000.gz') "
        f" WHEN 3 THEN concat('clickstream-', {WIKI_OF.format(key='o_custkey')}, '-', "
        "    date_format(o_orderdate, 'yyyy-MM'), '.tsv.gz') "
        f" WHEN 4 THEN concat({WIKI_OF.format(key='o_custkey')}, '-', date_format(o_orderdate, 'yyyyMMdd'), "
        "    '-pagelinks.sql.gz') "
        f" WHEN 5 THEN concat({WIKI_OF.format(key='o_custkey')}, '-', date_format(o_orderdate, 'yyyyMMdd'), "
        "    '-stub-meta-history.xml.gz') "
        "  ELSE concat('notes-', o_orderkey, '.txt') END AS file_name",
    )


def batch_requests(spark: SparkSession, folder: str) -> DataFrame:
    """A batch request per customer, as JSON text, with missing keys."""
    return table(spark, folder, "customer").selectExpr(
        "c_custkey",
        "concat('{\"data_type\":\"', elt(1 + c_custkey % 5, 'pageviews', 'clickstream', 'revisions', 'pagelinks', "
        "  'images'), '\"', "
        "  if(c_custkey % 2 = 0, concat(',\"years\":[', 2020 + c_nationkey % 4, ',2024]'), ''), "
        "  if(c_custkey % 3 = 0, concat(',\"months\":[', 1 + c_nationkey % 12, ']'), ''), "
        "  if(c_custkey % 4 = 0, '', ',\"wiki_codes\":[\"enwiki\",\"dewiki\"]'), '}') AS value",
    )
