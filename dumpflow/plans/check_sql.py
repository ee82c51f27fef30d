"""Shared pieces of the check queries, in DuckDB SQL over the base tables."""

from __future__ import annotations

BLANKS = r"\t\n\x0b\f\r \x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def page_hash(wiki: str, title: str) -> str:
    quoted = f"replace(url_encode({title}), '%2F', '/')"
    return f"substr(translate(to_base64(unhex(sha256(concat({wiki}, ':', {quoted})))), '+/', '-_'), 1, 22)"


def wiki_of(key: str) -> str:
    return f"['enwiki', 'dewiki', 'frwiki'][1 + {key} % 3]"


AGENT = "['-user', '-spider', '-automated', '-bot', ''][1 + event_id // 4 % 5]"

# Pageview facts straight from the events, without text.
PV = f"""pv AS (
  SELECT event_id, user_id, CAST(ts AS DATE) AS day, strftime(ts, '%Y-%m') AS year_month,
    ['en.wikipedia', 'de.wikipedia', 'fr.wikipedia'][1 + user_id % 3] AS domain,
    {wiki_of('user_id')} AS wiki_code,
    CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_type = 'error' THEN 'Special:P' || user_id
      WHEN event_type = 'signup' THEN 'User_talk:U' || user_id
      WHEN event_type = 'purchase' THEN 'Page:' || user_id ELSE 'Page_' || user_id END AS title,
    ['desktop', 'mobile-web', 'Mobile-App', 'tablet'][1 + event_id % 4] AS access_type,
    [0, 2, 1, -1][1 + event_id % 4] AS access_code,
    [0, 1, 3, 3, -1][1 + event_id // 4 % 5] AS agent_code,
    'pageviews-' || strftime(ts, '%Y%m%d') || {AGENT} || '.bz2' AS file_name,
    CASE WHEN event_id % 17 = 0 THEN 0 ELSE CAST(floor(value) AS BIGINT) END AS views,
    CASE WHEN event_id % 31 = 0 THEN 'empty_lines' WHEN event_id % 5 = 4 THEN 'invalid_format'
      WHEN event_id % 5 <> 0 AND event_type IN ('error', 'signup') THEN 'excluded_prefix'
      WHEN event_id % 17 = 0 OR floor(value) = 0 THEN 'zero_pageviews' END AS reason,
    event_type
  FROM events)"""

# Clickstream facts; a line whose source is empty loses its first field.
CS = f"""cs AS (
  SELECT event_id, user_id, strftime(ts, '%Y-%m') AS year_month,
    CAST(date_trunc('month', ts) AS DATE) AS day,
    {wiki_of('user_id')} AS wiki_code,
    'clickstream-' || {wiki_of('user_id')} || '-' || strftime(ts, '%Y-%m') || '.tsv.gz' AS file_name,
    'Page_' || user_id AS target,
    CASE event_type WHEN 'click' THEN 'link' WHEN 'view' THEN 'external' WHEN 'purchase' THEN 'external'
      ELSE 'other' END AS type,
    CASE WHEN event_type = 'click' THEN 'article' WHEN event_type NOT IN ('view', 'purchase') THEN 'other-empty'
      ELSE ['other-google', 'other-google', NULL, 'other-bing', 'other-other'][1 + event_id % 5] END AS category,
    CASE WHEN event_type = 'click' THEN 'article' WHEN event_type NOT IN ('view', 'purchase') THEN 'other-empty'
      ELSE ['other-google', 'other-other', NULL, 'other-bing', 'other-other'][1 + event_id % 5] END AS strict_category,
    CASE WHEN event_id % 11 = 0 THEN 0 ELSE CAST(floor(value) AS BIGINT) END AS clicks,
    event_id % 13 <> 0 AND event_id % 5 <> 2 AS kept
  FROM events)"""

# Link edges of the dump, two per line item.
PL = f"""pl AS (
  SELECT {wiki_of('l_linenumber')} AS wiki_code, CAST(date_trunc('month', l_shipdate) AS DATE) AS day,
    strftime(l_shipdate, '%Y-%m') AS year_month,
    l_orderkey AS pl_from, l_linenumber AS pl_from_namespace, unnest([l_partkey, l_suppkey]) AS pl_target_id
  FROM lineitem WHERE l_returnflag <> 'R')"""

# Rows of the page table.
PG = """pg AS (
  SELECT p_partkey AS page_id, CAST(p_partkey % 2 AS INTEGER) AS page_namespace,
    CASE WHEN p_partkey % 7 = 0 THEN replace(p_name, ' ', '_') || '_(x)'
      WHEN p_partkey % 11 = 0 THEN 'It''s_' || replace(p_name, ' ', '_') || ',;'
      ELSE 'Page_' || p_partkey END AS page_title,
    CASE WHEN p_partkey % 6 = 0 THEN 1 ELSE 0 END AS page_is_redirect,
    '2024-01-01 ' || lpad(CAST(p_partkey % 24 AS VARCHAR), 2, '0') || ':'
      || lpad(CAST(p_partkey % 60 AS VARCHAR), 2, '0') || ':00' AS page_touched,
    CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE '2024-01-02 00:00:00' END AS page_links_updated,
    p_partkey * 7 AS page_latest, CAST(p_size AS BIGINT) AS page_len,
    CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE 'wikitext' END AS page_content_model
  FROM part)"""

# Revisions of main-namespace pages.
RV = """rv AS (
  SELECT o_orderkey, o_custkey, i, o_orderstatus,
    CASE WHEN o_custkey % 2 = 0 THEN 'enwiki' ELSE 'dewiki' END AS wiki_code,
    o_orderkey * 10 + i AS rev_id,
    CAST(CAST(o_orderdate AS DATE) + CAST(i AS INTEGER) AS TIMESTAMP) + INTERVAL 10 HOUR
      + to_seconds(i) AS stamp,
    CASE WHEN i = 3 THEN 'missing_timestamp' WHEN (o_orderkey + i) % 5 = 0 THEN 'minor_edit'
      WHEN i = 2 AND o_orderkey % 19 = 0 THEN 'bad_timestamp' END AS reason,
    -- An id of 0 stands for no contributor.
    CASE WHEN (o_orderkey + i) % 4 = 0 AND o_custkey = 0 THEN 'missing'
      ELSE ['registered', 'anonymous', 'deleted', 'missing'][1 + (o_orderkey + i) % 4] END AS contributor_kind,
    CASE WHEN (o_orderkey + i) % 4 = 0 AND o_custkey <> 0 THEN CAST(o_custkey AS VARCHAR) END AS contributor_id
  FROM (SELECT *, unnest(range(1, 2 + o_orderkey % 4)) AS i FROM orders) WHERE o_orderkey % 3 <> 0)"""

# Dump file names and what they say.
DF = f"""df AS (
  SELECT o_orderkey, o_orderstatus, o_orderkey % 7 AS k,
    CASE o_orderkey % 7
      WHEN 0 THEN 'pageviews-' || strftime(o_orderdate, '%Y%m%d') || '-user.bz2'
      WHEN 1 THEN 'pageviews-' || strftime(o_orderdate, '%Y%m%d') || '-010000.gz'
      WHEN 2 THEN 'pagecounts-' || strftime(o_orderdate, '%Y-%m-%d') || '-000000.gz'
      WHEN 3 THEN 'clickstream-' || {wiki_of('o_custkey')} || '-' || strftime(o_orderdate, '%Y-%m') || '.tsv.gz'
      WHEN 4 THEN {wiki_of('o_custkey')} || '-' || strftime(o_orderdate, '%Y%m%d') || '-pagelinks.sql.gz'
      WHEN 5 THEN {wiki_of('o_custkey')} || '-' || strftime(o_orderdate, '%Y%m%d') || '-stub-meta-history.xml.gz'
      ELSE 'notes-' || o_orderkey || '.txt' END AS file_name,
    CASE o_orderkey % 7 WHEN 0 THEN 'pageviews' WHEN 3 THEN 'clickstream' WHEN 4 THEN 'pagelinks'
      WHEN 5 THEN 'revisions' END AS data_type,
    CASE WHEN o_orderkey % 7 IN (3, 4, 5) THEN {wiki_of('o_custkey')} END AS wiki_code,
    CASE o_orderkey % 7 WHEN 6 THEN NULL WHEN 3 THEN strftime(o_orderdate, '%Y-%m-01')
      ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day
  FROM orders)"""


def with_(*parts: str) -> str:
    return "WITH " + ", ".join(parts) + " "
