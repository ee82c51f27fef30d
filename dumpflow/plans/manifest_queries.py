"""File name, catalogue and request queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dumpflow.functions.times import file_date_text, file_year_month
from dumpflow.plans import adapters
from dumpflow.plans.check_sql import DF, with_
from dumpflow.plans.registry import query
from dumpflow.sinks.tables import layout_path, stage_path
from dumpflow.sources import manifest as man

# Finished orders stand for files held locally, the others for the remote index.
_LOCAL = "o_orderstatus = 'F'"


def _files(spark: SparkSession, folder: str, where: str = "true") -> DataFrame:
    return adapters.dump_file_names(spark, folder).where(where).select("file_name").distinct()


@query(with_(DF) + "SELECT o_orderkey, day AS file_date, substr(day, 1, 7) AS year_month FROM df")
def filename_date(spark: SparkSession, folder: str) -> DataFrame:
    name = F.col("file_name")
    return adapters.dump_file_names(spark, folder).select(
        "o_orderkey", file_date_text(name).alias("file_date"), file_year_month(name).alias("year_month")
    )


@query(
    with_(DF)
    + """SELECT DISTINCT file_name, data_type, wiki_code, day AS dump_date FROM df
    WHERE data_type IS NOT NULL AND (wiki_code IS NULL OR wiki_code IN ('enwiki', 'frwiki'))
      AND substr(day, 1, 4) IN ('1995', '1996') AND substr(day, 6, 2) IN ('01', '02', '03', '04', '05', '06')"""
)
def manifest_match(spark: SparkSession, folder: str) -> DataFrame:
    matched = man.match_files(
        _files(spark, folder), years=[1995, 1996], months=range(1, 7), wiki_codes=["enwiki", "frwiki"]
    )
    return matched.select("file_name", "data_type", "wiki_code", F.col("dump_date").cast("string").alias("dump_date"))


@query(
    with_(DF)
    + f"""SELECT DISTINCT file_name FROM df WHERE data_type IS NOT NULL
    EXCEPT SELECT file_name FROM df WHERE {_LOCAL}"""
)
def manifest_missing(spark: SparkSession, folder: str) -> DataFrame:
    remote = man.match_files(_files(spark, folder))
    return man.missing_files(remote, _files(spark, folder, _LOCAL)).select("file_name")


@query(
    with_(DF)
    + f"""SELECT DISTINCT file_name, 0 AS source_rank FROM df WHERE data_type IS NOT NULL AND {_LOCAL}
    UNION ALL (SELECT file_name, 1 FROM (SELECT DISTINCT file_name FROM df WHERE data_type IS NOT NULL
      EXCEPT SELECT file_name FROM df WHERE data_type IS NOT NULL AND {_LOCAL}))"""
)
def manifest_all(spark: SparkSession, folder: str) -> DataFrame:
    return man.all_files(
        man.match_files(_files(spark, folder, _LOCAL)), man.match_files(_files(spark, folder))
    )


@query(
    with_(DF)
    + """SELECT DISTINCT file_name, CASE data_type
      WHEN 'pageviews' THEN 'https://dumps.wikimedia.org/other/pageview_complete/' || substr(day, 1, 4) || '/'
        || substr(day, 1, 7) || '/' || file_name
      WHEN 'clickstream' THEN 'https://dumps.wikimedia.org/other/clickstream/' || substr(day, 1, 7) || '/' || file_name
      ELSE 'https://dumps.wikimedia.org/' || wiki_code || '/' || replace(day, '-', '') || '/' || file_name END AS url
    FROM df WHERE data_type IS NOT NULL"""
)
def manifest_urls(spark: SparkSession, folder: str) -> DataFrame:
    files = man.match_files(_files(spark, folder))
    url = man.file_url(F.col("file_name"), F.col("data_type"), F.col("dump_date"), F.col("wiki_code"))
    return files.select("file_name", url.alias("url"))


@query(
    with_(DF)
    + """SELECT DISTINCT file_name,
      concat_ws('/', data_type, wiki_code, CASE WHEN data_type IN ('pageviews', 'clickstream') THEN substr(day, 1, 7)
        ELSE replace(day, '-', '') END, file_name) AS layout,
      concat_ws('/', coalesce(wiki_code, 'all'), data_type, substr(day, 1, 4), substr(day, 6, 2), 'raw', file_name)
        AS staged
    FROM df WHERE data_type IS NOT NULL"""
)
def layout_partitions(spark: SparkSession, folder: str) -> DataFrame:
    files = man.match_files(_files(spark, folder))
    timed = F.col("data_type").isin("pageviews", "clickstream")
    period = F.when(timed, F.date_format("dump_date", "yyyy-MM")).otherwise(F.date_format("dump_date", "yyyyMMdd"))
    name, wiki = F.col("file_name"), F.coalesce("wiki_code", F.lit("all"))
    return files.select(
        "file_name",
        layout_path(F.col("data_type"), F.col("wiki_code"), period, name).alias("layout"),
        stage_path(wiki, F.col("data_type"), F.col("dump_date"), False, name).alias("staged"),
    )


@query(with_(DF) + "SELECT wiki_code, max(day) AS dump_date FROM df WHERE data_type IN ('revisions', 'pagelinks') GROUP BY 1")
def latest_dump(spark: SparkSession, folder: str) -> DataFrame:
    files = man.match_files(_files(spark, folder)).where(F.col("data_type").isin("revisions", "pagelinks"))
    return man.latest_dump(files).select("wiki_code", F.col("dump_date").cast("string").alias("dump_date"))


@query(
    """WITH r AS (SELECT c_custkey,
      ['pageviews', 'clickstream', 'revisions', 'pagelinks', 'images'][1 + c_custkey % 5] AS data_type,
      CASE WHEN c_custkey % 5 > 1 THEN [CAST(NULL AS INTEGER)] WHEN c_custkey % 2 = 0
        THEN [CAST(2020 + c_nationkey % 4 AS INTEGER), 2024] ELSE [2024] END AS years,
      CASE WHEN c_custkey % 5 > 1 THEN [CAST(NULL AS INTEGER)] WHEN c_custkey % 3 = 0
        THEN [CAST(1 + c_nationkey % 12 AS INTEGER)] ELSE [1,2,3,4,5,6,7,8,9,10,11,12] END AS months,
      CASE WHEN c_custkey % 4 <> 0 THEN ['enwiki', 'dewiki'] WHEN c_custkey % 5 > 1 THEN CAST([] AS VARCHAR[])
        ELSE [CAST(NULL AS VARCHAR)] END AS wikis FROM customer),
    y AS (SELECT c_custkey, data_type, unnest(years) AS year, months, wikis FROM r WHERE data_type <> 'images'),
    m AS (SELECT c_custkey, data_type, year, unnest(months) AS month, wikis FROM y)
    SELECT c_custkey, data_type, year, month, unnest(wikis) AS wiki_code FROM m"""
)
def request_expand(spark: SparkSession, folder: str) -> DataFrame:
    requests = adapters.batch_requests(spark, folder).select(
        "c_custkey", F.from_json("value", man.REQUEST_DDL).alias("r")
    )
    return man.expand_requests(requests.select("c_custkey", "r.*"), default_year=2024)


@query("""SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS href FROM pages""")
def href_extract(spark: SparkSession, folder: str) -> DataFrame:
    return man.extract_links(adapters.table(spark, folder, "pages").select("page_id", "html"))
