"""File catalogues and index pages: which dump files exist, where, and which are missing."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dumpflow import fixed_values as fx
from dumpflow.functions.text import once
from dumpflow.functions.times import file_date, file_wiki_code

REQUEST_DDL = "data_type string, years array<int>, months array<int>, wiki_codes array<string>"


def data_type_of(file_name: Column) -> Column:
    """Data type that a file name belongs to; NULL for names of no known type."""
    out = F.lit(None).cast("string")
    for data_type, pattern in reversed(fx.LOCAL_FILE_PATTERNS.items()):
        out = F.when(file_name.rlike(pattern), F.lit(data_type)).otherwise(out)
    return out


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Paths under a folder, read without touching file contents. Empty files do not count."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select("path", F.substring_index("path", "/", -1).alias("file_name"), "length")


def match_files(
    files: DataFrame,
    data_type: str | None = None,
    years: Iterable[int] | None = None,
    months: Iterable[int] | None = None,
    wiki_codes: Iterable[str] | None = None,
) -> DataFrame:
    """Dump files with their type, wiki and date, filtered by what is asked for.

    Pageview files cover all wikis, so `wiki_codes` does not restrict them.
    """
    name = F.col("file_name")
    data_type_column = data_type_of(name)
    # All that the name tells is worked out once, before any filter on it.
    told = F.struct(
        data_type_column.alias("data_type"),
        F.when(data_type_column != "pageviews", file_wiki_code(name)).alias("wiki_code"),
        file_date(name).alias("dump_date"),
    )
    described = once(files, "_told", told).select(*files.columns, "_told.*")
    keep = F.col("data_type").isNotNull() if data_type is None else F.col("data_type") == data_type
    if years:
        keep = keep & F.year("dump_date").isin(list(years))
    if months:
        keep = keep & F.month("dump_date").isin(list(months))
    if wiki_codes:
        keep = keep & (F.col("wiki_code").isNull() | F.col("wiki_code").isin(list(wiki_codes)))
    return described.where(keep)


def extract_links(pages: DataFrame, html: str = "html", pattern: str = fx.HREF_PATTERN) -> DataFrame:
    """Every link target in stored HTML, one row each."""
    links = F.regexp_extract_all(F.col(html), F.lit(pattern), F.lit(1))
    return pages.select(*[c for c in pages.columns if c != html], F.explode(links).alias("href"))


def index_files(pages: DataFrame, data_type: str, html: str = "html") -> DataFrame:
    """Files of one data type that stored index pages link to."""
    return extract_links(pages, html, fx.INDEX_LINK_PATTERNS[data_type]).withColumnRenamed("href", "file_name")


def index_dates(pages: DataFrame, html: str = "html") -> DataFrame:
    """Dump dates (`YYYYMMDD`) that stored index pages link to."""
    return extract_links(pages, html, fx.INDEX_DATE_PATTERN).withColumnRenamed("href", "dump_date")


def latest_dump(files: DataFrame) -> DataFrame:
    """Newest dump date per wiki."""
    return files.where(F.col("wiki_code").isNotNull()).groupBy("wiki_code").agg(F.max("dump_date").alias("dump_date"))


def missing_files(remote: DataFrame, local: DataFrame) -> DataFrame:
    """Remote files that are not held locally."""
    return remote.join(local.select("file_name"), "file_name", "left_anti")


def all_files(local: DataFrame, remote: DataFrame) -> DataFrame:
    """Local files, then the remote ones still missing; `source_rank` gives that order."""
    return local.select("file_name", F.lit(0).alias("source_rank")).unionByName(
        missing_files(remote, local).select("file_name", F.lit(1).alias("source_rank"))
    )


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    """Batch request file: a JSON list of `{data_type, years, months, wiki_codes}`."""
    return spark.read.schema(REQUEST_DDL).option("multiLine", "true").json(path)


def expand_requests(requests: DataFrame, default_year: int) -> DataFrame:
    """One row per request, year, month and wiki.

    Years default to `default_year`, months to all twelve. Requests without wiki
    codes keep one row with a NULL wiki where files are grouped by time, and none
    where they are grouped by wiki. Wiki-based types have no year or month.
    """
    carried = [c for c in requests.columns if c not in ("years", "months", "wiki_codes")]

    def given(name: str, default: Column) -> Column:
        return F.when(F.size(F.coalesce(name, F.array())) > 0, F.col(name)).otherwise(default)

    timed = F.col("data_type").isin(*fx.TIME_BASED_TYPES)
    no_number = F.array(F.lit(None).cast("int"))
    years = F.when(timed, given("years", F.array(F.lit(default_year)))).otherwise(no_number)
    months = F.when(timed, given("months", F.sequence(F.lit(1), F.lit(12)))).otherwise(no_number)
    wikis = given("wiki_codes", F.when(timed, F.array(F.lit(None).cast("string"))))
    known = requests.where(F.col("data_type").isin(*fx.TIME_BASED_TYPES, *fx.WIKI_BASED_TYPES))
    return (
        known.select("*", F.explode(years).alias("year"))
        .select("*", F.explode(months).alias("month"))
        .select(*carried, "year", "month", F.explode(wikis).alias("wiki_code"))
    )


def month_text(year: Column, month: Column) -> Column:
    return F.concat(year.cast("string"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"))


def index_url(data_type: Column, year_month: Column, wiki_code: Column, dump_date: Column) -> Column:
    """Address of the index page that lists a period's, or a dump's, files."""
    bases = fx.BASE_URLS
    by_wiki = F.concat(
        F.replace(F.lit(bases["revisions"]), F.lit("{wiki_code}"), wiki_code), dump_date, F.lit("/")
    )
    return (
        F.when(data_type == "pageviews",
               F.concat(F.lit(bases["pageviews"]), F.substring(year_month, 1, 4), F.lit("/"), year_month, F.lit("/")))
        .when(data_type == "clickstream", F.concat(F.lit(bases["clickstream"]), year_month, F.lit("/")))
        .otherwise(by_wiki)
    )


def file_url(file_name: Column, data_type: Column, dump_date: Column, wiki_code: Column) -> Column:
    """Download address of a dump file."""
    return F.concat(
        index_url(data_type, F.date_format(dump_date, "yyyy-MM"), wiki_code, F.date_format(dump_date, "yyyyMMdd")),
        file_name,
    )
