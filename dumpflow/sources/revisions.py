"""XML revision exports: one row per `<page>`, then one row per revision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dumpflow.functions.ids import content_hash
from dumpflow.functions.text import once
from dumpflow.functions.times import file_wiki_code, parse_iso, year_month
from dumpflow.sources.lines import read_lines
from dumpflow.sources.schemas import PAGE_XML

MISSING_TIMESTAMP = "missing_timestamp"
MINOR_EDIT = "minor_edit"
BAD_TIMESTAMP = "bad_timestamp"


def read_pages(
    spark: SparkSession, paths, spread: int | None = None, recursive: bool = False, files: Column | None = None,
    main_only: bool = False,
) -> DataFrame:
    """`<page>` elements of export files as `(page, file_name, file_path)`.

    Files are text cut at `</page>`, so plain and bzip2 ones are split between
    tasks; for gzip pass `spread` to deal the pages out before parsing. `files` is
    a condition on the file name. `main_only` drops pages that say they are of
    another namespace by a test on the text, before anything is parsed.
    """
    text = read_lines(spark, paths, line_sep="</page>", spread=spread, recursive=recursive, files=files)
    # What stands before the element, as the head of the file, is no part of it; the tail of a file has none.
    whole = text.select(F.concat(F.regexp_extract("value", r"(?s)<page(?:\s[^>]*)?>.*", 0), F.lit("</page>")).alias("value"), "file_name", "file_path").where(F.length("value") > 7)
    if main_only:
        whole = main_text(whole)
    return pages_from_text(whole).select("page", "file_name", "file_path")


def main_text(rows: DataFrame) -> DataFrame:
    """Drop `<page>` elements that say they are of another namespace, by a test on the text.

    What is in doubt stays: parsing decides.
    """
    said = F.trim(F.regexp_extract("value", r"<ns>([^<]*)</ns>", 1))
    return rows.where((said == "") | (said.try_cast("int") == 0))


def pages_from_text(rows: DataFrame) -> DataFrame:
    """Same rows out of a `value` column that holds one `<page>` element each."""
    options = {"rowTag": "page", "attributePrefix": "_"}
    carried = [c for c in rows.columns if c != "value"]
    return once(rows, "page", F.from_xml("value", PAGE_XML, options)).select(*carried, "page")


def _page_columns(wiki_code: str | None) -> dict[str, Column]:
    wiki = F.coalesce(file_wiki_code(F.col("file_name")), F.lit(wiki_code))
    page_id = F.coalesce("page.id", F.lit(""))
    # No <ns> means the main namespace; one that is not a number rejects the page.
    namespace = F.coalesce(F.trim("page.ns"), F.lit("0")).try_cast("int")
    return {
        "wiki_code": wiki,
        "page_id": page_id,
        "title": F.col("page.title"),
        "namespace": namespace,
        "is_redirect": F.col("page.redirect").isNotNull(),
        "page_hash": F.sha2(F.concat_ws("-", F.coalesce(wiki, F.lit("")), page_id), 256),
    }


def page_rows(pages: DataFrame, wiki_code: str | None = None) -> DataFrame:
    """Page-level columns of every page; `skipped` marks all but main-namespace pages."""
    columns = _page_columns(wiki_code)
    return pages.select(
        *[c for c in pages.columns if c != "page"],
        *[value.alias(name) for name, value in columns.items()],
        (~F.coalesce(columns["namespace"] == 0, F.lit(False))).alias("skipped"),
        F.size(F.coalesce("page.revision", F.array())).alias("n_revisions"),
    )


def contributor_id(contributor: Column) -> Column:
    """Registered contributor's id; NULL for anonymous, deleted or missing ones."""
    given = contributor["id"].try_cast("bigint")
    return F.when(contributor["_deleted"].isNull() & (given != 0), given.cast("string"))


def contributor_kind(contributor: Column) -> Column:
    return (
        F.when(contributor.isNull(), "missing")
        .when(contributor["_deleted"] == "deleted", "deleted")
        .when(contributor_id(contributor).isNotNull(), "registered")
        .when(contributor["ip"].isNotNull(), "anonymous")
        .otherwise("missing")
    )


def classify_revisions(pages: DataFrame, wiki_code: str | None = None) -> DataFrame:
    """One row per revision of a main-namespace page; `reason` tells why one is dropped."""
    columns = _page_columns(wiki_code)
    carried = [c for c in pages.columns if c != "page"]
    # The namespace test comes before the revisions are spread into rows.
    revisions = pages.where(columns["namespace"] == 0).select(
        *carried,
        *[columns[c].alias(c) for c in ("wiki_code", "page_id", "title", "is_redirect", "page_hash")],
        F.explode("page.revision").alias("_rev"),
    )
    revisions = once(revisions, "_stamp", parse_iso(F.col("_rev.timestamp")))
    reason = (
        F.when(F.coalesce("_rev.timestamp", F.lit("")) == "", MISSING_TIMESTAMP)
        .when(F.col("_rev.minor").isNotNull(), MINOR_EDIT)
        .when(F.col("_stamp").isNull(), BAD_TIMESTAMP)
    )
    return revisions.select(
        *carried, "wiki_code", "page_id", "title", "is_redirect", "page_hash",
        F.coalesce("_rev.id", F.lit("")).alias("rev_id"),
        F.col("_stamp").alias("timestamp"),
        contributor_id(F.col("_rev.contributor")).alias("contributor_id"),
        contributor_kind(F.col("_rev.contributor")).alias("contributor_kind"),
        reason.alias("reason"),
    )


def parse_revisions(pages: DataFrame, wiki_code: str | None = None) -> DataFrame:
    """The kept rows of `classify_revisions`, with their month."""
    kept = classify_revisions(pages, wiki_code).where(F.col("reason").isNull()).drop("reason")
    return kept.withColumn("year_month", year_month(F.col("timestamp")))


def latest_revisions(pages: DataFrame, wiki_code: str | None = None) -> DataFrame:
    """Newest kept revision of every main-namespace page, by time, then by revision id.

    Each page is reduced within its own array first, so one row per page element
    is shuffled instead of one per revision.
    """
    columns = _page_columns(wiki_code)

    def entry(rev: Column) -> Column:
        return F.struct(
            parse_iso(rev["timestamp"]).alias("timestamp"),
            rev["id"].try_cast("bigint").alias("number"),
            F.coalesce(rev["id"], F.lit("")).alias("rev_id"),
            contributor_id(rev["contributor"]).alias("contributor_id"),
            contributor_kind(rev["contributor"]).alias("contributor_kind"),
        )

    kept = F.filter("page.revision", lambda rev: rev["minor"].isNull())
    entries = F.filter(F.transform(kept, entry), lambda e: e["timestamp"].isNotNull())
    per_page = once(
        pages.where(columns["namespace"] == 0).select(
            columns["wiki_code"].alias("wiki_code"), columns["page_hash"].alias("page_hash"), "page"
        ),
        "_newest", F.array_max(entries),
    ).where(F.col("_newest").isNotNull())
    newest = per_page.groupBy("wiki_code", "page_hash").agg(F.max("_newest").alias("_newest"))
    return newest.select(
        "wiki_code", "page_hash", "_newest.rev_id", "_newest.timestamp",
        "_newest.contributor_id", "_newest.contributor_kind",
    )


def revision_records(parsed: DataFrame) -> DataFrame:
    """Envelope rows of revisions."""
    return parsed.select(
        "page_hash", "year_month", "wiki_code",
        F.struct(
            F.col("page_hash").alias("hash_id"), F.col("title"), F.col("rev_id"),
            F.col("timestamp"), F.col("contributor_id"),
        ).alias("tuple_struct"),
    )


def revision_stats(pages: DataFrame, wiki_code: str | None = None) -> DataFrame:
    """Counts per wiki: pages, skipped pages, kept and skipped revisions.

    Counted inside each page's own array, so revisions are never spread into rows.
    """
    def keeps(rev: Column) -> Column:
        return rev["minor"].isNull() & parse_iso(rev["timestamp"]).isNotNull()

    columns = _page_columns(wiki_code)
    main = F.coalesce(columns["namespace"] == 0, F.lit(False))
    revs = F.coalesce("page.revision", F.array())
    per_page = pages.select(
        columns["wiki_code"].alias("wiki_code"),
        main.alias("main"),
        F.when(main, F.size(revs)).otherwise(0).alias("n"),
        F.when(main, F.size(F.filter(revs, keeps))).otherwise(0).alias("kept"),
    )
    return per_page.groupBy("wiki_code").agg(
        F.count("*").alias("pages"),
        F.count_if(~F.col("main")).alias("skipped_pages"),
        F.sum("kept").alias("revisions"),
        F.sum(F.col("n") - F.col("kept")).alias("skipped_revisions"),
    )


def last_updated(parsed: DataFrame) -> DataFrame:
    """Newest kept revision per wiki."""
    return parsed.groupBy("wiki_code").agg(F.max("timestamp").alias("last_updated"))


def document_records(pages: DataFrame, wiki_code: str | None = None) -> DataFrame:
    """Envelope rows of page documents: title, redirect flag and newest kept revision."""
    columns = _page_columns(wiki_code)
    newest = F.array_max(F.transform(F.coalesce("page.revision", F.array()), lambda r: parse_iso(r["timestamp"])))
    rows = pages.where(columns["namespace"] == 0).select(
        *[columns[c].alias(c) for c in ("wiki_code", "page_id", "title", "is_redirect", "page_hash")],
        newest.alias("timestamp"),
    )
    return rows.select(
        "page_hash", year_month(F.col("timestamp")).alias("year_month"), "wiki_code",
        F.struct(
            "title", "timestamp", "is_redirect",
            content_hash(F.col("wiki_code"), F.col("page_id")).alias("hash_id"),
            F.col("timestamp").alias("last_updated"),
        ).alias("tuple_struct"),
    )
