"""Facts of page documents out of parsed rows, for each kind of dump.

Views and clicks are keyed by a page's title hash, revisions, links and rows of
the page table by the hash of its id. `by_title` brings all to the title hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dumpflow import fixed_values as fx
from dumpflow.functions.ids import content_hash, normalize_wiki_code
from dumpflow.functions.times import year_month
from dumpflow.operators.links import INBOUND, OUTBOUND, mirror_links
from dumpflow.operators.pages import FACT_COLUMNS, PAGE_KEY, element_counts, page_facts
from dumpflow.operators.records import struct_json
from dumpflow.sources.clickstream import clickstream_records
from dumpflow.sources.pageviews import pageview_records
from dumpflow.sources.revisions import revision_records


def view_facts(rows: DataFrame) -> DataFrame:
    """Views and titles of lines that have a title, under the wiki code that dumps use."""
    titled = rows.where(F.col("title").isNotNull()).withColumn("domain", normalize_wiki_code(F.col("domain")))
    elements = {fx.PAGEVIEWS: struct_json(F.col("tuple_struct")), fx.TITLES: F.col("title")}
    return page_facts(pageview_records(titled), elements, seen_at=F.col("tuple_struct.date").cast("timestamp"))


def click_facts(rows: DataFrame) -> DataFrame:
    elements = {fx.CLICKS_IN: struct_json(F.col("tuple_struct"))}
    return page_facts(clickstream_records(rows), elements, seen_at=F.col("tuple_struct.date").cast("timestamp"))


def revision_facts(rows: DataFrame) -> DataFrame:
    dated = rows.withColumn("year_month", year_month(F.col("timestamp")))
    elements = {fx.REVISIONS: struct_json(F.col("tuple_struct"))}
    return page_facts(revision_records(dated), elements, seen_at=F.col("tuple_struct.timestamp"))


def link_facts(rows: DataFrame, page_hash: Column | None = None) -> DataFrame:
    """Both directions of distinct links, by the id of the page at hand."""
    link = struct_json(F.struct("pl_from", "pl_from_namespace", "pl_target_id", "timestamp"))
    elements = {
        fx.LINKS_OUT: F.when(F.col("direction") == OUTBOUND, link),
        fx.LINKS_IN: F.when(F.col("direction") == INBOUND, link),
    }
    page = content_hash(F.col("wiki_code"), F.col("pl_from")) if page_hash is None else page_hash
    return page_facts(mirror_links(rows), elements, seen_at=F.col("timestamp"), page_hash=page)


def title_facts(rows: DataFrame) -> DataFrame:
    """Titles of the page table."""
    page = content_hash(F.col("wiki_code"), F.col("page_id"))
    return page_facts(rows, {fx.TITLES: F.col("page_title")}, seen_at=F.col("timestamp"), page_hash=page)


def by_title(facts: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Facts under their page's title hash, with `is_known`.

    Facts of a page that the crosswalk does not have stay under the hash of its
    id, so none is lost. Views and clicks have the title hash already.
    """
    keys = crosswalk.select("wiki_code", F.col("id_hash").alias("page_hash"), "title_hash")
    titled = F.col("kind").isin(fx.PAGEVIEWS, fx.CLICKS_IN, fx.CLICKS_OUT)
    rows = facts.join(keys, ["wiki_code", "page_hash"], "left")
    return rows.select(
        *[F.coalesce("title_hash", "page_hash").alias(c) if c == "page_hash" else F.col(c) for c in FACT_COLUMNS],
        (titled | F.col("title_hash").isNotNull()).alias("is_known"),
    )


def sizes_by_title(facts: DataFrame, links: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Array sizes of every page under its title hash, with `is_known`, as the fold of `by_title` gives them.

    `links` are the `link_counts` of pages by id, in place of facts of each link. Facts are counted
    under the key they come with, told apart by a 128-bit digest, so that a row per page and title, and
    no element, meets the crosswalk. That is enough: links and revisions name their own page's id, so
    those of two pages with one title differ, and titles are counted behind the crosswalk.
    """
    digests = facts.select(*PAGE_KEY, "kind", F.unhex(F.md5("element")).alias("element")).distinct()
    title = F.when(F.col("kind") == fx.TITLES, F.col("element"))
    by_id = digests.withColumn("_title", title).groupBy(*PAGE_KEY, "_title").agg(*element_counts())
    given = {fx.LINKS_IN: "n_in", fx.LINKS_OUT: "n_out"}
    linked = links.select(
        "wiki_code", content_hash(F.col("wiki_code"), F.col("page_id")).alias("page_hash"), F.lit(None).cast("binary").alias("_title"),
        *[(F.col(given[kind]) if kind in given else F.lit(0).cast("bigint")).alias(f"n_{kind}") for kind in fx.ELEMENT_KINDS])
    keys = crosswalk.select("wiki_code", F.col("id_hash").alias("page_hash"), "title_hash")
    rows = by_id.unionByName(linked).join(keys, list(PAGE_KEY), "left")
    titled = F.greatest(*[F.col(f"n_{kind}") for kind in (fx.PAGEVIEWS, fx.CLICKS_IN, fx.CLICKS_OUT)]) > 0
    sums = [F.sum(f"n_{kind}").alias(f"n_{kind}") for kind in fx.ELEMENT_KINDS if kind != fx.TITLES]
    known = F.max("is_known").alias("is_known")
    named = rows.withColumns({"page_hash": F.coalesce("title_hash", "page_hash"), "is_known": titled | F.col("title_hash").isNotNull()})
    per_title = named.groupBy(*PAGE_KEY, "_title").agg(*sums, known)
    return per_title.groupBy(*PAGE_KEY).agg(*sums, F.count("_title").alias(f"n_{fx.TITLES}"), known)
