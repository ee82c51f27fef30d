"""Link graph: edges in both directions, degrees and the title-to-id crosswalk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dumpflow.functions.ids import content_hash, page_identifier
from dumpflow.sources.lines import tasks_for

OUTBOUND = "outbound"
INBOUND = "inbound"


def mirror_links(links: DataFrame) -> DataFrame:
    """Every edge twice: as it is (outbound) and with its ends swapped (inbound).

    The namespace stays that of the source page in both, since dumps do not give
    the target's.
    """
    carried = [c for c in links.columns if c not in ("pl_from", "pl_from_namespace", "pl_target_id")]
    both = F.array(
        F.struct(F.lit(OUTBOUND).alias("direction"), F.col("pl_from"), F.col("pl_from_namespace"), F.col("pl_target_id")),
        F.struct(F.lit(INBOUND).alias("direction"), F.col("pl_target_id").alias("pl_from"),
                 F.col("pl_from_namespace"), F.col("pl_from").alias("pl_target_id")),
    )
    return links.select(*carried, F.inline(both))


def distinct_edges(links: DataFrame) -> DataFrame:
    """Each edge once. The number of tasks follows the input's size, so the edges that one task holds do not grow."""
    edges = links.select("wiki_code", "pl_from", "pl_from_namespace", "pl_target_id", "timestamp")
    return edges.repartition(tasks_for(edges, 1_000_000), *edges.columns).distinct()


def link_degrees(links: DataFrame) -> DataFrame:
    """Distinct links per wiki, page and direction.

    Equal edges are dropped before they are mirrored, so the wide shuffle carries
    each edge once. The counts are then summed map-side, whatever a hub's degree.
    """
    edges = distinct_edges(links)
    return (
        mirror_links(edges)
        .groupBy("wiki_code", F.col("pl_from").alias("page_id"), "direction")
        .agg(F.count("*").alias("n_links"))
    )


def link_counts(links: DataFrame) -> DataFrame:
    """Distinct inbound and outbound links per page, in one aggregation over mirrored edges."""
    edges = distinct_edges(links)
    return mirror_links(edges).groupBy("wiki_code", F.col("pl_from").alias("page_id")).agg(
        F.count_if(F.col("direction") == INBOUND).alias("n_in"), F.count_if(F.col("direction") == OUTBOUND).alias("n_out"))


def page_crosswalk(pages: DataFrame) -> DataFrame:
    """Both identifiers of every page, from rows of the `page` table.

    Views and clicks are keyed by `title_hash`, revisions by `id_hash`, links by
    `page_id`. Several dumps may hold a page; its last title counts.
    """
    latest = pages.groupBy("wiki_code", "page_id").agg(
        F.max_by("page_title", F.struct("timestamp", "page_touched", "page_title")).alias("title")
    )
    return latest.select(
        "wiki_code", "page_id", "title",
        page_identifier(F.col("wiki_code"), F.col("title")).alias("title_hash"),
        content_hash(F.col("wiki_code"), F.col("page_id")).alias("id_hash"),
    )


def with_link_counts(crosswalk: DataFrame, degrees: DataFrame) -> DataFrame:
    """Crosswalk rows with the page's distinct inbound and outbound links.

    Degrees are one row per page by now, so the join has no hot keys.
    """
    wide = degrees.groupBy("wiki_code", "page_id").agg(
        F.sum(F.when(F.col("direction") == INBOUND, F.col("n_links"))).alias("n_in"),
        F.sum(F.when(F.col("direction") == OUTBOUND, F.col("n_links"))).alias("n_out"),
    )
    return with_counts(crosswalk, wide)


def with_counts(crosswalk: DataFrame, counts: DataFrame) -> DataFrame:
    """Crosswalk rows with the `link_counts` of their page, 0 where it has none."""
    zero = F.lit(0).cast("bigint")
    return crosswalk.join(counts, ["wiki_code", "page_id"], "left").withColumns(
        {"n_in": F.coalesce("n_in", zero), "n_out": F.coalesce("n_out", zero)}
    )


def title_spans(pages: DataFrame) -> DataFrame:
    """When a page held a title: wiki_code, title, page_id, valid_from, valid_to (exclusive), no two at once.

    A page holds a title from the dump that first shows it until the dump that
    shows another one of the page, or another page with the title; else for ever
    (NULL). Of pages that take a title in one dump the one with the smallest id
    does. The first page that held a title held it since ever (NULL). The
    windows sort the dumps of one page, and the holders of one title.
    """
    dumps = pages.groupBy("wiki_code", "page_id", "timestamp").agg(
        F.max_by("page_title", F.struct("page_touched", "page_title")).alias("title"))
    of_page = Window.partitionBy("wiki_code", "page_id").orderBy("timestamp")
    shown = dumps.select("*", F.lag("title").over(of_page).alias("_before"))
    taken = shown.where(~F.col("title").eqNullSafe(F.col("_before"))).withColumn("_left", F.lead("timestamp").over(of_page))
    holders = taken.where(F.col("title").isNotNull()).groupBy("wiki_code", "title", "timestamp").agg(
        F.min(F.struct("page_id", "_left")).alias("_holder"))
    of_title = Window.partitionBy("wiki_code", "title").orderBy("timestamp")
    return holders.select(
        "wiki_code", "title", "_holder.page_id",
        F.when(F.lag("timestamp").over(of_title).isNotNull(), F.col("timestamp")).alias("valid_from"),
        F.least("_holder._left", F.lead("timestamp").over(of_title)).alias("valid_to"),
    )


def _period(at: Column, months: int) -> Column:
    return F.floor((F.year(at) * 12 + F.month(at) - 1) / months).cast("int")


def join_as_of(rows: DataFrame, spans: DataFrame, at: str, months: int = 12) -> DataFrame:
    """`rows` (wiki_code, title, a time `at`) with the page that held the title then, as `page_id`.

    NULL where none did, and where a row has no title or time. Both sides meet
    by title and period of `months`: a span stands in each period that it reaches
    into, so a row meets the holders of its own period only, however often a title
    changed hands. Times before the first and after the last change of any title
    fall into these changes' periods, so spans without an end stay few. A hot title
    meets a few rows, and adaptive execution splits it.
    """
    first, last = spans.agg(F.min(F.least("valid_from", "valid_to")), F.max(F.greatest("valid_from", "valid_to"))).first()
    low, high = (F.lit(0 if t is None else (t.year * 12 + t.month - 1) // months) for t in (first, last))
    by_period = spans.select(
        F.struct("wiki_code", "title", "page_id", F.col("valid_from").alias("since"), F.col("valid_to").alias("until")).alias("_span"),
        F.explode(F.sequence(F.coalesce(_period(F.col("valid_from"), months), low), F.coalesce(_period(F.col("valid_to"), months), high))).alias("_of"),
    ).select("_of", F.col("_span.wiki_code").alias("_wiki"), F.col("_span.title").alias("_title"), "_span.since", "_span.until", F.col("_span.page_id").alias("_page"))
    kept = [c for c in rows.columns if c != "page_id"]
    time = F.col(at)
    dated = rows.select(*[F.col(c).alias(f"_row_{c}") for c in kept], F.when(time.isNotNull(), F.least(F.greatest(_period(time, months), low), high)).alias("_period"))
    when = F.col(f"_row_{at}")
    met = (F.col("_row_wiki_code") == F.col("_wiki")) & (F.col("_row_title") == F.col("_title")) & (F.col("_period") == F.col("_of"))
    held = F.coalesce(when >= F.col("since"), F.lit(True)) & F.coalesce(when < F.col("until"), F.lit(True))
    return dated.join(by_period, met & held, "left").select(*[F.col(f"_row_{c}").alias(c) for c in kept], F.col("_page").alias("page_id"))
