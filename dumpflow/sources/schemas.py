"""Record schemas. Ids and counts are BIGINT because page ids and sums outgrow INT."""

from __future__ import annotations

from pyspark.sql import types as T

_LINK = (
    "year_month string, tuple_struct struct<pl_from: bigint, pl_from_namespace: int, "
    "pl_target_id: bigint, timestamp: timestamp>"
)

SCHEMAS: dict[str, str] = {
    "PageView": (
        "page_hash string, year_month string, tuple_struct struct<access_type: int, "
        "user_type: int, date: date, views: bigint>"
    ),
    "ClickStream": (
        "page_hash string, year_month string, tuple_struct struct<target_page: string, "
        "date: date, clicks: bigint, navigation_type: string, referer_category: string>"
    ),
    "OutboundPageLinks": _LINK,
    "InboundPageLinks": _LINK,
    "RevisionData": (
        "page_hash string, year_month string, tuple_struct struct<hash_id: string, "
        "rev_id: string, timestamp: timestamp, contributor_id: string>"
    ),
    "WikiDocument": (
        "page_hash string, year_month string, wiki_code string, tuple_struct struct<"
        "title: string, timestamp: timestamp, is_redirect: boolean, hash_id: string, "
        "last_updated: timestamp>"
    ),
    "PageInfo": (
        "page_hash string, year_month string, tuple_struct struct<page_id: bigint, "
        "page_namespace: int, page_title: string, page_is_redirect: int, "
        "page_touched: timestamp>"
    ),
}


def schema_of(name: str) -> T.StructType:
    """A record schema as a type; needs a running session."""
    return T.StructType.fromDDL(SCHEMAS[name])


# One row per <page> of a revision export. Numbers stay text so that a bad one
# rejects its own row only.
PAGE_XML = (
    "title string, ns string, id string, redirect struct<_title: string>, "
    "revision array<struct<id: string, timestamp: string, minor: string, "
    "contributor: struct<_deleted: string, id: string, username: string, ip: string>>>"
)
PAGE_XML_FIELDS = ("title", "ns", "id", "redirect", "revision")
