"""Page identifiers, content hashes and wiki codes as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def url_quote(text: Column) -> Column:
    """RFC 3986 percent-encoding of UTF-8 text with '/' left as it is."""
    quoted = F.url_encode(text)
    for found, wanted in (("+", "%20"), ("*", "%2A"), ("%2F", "/"), ("%7E", "~")):
        quoted = F.replace(quoted, F.lit(found), F.lit(wanted))
    return quoted


def page_identifier(wiki_code: Column, title: Column) -> Column:
    """22-character URL-safe identifier of a titled page in one wiki."""
    digest = F.unhex(F.sha2(F.concat(wiki_code, F.lit(":"), url_quote(title)), 256))
    return F.substring(F.translate(F.base64(digest), "+/", "-_"), 1, 22)


def _joined_hash(*parts: Column) -> Column:
    filled = F.lit(True)
    for part in parts:
        filled = filled & part.isNotNull() & (part != "")
    return F.when(filled, F.sha2(F.concat_ws("-", *parts), 256))


def content_hash(wiki_code: Column, content_id: Column) -> Column:
    """Hex SHA-256 of wiki and id; NULL if either is empty."""
    return _joined_hash(wiki_code, content_id.cast("string"))


def document_hash(wiki_code: Column, doc_id: Column, stamp: Column) -> Column:
    """Hex SHA-256 of wiki, id and time stamp; NULL if any is empty."""
    return _joined_hash(wiki_code, doc_id.cast("string"), stamp)


def short_hash(text: Column, length: int = 8) -> Column:
    """Leading hex digits of a SHA-256, 32 at most."""
    return F.substring(F.sha2(text, 256), 1, min(length, 32))


def key_text(*parts: Column) -> Column:
    """Parts joined by a pipe; a NULL part is written as the word None."""
    return F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("None")) for p in parts))


def normalize_wiki_code(domain: Column) -> Column:
    """Turn a pageview domain (en.wikipedia, en.m.wikipedia) into a dump code (enwiki).

    Text that is not a domain is returned unchanged, so dump codes pass through.
    """
    plain = F.regexp_replace(domain, r"\.m\.", ".")
    language = F.translate(F.regexp_extract(plain, r"^([a-z-]+)\.", 1), "-", "_")
    project = F.regexp_extract(plain, r"^[a-z-]+\.([a-z]+)$", 1)
    return (
        F.when(plain.rlike(r"^(www\.)?wikidata$"), F.lit("wikidatawiki"))
        .when(project.isin("wikipedia", "wikimedia"), F.concat(language, F.lit("wiki")))
        .when(project != "", F.concat(language, project))
        .otherwise(domain)
    )
