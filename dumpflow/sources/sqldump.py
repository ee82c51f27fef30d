"""SQL dump files: `INSERT INTO t VALUES (..),(..);` statements as typed rows.

A table is declared once as a `DumpTable`; parsing is the same column
expressions for every table.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dumpflow.functions.ids import page_identifier
from dumpflow.functions.text import is_blank, once
from dumpflow.functions.times import file_date_text, file_wiki_code, parse_touched, utc_timestamp
from dumpflow.sources.lines import read_lines

# Possessive repeats: plain ones recurse and overflow the stack on long values.
_QUOTED = r"'(?:[^'\\]++|\\.|'')*+'"
_TUPLE = rf"(?s)\(((?:[^()']++|{_QUOTED})*+)\)"
_FIELD = rf"(?s)\s*((?:{_QUOTED}|[^,'])++)"
INVALID_TUPLE = "invalid_tuple"


@dataclass(frozen=True)
class DumpTable:
    """A dump table: its name, its fields in order and an optional last step.

    A field is `(name, type)`, the type being bigint, int, double, string or
    stamp (14 digits); a trailing `?` allows NULL.
    """

    name: str
    fields: tuple[tuple[str, str], ...]
    post: Callable[[DataFrame], DataFrame] | None = None


def line_kind(line: Column) -> Column:
    """blank, comment or statement, for raw lines of a dump."""
    return F.when(is_blank(line), "blank").when(F.ltrim(line).startswith("--"), "comment").otherwise("statement")


def read_statements(spark: SparkSession, paths, spread: int | None = None, **options) -> DataFrame:
    """One row per statement: dumps end a statement with `;` at the end of a line."""
    return read_lines(spark, paths, line_sep=";\n", spread=spread, **options)


def _insert_values(statements: DataFrame, table: str) -> DataFrame:
    """Keep INSERT statements of one table and cut them down to their tuple list."""
    carried = [c for c in statements.columns if c != "value"]
    # The cheap substring test drops other tables before any regular expression.
    # The reader leaves a statement that ends in ";<blanks>" joined to the next.
    value, chunk = F.col("value"), F.col("_chunk")
    pieces = F.when(value.contains(";"), F.split(value, r";[ \t\r]*(?:\n|$)")).otherwise(F.array(value))
    chunks = statements.where(F.lower(value).contains(table.lower())).select(*carried, F.explode(pieces).alias("_chunk"))
    # Comment and blank lines may stand before or inside a statement; one line without a comment has neither.
    bare = F.when(chunk.contains("\n") | chunk.contains("--"),
                  F.regexp_replace(chunk, r"(?m)^[ \t\r]*(?:--[^\n]*)?(?:\n|\z)", "")).otherwise(chunk)
    head = rf"(?is)\A(?:.*?\n)??[ \t]*INSERT INTO\s+`?{table}`?(?!\w).*?VALUES\s*"
    # One search both tells the table's statements and cuts their heads off: what matches gets shorter.
    cut = once(once(chunks, "_stmt", bare), "_values", F.regexp_replace("_stmt", head, ""))
    return cut.where(F.length("_values") < F.length("_stmt")).select(*carried, "_values")


def _unquote(text: Column) -> Column:
    body = F.regexp_replace(text, r"(?s)\A'(.*)'\z", "$1")
    plain = body
    for letter, char in (("n", "\n"), ("t", "\t"), ("r", "\r"), ("0", "\0")):
        plain = F.regexp_replace(plain, rf"(?<!\\)((?:\\\\)*)\\{letter}", "$1" + char)
    # Any other escaped character, and the second of two quotes, stands for itself.
    plain = F.regexp_replace(plain, r"(?s)\\(.)|'(')", "$1$2")
    return F.when(body.contains("\\") | body.contains("'"), plain).otherwise(body)


def _typed(raw: Column, kind: str) -> Column:
    if kind == "string":
        return F.when(raw.startswith("'"), _unquote(raw))
    if kind == "stamp":
        return parse_touched(F.translate(raw, "'", ""))
    return F.trim(raw).try_cast(kind)


def classify_dump(statements: DataFrame, table: DumpTable, wiki_code: str | None = None) -> DataFrame:
    """Rows of one table with `reason` set on tuples that do not fit its fields.

    Adds `wiki_code`, `year_month` and `timestamp` from the file name. Columns
    other than `value` and the file columns pass through.
    """
    file_name = F.col("file_name")
    carried = [c for c in statements.columns if c != "value"]
    # What the file name tells is worked out once per statement, not per tuple.
    dated = once(_insert_values(statements, table.name), "_day", file_date_text(file_name))
    tuples = dated.select(
        *carried,
        (F.lit(wiki_code) if wiki_code else file_wiki_code(file_name)).alias("wiki_code"),
        F.substring("_day", 1, 7).alias("year_month"),
        utc_timestamp(F.concat("_day", F.lit("T00:00:00"))).alias("timestamp"),
        F.explode(F.regexp_extract_all("_values", F.lit(_TUPLE), F.lit(1))).alias("_tuple"),
    )
    quoted = any(kind.startswith(("string", "stamp")) for _, kind in table.fields)
    parts = F.regexp_extract_all("_tuple", F.lit(_FIELD), F.lit(1)) if quoted else F.split("_tuple", ",")
    raw = [F.get("_f", F.lit(at)) for at in range(len(table.fields))]
    typed = F.struct(*[_typed(text, kind.rstrip("?")).alias(name) for text, (name, kind) in zip(raw, table.fields)])
    # Also behind a generator: the test below must not decode every field again.
    rows = once(tuples, "_f", parts).select("*", F.inline(F.array(typed)))
    fits = F.size("_f") >= len(table.fields)
    for text, (name, kind) in zip(raw, table.fields):
        given = F.col(name).isNotNull()
        fits = fits & ((given | (F.upper(F.trim(text)) == "NULL")) if kind.endswith("?") else given)
    return rows.select(
        *carried, "wiki_code", "year_month", "timestamp", *[name for name, _ in table.fields],
        F.when(~F.coalesce(fits, F.lit(False)), INVALID_TUPLE).alias("reason"),
        F.col("_tuple").alias("tuple_text"),
    )


def parse_dump(statements: DataFrame, table: DumpTable, wiki_code: str | None = None) -> DataFrame:
    """The well-formed rows of one dump table, after the table's own last step."""
    rows = classify_dump(statements, table, wiki_code)
    rows = rows.where(F.col("reason").isNull()).drop("reason", "tuple_text")
    return table.post(rows) if table.post else rows


def _with_page_hash(rows: DataFrame) -> DataFrame:
    known = (F.col("wiki_code") != "") & (F.col("page_title") != "")
    return rows.withColumn("page_hash", F.when(known, page_identifier(F.col("wiki_code"), F.col("page_title"))))


PAGELINKS = DumpTable(
    "pagelinks",
    (("pl_from", "bigint"), ("pl_from_namespace", "int"), ("pl_target_id", "bigint")),
)

PAGE = DumpTable(
    "page",
    (
        ("page_id", "bigint"), ("page_namespace", "int"), ("page_title", "string"),
        ("page_is_redirect", "int"), ("page_is_new", "int"), ("page_random", "double"),
        ("page_touched", "stamp"), ("page_links_updated", "stamp?"), ("page_latest", "bigint"),
        ("page_len", "bigint"), ("page_content_model", "string?"), ("page_lang", "string?"),
    ),
    post=_with_page_hash,
)


def page_info_records(pages: DataFrame) -> DataFrame:
    """Envelope rows of the `page` table."""
    return pages.select(
        "page_hash", "year_month", "wiki_code", "timestamp",
        F.struct("page_id", "page_namespace", "page_title", "page_is_redirect", "page_touched").alias("tuple_struct"),
    )


def link_records(links: DataFrame) -> DataFrame:
    """Envelope rows of link edges, with their direction where it is known."""
    keep = [c for c in ("direction",) if c in links.columns]
    return links.select(
        "year_month", "wiki_code", "timestamp", *keep,
        F.struct("pl_from", "pl_from_namespace", "pl_target_id", "timestamp").alias("tuple_struct"),
    )
