"""Near-duplicate lines by an exact set-similarity join.

A line is the set of its words. It goes if an earlier line of the corpus, one
that went or not, has at least 4/5 of their joint words in common; lines without
a word stay. Lines are ordered by (doc_id, number); rows of one id, or without
one, are told apart and ordered as read.

Words are ordered by rarity. Two such sets share a word among the first
n - ceil(0.8 n) + 1 of each, so only these prefixes are joined, under a length
filter, a positional filter and one over a parity map of the words, in two halves of
64 bits, whose differing bits are at most the differing words. What passes is verified
on the words themselves.

Equal sets are one line first. A line needs one earlier match, not all of them.
So lines first meet, in rounds, a few earlier ones with the same least word hash of
their prefix, in each round by another order of hashes (over all words the least hash
is that of some frequent word, and groups are of unlike lines). A group is dealt into
`PARCEL` parcels, and each of its lines without a match yet meets the first line of
every parcel, found by an aggregate. That costs as many comparisons as there are lines,
times a constant. What is left looks for a match among all lines in the prefix join,
which is exact and takes no notice of parcels. Sets of one to three words are like
equal sets only and are in no join.

The words of a line are found once for their rarity and once for its keys, prefix and
maps, which are written; a later step reads lines again only where it verifies a pair.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dumpflow.functions.text import once
from dumpflow.llm.stages import written
from dumpflow.llm.text import LOWER, UPPER, let

#: Jaccard likeness as a fraction.
PART, WHOLE = 4, 5
#: Lines that each line meets in a round, at most, and rounds in front of the prefix join. They decide the cost, not the result.
PARCEL, ROUNDS = 32, 3
#: Cells of the tables that the driver hands to tasks, whatever the size of the corpus.
CELLS = 1 << 20
ORDERS = (0, 0x5DEECE66, 0x2545F491)
#: White space inside a line, but the space.
ODD_BLANKS = "\t\x0b\x0c\r"


def _plain_words(line: Column) -> Column:
    """The words of a line, A-Z lower-cased. Text in ASCII without odd white space, which is most, takes the fast way."""
    odd = [F.contains(line, F.lit(c)) for c in ODD_BLANKS]
    plain = (F.octet_length(line) == F.length(line)) & ~reduce(Column.__or__, odd)
    spaced = F.when(plain, F.lower(line)).otherwise(F.translate(line, UPPER + ODD_BLANKS, LOWER + " " * len(ODD_BLANKS)))
    return F.array_remove(F.split(spaced, " "), "")


def tokens_of(line: Column) -> Column:
    """Hashes of the different words, A-Z lower-cased."""
    return F.array_distinct(F.transform(_plain_words(line), lambda w: F.xxhash64(w)))


def _keys(rows: DataFrame) -> list[str]:
    """Columns that name a document: its id and, where rows of one id are told apart, its number."""
    return [c for c in ("doc_id", "__row") if c in rows.columns]


def _place(lines: DataFrame) -> Column:
    """Where a line is; places sort as lines do."""
    row = [F.col("__row").alias("row")] if "__row" in lines.columns else []
    return F.struct(F.col("doc_id").alias("doc"), *row, F.col("line_no").alias("no"))


def _lines(docs: DataFrame) -> DataFrame:
    return docs.select(*_keys(docs), F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line_no", "line"))


def keyed_lines(docs: DataFrame) -> DataFrame:
    """Lines that have a word, with two hashes of their set."""
    rows = once(_lines(docs), "t", F.sort_array(tokens_of(F.col("line")))).where(F.size("t") > 0)
    return rows.withColumns({"k": F.xxhash64("t"), "k2": F.xxhash64(F.lit(1), "t")})


def _table(cells: DataFrame, cell: str, value: Column, kind: str) -> Column:
    """Values by cell number as one array for all tasks; 0 where there is none."""
    spark = cells.sparkSession
    every = cells.groupBy(cell).agg(value.cast(kind).alias("value")).unionByName(spark.range(CELLS).select(F.col("id").alias(cell), F.lit(0).cast(kind).alias("value")))
    one = every.groupBy(cell).agg(F.max("value").alias("value")).agg(F.sort_array(F.collect_list(F.struct(cell, "value"))).alias("all"))
    return written(one.select(F.transform("all", lambda x: x["value"]).alias("all")), "line-table").scalar()


def _cell(key: Column) -> Column:
    return key.bitwiseAND(F.lit(CELLS - 1))


def rarity(docs: DataFrame) -> Column:
    """Table of word counts over all texts, in eighths of a power of two. Words share a cell by hash."""
    words = _lines(docs).select(F.explode(_plain_words(F.col("line"))).alias("w"))
    return _table(words.select(_cell(F.xxhash64("w")).alias("cell")), "cell", F.least(F.lit(127), F.round(4 * F.log2(1 + F.count("*")))), "tinyint")


def _shared(n: Column, m: Column) -> Column:
    """Fewest common words of alike sets of n and m words."""
    return F.ceil(PART * (n + m) / (PART + WHOLE))


def _prefix(t: Column, ranks: Column) -> Column:
    """The words of a prefix: rarest first, equal counts by hash. One number holds both, as numbers sort faster than structs.

    The low half of a hash names a word well enough to find candidates.
    """
    rank = lambda x: F.get(ranks, _cell(x).cast("int")).cast("bigint")
    ordered = F.sort_array(F.transform(t, lambda x: F.shiftleft(rank(x), 56).bitwiseOR(x.bitwiseAND(F.lit((1 << 56) - 1)))))
    prefix = F.slice(ordered, 1, F.size(t) - F.ceil(PART * F.size(t) / WHOLE).cast("int") + 1)
    return F.transform(prefix, lambda x: F.shiftright(F.shiftleft(x, 32), 32).cast("int"))


def described(lines: DataFrame, table: Column) -> DataFrame:
    """`lines` with size, parity maps and prefix by `rarity` in place of their words."""
    long = lambda x: F.lit(x).cast("bigint")
    at = lambda x: x.bitwiseAND(long(63)).cast("int")
    shifted = lambda bit, x: F.call_function("shiftleft", bit, at(x))
    parity = lambda bit: F.aggregate("t", long(0), lambda a, x: a.bitwiseXOR(shifted(bit(x), x)))
    rows = lines.withColumn("ranks", F.array(table)).select(
        *(c for c in lines.columns if c != "t"), F.size("t").alias("n"), parity(lambda x: long(1)).alias("bits"),
        parity(lambda x: F.shiftright(x, 6).bitwiseAND(long(1))).alias("more"), _prefix(F.col("t"), F.col("ranks")[0]).alias("prefix"))
    return rows.withColumn("bits", F.col("bits").bitwiseXOR(F.col("more")))


def distinct_sets(rows: DataFrame) -> DataFrame:
    """A row per different set of `described` lines: its first line (doc, row if numbered, no) and whether there are more."""
    facts = [c for c in ("n", "bits", "more", "prefix", "line") if c in rows.columns]
    grouped = rows.groupBy("k", "k2").agg(F.min(_place(rows)).alias("first"), (F.count("*") > 1).alias("again"), F.first(F.struct(*facts)).alias("facts"))
    return grouped.select("k", "k2", "first", "again", "facts.*")


def sets_of(lines: DataFrame, table: Column) -> DataFrame:
    """A row per different set with its text: first line, size, parity maps and prefix by `rarity`."""
    return distinct_sets(described(lines, table))


def _differing(a: str, b: str) -> Column:
    """Bits in which the parity maps differ."""
    return sum((F.bit_count(F.col(f"{a}.{c}").bitwiseXOR(F.col(f"{b}.{c}"))) for c in ("bits", "more")), F.lit(0))


def _alike_maps(a: str, b: str, n: Column | None = None, m: Column | None = None) -> Column:
    """Length filter and parity filter: both may still be alike."""
    n, m = (F.col(f"{a}.n") if n is None else n), (F.col(f"{b}.n") if m is None else m)
    return (PART * F.greatest(n, m) <= WHOLE * F.least(n, m)) & (_differing(a, b) <= n + m - 2 * _shared(n, m))


def _verified(pairs: DataFrame, sets: DataFrame, docs: DataFrame | None = None) -> DataFrame:
    """Of pairs (a, b) of set keys those that are alike, as the later set and its earlier line.

    Words come from the `line` of `sets`, or, where sets have none, from the first line of each in `docs`.
    """
    pairs = written(pairs.distinct(), "line-pairs")
    keys = pairs.select(F.explode(F.array("a", "b")).alias("k")).distinct()
    some = sets.join(keys, "k", "left_semi")
    if docs is None:
        texts = some.select("k", "k2", "first", tokens_of(F.col("line")).alias("t"))
    else:
        some = written(some.select("k", "k2", "first"), "line-wanted")
        cell = lambda place: _cell(F.xxhash64(place)).cast("int")
        # Most lines are in no pair; the table drops these before the join, which is exact.
        there = _table(some.select(cell(F.col("first")).cast("bigint").alias("cell")), "cell", F.lit(1), "tinyint")
        lines = _lines(docs)
        lines = lines.select(_place(lines).alias("at"), "line").where(F.get(there, cell(F.col("at"))) > 0)
        read = lines.join(some, F.col("at") == F.col("first")).withColumn("t", F.sort_array(tokens_of(F.col("line"))))
        # Rows that share an id share places; the keys tell whose line it is.
        texts = read.where((F.xxhash64("t") == F.col("k")) & (F.xxhash64(F.lit(1), "t") == F.col("k2"))).dropDuplicates(["k", "k2"])
    texts = texts.select("k", F.struct("k2", "first", "t").alias("s"))
    both = pairs.join(texts.toDF("a", "x"), "a").join(texts.toDF("b", "y"), "b")
    common = F.size(F.array_intersect("x.t", "y.t"))
    alike = both.where((common * (PART + WHOLE) >= PART * (F.size("x.t") + F.size("y.t"))) & (F.col("x.first") != F.col("y.first")))
    later = F.col("x.first") > F.col("y.first")
    return written(alike.select(
        F.when(later, F.col("a")).otherwise(F.col("b")).alias("k"), F.when(later, F.col("x.k2")).otherwise(F.col("y.k2")).alias("k2"),
        F.least("x.first", "y.first").alias("earlier"),
    ).groupBy("k", "k2").agg(F.min("earlier").alias("earlier")), "line-matches")


def _round(rows: DataFrame, groups: DataFrame, matched: DataFrame | None, number: int) -> DataFrame:
    """Pairs of a set without a match and an earlier one, of the first in the parcels of its group the one nearest by its maps."""
    rows = rows.where(F.col("nr") == number)
    if matched is not None:
        rows = rows.join(matched.select("k"), "k", "left_anti")
    near = rows.join(groups, ["nr", "hash"]).select("k", "first", "n", "bits", "more", F.explode("heads").alias("y")).alias("x")
    near = near.where((F.col("x.first") > F.col("y.first")) & _alike_maps("x", "y"))
    nearest = near.groupBy(F.col("x.k").alias("a")).agg(F.min(F.struct(_differing("x", "y"), F.col("y.first"), F.col("y.k").alias("b"))).alias("y"))
    return nearest.select("a", "y.b")


def _met(sets: DataFrame) -> DataFrame:
    """A row per set and order of hashes: the least one of its prefix."""
    def least(order: int) -> Column:
        # One argument: a second one, even with a default, would be the element's index.
        return F.array_min(F.transform("prefix", lambda x: x.bitwiseXOR(F.lit(order))))

    return sets.select("k", "first", "n", "bits", "more", F.posexplode(F.array(*map(least, ORDERS[:ROUNDS]))).alias("nr", "hash"))


def _groups(rows: DataFrame, parcel: int = PARCEL) -> DataFrame:
    """Groups that share a least hash, of two parcels or more: the first set of each parcel."""
    first = F.min(F.struct("first", "k", "n", "bits", "more")).alias("head")
    heads = rows.groupBy("nr", "hash", F.pmod("k", F.lit(parcel)).alias("parcel")).agg(first)
    return heads.groupBy("nr", "hash").agg(F.collect_list("head").alias("heads")).where(F.size("heads") > 1)


def _first_matches(sets: DataFrame, rounds: int = ROUNDS, parcel: int = PARCEL, docs: DataFrame | None = None) -> DataFrame:
    """Sets that are like an earlier one met in one of the rounds, with the earliest of these."""
    rows = _met(sets)
    groups = written(_groups(rows, parcel), "line-groups")
    matched = None
    for number in range(rounds):
        found = _verified(_round(rows, groups, matched, number), sets, docs)
        matched = found if matched is None else written(matched.unionByName(found), "line-first")
    return matched


def postings(sets: DataFrame, matched: DataFrame) -> DataFrame:
    """(token, k, doc, at, bits, more) of every prefix word; `at` packs size, place and whether the set looks for a match."""
    some = _table(matched.select(_cell(F.col("k")).alias("cell")), "cell", F.lit(1), "tinyint")
    maybe = F.get(some, _cell(F.col("k")).cast("int")) > 0
    rows = sets.select("k", "k2", "first", "n", "bits", "more", "prefix")
    rows = rows.where(~maybe).withColumn("open", F.lit(1)).unionByName(
        rows.where(maybe).join(matched.select("k", "k2", F.lit(0).alias("open")), ["k", "k2"], "left").withColumn("open", F.coalesce("open", F.lit(1))))
    return rows.select("k", F.coalesce("first.doc", F.lit(-(2**63))).alias("doc"), "n", "bits", "more", "open", F.posexplode("prefix").alias("place", "token")).select(
        "token", "k", "doc",
        F.shiftleft(F.col("n").cast("bigint"), 33).bitwiseOR(F.shiftleft(F.col("place").cast("bigint"), 1)).bitwiseOR(F.col("open")).alias("at"), "bits", "more")


def _candidates(posts: DataFrame) -> DataFrame:
    def side(name: str) -> dict[str, Column]:
        at = F.col(f"{name}.at")
        return {"n": F.shiftright(at, 33), "place": F.shiftright(at, 1).bitwiseAND(F.lit(0xFFFFFFFF))}

    x, y = side("x"), side("y")
    shared = _shared(x["n"], y["n"])
    may = (
        (F.col("x.token") == F.col("y.token")) & (F.col("x.k") != F.col("y.k"))
        & (F.col("y.doc") <= F.col("x.doc"))
        # Names both sides, so that it stays in the join and both sides read one shuffle.
        & (F.col("x.at").bitwiseOR(F.col("y.at").bitwiseAND(F.lit(0))).bitwiseAND(F.lit(1)) == 1)
        & (F.least(x["n"] - x["place"], y["n"] - y["place"]) >= shared)
        & _alike_maps("x", "y", x["n"], y["n"])
    )
    return posts.alias("x").join(posts.alias("y"), may).select(F.col("x.k").alias("a"), F.col("y.k").alias("b"))


def repeated_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no) of lines that go, with the earlier line (earlier_doc, earlier_no) of each.

    A NULL text is empty; a NULL doc_id sorts first. Rows that share an id share
    its lines by number: of such, one text's line is no repeat of the other's.
    With the numbers of `numbered` each row has its own lines, and its number is
    in the result.
    """
    keys = _keys(docs)
    docs = docs.select(*keys, "text")
    # The one pass over the words of all lines, besides that of their rarity.
    lines = written(described(keyed_lines(docs).drop("line"), rarity(docs)), "line-keys")
    sets = written(distinct_sets(lines), "line-sets")
    # A set of n words is like another one only if one word more is within the likeness: 4 (n + 1) <= 5 n.
    joined = sets.where(F.col("n") >= PART)
    matched = _first_matches(joined, docs=docs)
    found = _verified(_candidates(postings(joined, matched)), joined, docs)
    matches = matched.unionByName(found).groupBy("k", "k2").agg(F.min("earlier").alias("earlier"))
    losing = sets.select("k", "k2", "first", "again").join(matches, ["k", "k2"], "left").where(F.col("again") | F.col("earlier").isNotNull())
    own = lines.select(*keys, "line_no", "k", "k2", _place(lines).alias("own"))
    gone = own.join(losing, ["k", "k2"]).where((F.col("own") != F.col("first")) | F.col("earlier").isNotNull())
    earlier = F.least("earlier", "first")
    return gone.select(*keys, "line_no", earlier["doc"].alias("earlier_doc"), earlier["no"].alias("earlier_no"))


def _gone_by_document(docs: DataFrame) -> DataFrame:
    return repeated_lines(docs).groupBy(*_keys(docs)).agg(F.sort_array(F.collect_set("line_no")).alias("gone"))


def removed_by_document(docs: DataFrame) -> DataFrame:
    """A row per document: lines, lines that go, and their numbers from 0. Rows of one id have their own each."""
    docs = numbered(docs.select("doc_id", "text"))
    counts = docs.select("doc_id", "__row", F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("bigint").alias("n_lines"))
    lost = _gone_by_document(docs).withColumnsRenamed({"doc_id": "of", "__row": "nr"})
    rows = counts.join(lost, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("__row") == F.col("nr")), "left")
    gone = F.coalesce("gone", F.array().cast("array<int>"))
    return rows.select("doc_id", "n_lines", F.size(gone).cast("bigint").alias("n_removed"), F.array_join(gone.cast("array<string>"), ",").alias("removed"))


def numbered(docs: DataFrame) -> DataFrame:
    """`docs` with `__row`: no two rows have both one id and one number.

    Rows of an id that others have too, and some that share a table cell with
    such an id, are written once with their numbers, in the order read. All
    others have -1 and are not written.
    """
    again = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    cell = _cell(F.xxhash64("doc_id"))
    shared = _table(again.select(cell.alias("cell")), "cell", F.lit(1), "tinyint")
    maybe = F.get(shared, cell.cast("int")) > 0
    told = written(docs.where(maybe).withColumn("__row", F.monotonically_increasing_id()), "lines-rows", "zstd")
    return docs.where(~maybe).withColumn("__row", F.lit(-1).cast("bigint")).unionByName(told)


def without_repeats(docs: DataFrame) -> DataFrame:
    """`docs` with the repeated lines gone from `text`; a NULL text stays NULL, other columns stay.

    A document of which every line goes keeps an empty text. Each row loses its own
    lines only: rows with one id, or without one, are ordered as read. Texts that
    surely lose no line are not shuffled; a table of the other ids' cells tells them.
    """
    columns, docs = docs.columns, numbered(docs)
    gone = written(_gone_by_document(docs), "lines-gone").select(F.col("doc_id").alias("__of"), F.col("__row").alias("__nr"), F.col("gone").alias("__gone"))
    hit = _table(gone.select(_cell(F.xxhash64("__of", "__nr")).alias("cell")), "cell", F.lit(1), "tinyint")
    maybe = F.get(hit, _cell(F.xxhash64("doc_id", "__row")).cast("int")) > 0
    kept = let(F.coalesce("__gone", F.array().cast("array<int>")), lambda g: F.array_join(
        F.filter(F.split("text", "\n"), lambda line, i: ~F.array_contains(g, i)), "\n"))
    rows = docs.where(maybe).join(gone, F.col("doc_id").eqNullSafe(F.col("__of")) & (F.col("__row") == F.col("__nr")), "left")
    changed = rows.withColumn("text", F.when(F.col("__gone").isNull(), F.col("text")).otherwise(kept)).select(*columns)
    return docs.where(~maybe).select(*columns).unionByName(changed)


REMOVED_SQL = r"""
WITH d AS (SELECT *, row_number() OVER () AS r FROM documents),
l AS (
  SELECT (doc_id IS NOT NULL, coalesce(doc_id, 0), r, line_no) AS loc, r, line_no, line
  FROM (SELECT doc_id, r, unnest(generate_series(0, len(x) - 1)) AS line_no, unnest(x) AS line
        FROM (SELECT doc_id, r, string_split(coalesce(text, ''), chr(10)) AS x FROM d))),
s AS (
  SELECT loc, r, line_no, list_sort(list_distinct(regexp_extract_all(
    translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'))) AS t FROM l),
k AS (SELECT * FROM s WHERE len(t) > 0),
u AS (SELECT t, len(t) AS n, min(loc) AS first, row_number() OVER (ORDER BY min(loc)) AS id FROM k GROUP BY t),
w AS (SELECT id, n, unnest(t) AS word FROM u),
f AS (SELECT word, count(*) AS df FROM w GROUP BY word),
p AS (
  SELECT id, n, word FROM (SELECT id, n, word, row_number() OVER (PARTITION BY id ORDER BY df, word) AS place FROM w JOIN f USING (word))
  WHERE place <= n - (4 * n + 4) // 5 + 1),
c AS (
  SELECT DISTINCT a.id AS x, b.id AS y FROM p a JOIN p b ON a.word = b.word AND b.id < a.id
  WHERE 4 * greatest(a.n, b.n) <= 5 * least(a.n, b.n)),
m AS (
  SELECT DISTINCT x FROM c JOIN u a ON a.id = x JOIN u b ON b.id = y
  WHERE 9 * len(list_intersect(a.t, b.t)) >= 4 * (a.n + b.n)),
g AS (
  SELECT r, list_sort(list(line_no)) AS gone FROM k JOIN u USING (t)
  WHERE loc <> u.first OR u.id IN (SELECT x FROM m) GROUP BY r)
SELECT doc_id, CAST(len(string_split(coalesce(text, ''), chr(10))) AS BIGINT) AS n_lines,
       CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed, coalesce(array_to_string(gone, ','), '') AS removed
FROM d LEFT JOIN g USING (r)
"""
