from __future__ import annotations

import random

import pytest

from dumpflow.llm import line_dedup


def brute(rows):
    """(id, text, numbers of the lines that go) of every row; rows come in order of their ids."""
    seen, out = [], []
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        gone = []
        for no, line in enumerate((text or "").split("\n")):
            t = frozenset(line.encode().lower().split())
            if any(len(t & u) * 5 >= 4 * len(t | u) for u in seen if t):
                gone.append(no)
            seen += [t] if t else []
        out.append((i, len((text or "").split("\n")), ",".join(map(str, gone))))
    return sorted(out, key=str)


def removed(docs):
    return sorted(((r.doc_id, r.n_lines, r.removed) for r in line_dedup.removed_by_document(docs).collect()), key=str)


@pytest.fixture(scope="module")
def near_lines():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)] + ["the", "OF", "and"] * 4
    base = [[rng.choice(words) for _ in range(rng.randint(3, 30))] for _ in range(25)]
    rows = []
    for i in range(60):
        text = []
        for _ in range(4):
            line = list(rng.choice(base))
            for _ in range(rng.randint(0, 3)):
                line[rng.randrange(len(line))] = rng.choice(words)
            text.append(" ".join(line).upper() if rng.random() < 0.2 else " ".join(line))
        rows.append((i, "\n".join(text), None, None, None))
    return rows


def test_against_all_pairs(documents, near_lines):
    want = brute([(r[0], r[1]) for r in near_lines])
    assert removed(documents(near_lines)) == want
    assert sum(len(x[2].split(",")) for x in want if x[2]) > 50


def test_prefix_join_alone_finds_all(documents, near_lines, spark):
    docs = documents(near_lines).select("doc_id", "text")
    sets = line_dedup.written(line_dedup.sets_of(line_dedup.keyed_lines(docs), line_dedup.rarity(docs)).where("n >= 4"), "line-sets")
    none = spark.createDataFrame([], "k bigint, k2 bigint, earlier struct<doc: bigint, no: int>")
    found = line_dedup._verified(line_dedup._candidates(line_dedup.postings(sets, none)), sets)
    for parcel in (2, 16):
        first = line_dedup._first_matches(sets, parcel=parcel)
        assert first.count() == first.select("k", "k2").distinct().count() > 0
        assert first.select("k", "k2").subtract(found.select("k", "k2")).count() == 0


def test_rounds_grow_with_the_lines(documents, spark):
    """A group of near copies, few of them alike: comparisons are in proportion to its size."""
    def pairs(size):
        rng = random.Random(size)
        base = [f"w{i}" for i in range(20)]
        rows = []
        for i in range(size):
            line = list(base)
            for at in rng.sample(range(1, 20), 3):
                line[at] = f"x{i}_{at}"
            rows.append((i, " ".join(line), None, None, None))
        docs = documents(rows)
        sets = line_dedup.written(line_dedup.sets_of(line_dedup.keyed_lines(docs), line_dedup.rarity(docs)), "line-sets")
        hashes = line_dedup._met(sets.selectExpr("k", "first", "n", "0L AS bits", "0L AS more", "array(1) AS prefix"))
        return line_dedup._round(hashes, line_dedup._groups(hashes), None, 0).count()

    assert 0 < pairs(1200) < 6 * pairs(300)


def test_awkward_rows(documents):
    docs = documents().orderBy("doc_id").coalesce(1)
    got = removed(docs)
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert len(got) == docs.count()
    assert [g for g in got if g[0] in (300, 301, 302)] == [(300, 1, ""), (301, 1, ""), (302, 2, "")]


def test_rows_without_id_are_told_apart(documents):
    rows = [(None, f"only here {i}\none line that all of them have", None, None, None) for i in range(1000)]
    got = removed(documents(rows).coalesce(1))
    assert [g[2] for g in got].count("") == 1 and [g[2] for g in got].count("1") == 999


def test_texts_after_removal(documents, spark):
    line = "one two three four five"
    docs = documents([(1, f"{line}\nshort", None, None, None), (2, f"a\n{line} \nb", None, None, 9), (3, None, "x", None, None)])
    docs = docs.withColumns({"line": docs.lang, "k": docs.n_chars, "gone": docs.lang})
    out = {r.doc_id: r for r in line_dedup.without_repeats(docs).collect()}
    assert (out[1].text, out[2].text, out[3].text) == (f"{line}\nshort", "a\nb", None)
    assert list(out[2].asDict()) == docs.columns and out[2].k == 9
    assert line_dedup.without_repeats(documents([])).count() == 0
    assert line_dedup.removed_by_document(documents([])).count() == 0


def test_rows_of_one_id_lose_their_own_lines(documents):
    """Rows without an id or with a repeated one: a line goes by its own row, and repeats in a later row are found."""
    a, b, c, d, e = (" ".join(f"{x}{i}" for i in range(6)) for x in "abcde")
    for i in (None, 7):
        docs = documents([(i, f"{a}\n{b}", "1", None, None), (i, f"{c}\n{a}", "2", None, None), (i, f"{a}\n{d}", "3", None, None), (9, f"{e}\n{b}", "4", None, None)]).coalesce(1)
        assert {r.lang: r.text for r in line_dedup.without_repeats(docs).collect()} == {"1": f"{a}\n{b}", "2": c, "3": d, "4": e}


def test_short_lines_are_joined_too(documents):
    """From one different word on, against all pairs of lines."""
    rng = random.Random(8)
    rows = [(i, "\n".join(" ".join(rng.choice("abcdefgh") for _ in range(rng.choice((0, 1, 1, 2, 3, 4, 5, 6, 40)))) for _ in range(5)), None, None, None) for i in range(40)]
    seen, want = [], {}
    for i, text, *_ in rows:
        kept = []
        for line in text.split("\n"):
            t = set(line.split())
            if not any(len(t & u) * 5 >= 4 * len(t | u) for u in seen if t):
                kept.append(line)
            seen += [t] if t else []
        want[i] = "\n".join(kept)
    assert {r.doc_id: r.text for r in line_dedup.without_repeats(documents(rows)).collect()} == want


def test_a_set_meets_one_line_a_round(documents):
    """In a group of near copies a round gives each set without a match one pair, and a set with one none."""
    base = [f"w{i}" for i in range(40)]
    docs = documents([(i, " ".join([*base[:-1], f"x{i}"]), None, None, None) for i in range(200)])
    sets = line_dedup.written(line_dedup.sets_of(line_dedup.keyed_lines(docs), line_dedup.rarity(docs)), "line-sets")
    rows = line_dedup._met(sets.selectExpr("k", "first", "n", "bits", "more", "array(1) AS prefix"))
    pairs = line_dedup._round(rows, line_dedup._groups(rows), None, 0)
    assert 150 < pairs.count() == pairs.select("a").distinct().count() < 200
    matched = sets.where("first.doc % 2 = 0").select("k", "k2")
    later = line_dedup._round(rows, line_dedup._groups(rows), matched, 1)
    assert 75 < later.count() <= 100 and later.join(matched, later.a == matched.k).count() == 0


def test_words_of_odd_lines(documents, spark):
    """Lines that take the fast way and others: white space of all kinds, letters beyond ASCII, empty lines."""
    lines = ["A b  C", " a\tB\x0bc\x0cD\re ", "É e\tÀ a", "İ Σ ſ A", " a B", "", "\t \r", "a" * 9 + "\x1cB"]
    got = [r.w for r in spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, line string").orderBy("i").select(line_dedup._plain_words(line_dedup.F.col("line")).alias("w")).collect()]
    assert got == [[w.decode() for w in x.encode().lower().split()] for x in lines]
