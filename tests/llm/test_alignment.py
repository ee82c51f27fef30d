from __future__ import annotations

import random
from collections import Counter
from functools import reduce

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dumpflow.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXT = st.text(st.sampled_from("ab Z9 \n\t.,'s é漢🙂 　\x1c ▁<|>x-"), max_size=60) | st.text(max_size=40)


@pytest.fixture(scope="module")
def aligner():
    return alignment.Aligner(A, B)


def library(aligner, text):
    """Both libraries on the whole text: ids and end offsets, or None."""
    a = aligner.a.encode(" " + text, add_special_tokens=False).ids
    b = aligner.b.encode(text)
    a, b = aligner.ended(a, aligner.a_bytes, " " + text), aligner.ended(b, aligner.b_bytes, " " + text)
    return None if not text or a is None or b is None else (a, b)


def ranges(tokens):
    return list(zip(tokens[0], [0, *tokens[1]], tokens[1], strict=False))


def brute(aligner, texts):
    """All pairs of tokens by their byte ranges."""
    docs = []
    for text in texts:
        found = text and library(aligner, text)
        if not found:
            docs.append((0, 0, [], []))
            continue
        a, b = map(ranges, found)
        common = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups = []
        for start, end in zip([0, *common], common, strict=False):
            groups.append(",".join(str(i) for i, s, e in a if s >= start and e <= end) + "|" + ",".join(str(i) for i, s, e in b if s >= start and e <= end))
        links = [(i, j) for i, s, e in a for j, t, f in b if s < f and t < e]
        docs.append((len(a), len(b), groups, links))
    counts = Counter(x for d in docs for x in d[3])
    highest = {}
    for (_, j), n in counts.items():
        highest[j] = max(n, highest.get(j, 0))
    return [(n_a, n_b, len(groups), len(links), sum(counts[x] == highest[x[1]] for x in links), sum(counts[x] for x in links), ";".join(groups))
            for n_a, n_b, groups, links in docs]


@settings(deadline=None, max_examples=400)
@given(TEXT)
def test_segments_give_the_libraries_ids(text):
    aligner = alignment.aligner_of(A, B)
    parts = aligner.segments(text)
    assert "".join(parts) == " " + text
    if text:
        assert sum(aligner.tokens_a(parts), []) == aligner.a.encode(" " + text, add_special_tokens=False).ids
        assert sum(aligner.tokens_b(parts), []) == aligner.b.encode(text)


@settings(deadline=None, max_examples=200)
@given(st.lists(TEXT, min_size=1, max_size=6))
def test_segments_closed_at_once(texts):
    aligner = alignment.aligner_of(A, B)
    parts = list(dict.fromkeys(s for t in texts if t for s in aligner.segments(t)))
    if not parts:
        return
    a_lists, b_lists = aligner.tokens_a(parts), aligner.tokens_b(parts)
    want = []
    for s, a, b in zip(parts, a_lists, b_lists, strict=True):
        a, b = aligner.ended(a, aligner.a_bytes, s), aligner.ended(b, aligner.b_bytes, s)
        want.append(None if a is None or b is None else alignment.close(a, b))
    assert aligner.close_all(parts, a_lists, b_lists) == want


@settings(deadline=None, max_examples=300)
@given(TEXT, st.integers(1, 12))
def test_ranges_give_the_libraries_ids(text, size):
    aligner = alignment.aligner_of(A, B)
    parts = list(alignment.ranges_of(text, size, True))
    assert "".join(p[1] for p in parts) == "".join(p[3] for p in parts) == " " + text
    if text:
        assert sum(aligner.tokens_a([p[1] for p in parts]), []) == aligner.a.encode(" " + text, add_special_tokens=False).ids
        assert sum(aligner.tokens_b([p[3] for p in parts if p[3]]), []) == aligner.b.encode(text)


@pytest.mark.parametrize("text", ["▁ 9", "a▁ b c", "▁\n9 ▁ ▁", "x ▁"])
def test_marks_in_texts_are_spaces_to_b(aligner, text):
    want = aligner.b.encode(text)
    assert sum(aligner.tokens_b(aligner.segments(text)), []) == want
    for size in range(1, len(text) + 2):
        parts = [p[3] for p in alignment.ranges_of(text, size, True)]
        assert "".join(parts) == " " + text
        assert sum(aligner.tokens_b([p for p in parts if p]), []) == want


def random_fragments(rng):
    """Neighbouring fragments of two random rulers, cut at places of their own, and the fragment of all."""
    n = rng.randint(1, 40)
    rulers = [sorted(rng.sample(range(1, n + 1), rng.randint(1, n))) for _ in range(2)]
    pieces = []
    for ends in rulers:
        cuts = sorted(rng.randint(0, len(ends)) for _ in range(5))
        pieces.append([(list(range(a, b)), ends[a:b]) for a, b in zip([0, *cuts], [*cuts, len(ends)], strict=True)])
    return list(zip(*pieces, strict=True)), [(list(range(len(e))), e) for e in rulers]


def test_monoid():
    rng = random.Random(7)
    tried = 0
    for _ in range(3_000):
        parts, ruler = random_fragments(rng)
        fragments = [alignment.fragment_of(a, b) for a, b in parts]
        straight = reduce(alignment.combine, fragments)
        back = reduce(lambda x, y: alignment.combine(y, x), reversed(fragments))
        mid = rng.randint(1, len(fragments) - 1)
        tree = alignment.combine(reduce(alignment.combine, fragments[:mid]), reduce(alignment.combine, fragments[mid:]))
        want = alignment.fragment_of(*ruler)
        # The ranges of A and B lie near each other: tokens end together in one range or in neighbouring ones.
        overlap = any(set(parts[i][r][1]) & {e for p in parts[i + 2 :] for e in p[1 - r][1]} for i in range(len(parts)) for r in (0, 1))
        if not overlap:
            tried += 1
            assert straight == back == tree == want
    assert tried > 300


def test_long_and_short_texts(documents, aligner):
    rng = random.Random(2)
    word = lambda: rng.choice(["the", "Über", "x1", "漢字", "don't", "a-b", "🙂", "..."])
    texts = ["".join(word() + rng.choice([" ", " ", "\n", "  ", "\t", " ", ""]) for _ in range(rng.randint(0, 90))) for _ in range(60)]
    texts += [None, "", " ", "\n", " \n ", "a▁b", "<|endoftext|> <s> </s>", "z" * 700, "no▁ " * 60]
    rows = [(rng.choice([k, k, None, 3]), t, None, None, None) for k, t in enumerate(texts)]
    docs = documents(rows).withColumnRenamed("source", "groups")
    want = sorted(((r[0], *d) for r, d in zip(rows, brute(aligner, texts), strict=True)), key=str)
    for size, fan, block_bytes, shard_bytes in ((40, 2, 500, 300), (17, 3, 1, 100_000), (1 << 16, 8, 1 << 20, 1 << 20)):
        got = alignment.align(docs, A, B, size, fan, block_bytes, shard_bytes).collect()
        assert sorted(map(tuple, got), key=str) == want


def test_awkward_rows(documents, aligner):
    docs = documents().where("length(text) < 10000 or text is null")
    rows = docs.collect()
    want = sorted(((r.doc_id, *d) for r, d in zip(rows, brute(aligner, [r.text for r in rows]), strict=True)), key=str)
    assert sorted(map(tuple, alignment.align(docs, A, B).collect()), key=str) == want


def test_very_long_text(documents, aligner):
    text = "a b " * 40_000
    (row,) = alignment.align(documents([(1, text, None, None, None)]), A, B).collect()
    (a, b) = library(aligner, text)
    assert (row.n_a, row.n_b) == (len(a[0]), len(b[0]))
    assert row.groups == alignment.close(a, b).text


def test_no_documents(documents):
    assert alignment.align(documents([]), A, B).count() == 0


def test_other_tokenizers_are_not_cut(aligner):
    other = alignment.Aligner(public_tokenizers.path("word_bpe_49k.json"), B)
    assert aligner.cuts and not other.cuts
    assert other.segments("a b") == [" a b"]
    assert [p[1] for p in alignment.ranges_of("a b c", 1, False)] == [" a b c"]
