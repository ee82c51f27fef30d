from __future__ import annotations

import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dumpflow.llm import pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return pieces.Pieces(MODEL)


def brute(model, text):
    """Best path over every substring; of equal ones the longer last piece."""
    by_text = {model.piece[i]: i for i in model.score}
    best, back = [0] + [None] * len(text), [None] * (len(text) + 1)
    for end in range(1, len(text) + 1):
        for start in range(end):
            piece = by_text.get(text[start:end])
            if piece is not None:
                ids, score = [piece], model.score[piece]
            elif end - start == 1:
                ids, score = model._char(text[start])
            else:
                continue
            if best[end] is None or best[start] + score > best[end]:
                best[end], back[end] = best[start] + score, (start, ids)
    out, end = [], len(text)
    while end:
        end, ids = back[end]
        out = ids + out
    return out


def test_against_all_substrings(model):
    rng = random.Random(1)
    for _ in range(500):
        text = "".join(rng.choice("abcdeth ion  \nñ漢🙂é.\t") for _ in range(rng.randint(1, 30)))
        assert model.encode(text) == brute(model, "▁" + text.replace(" ", "▁")), text


@settings(deadline=None, max_examples=300)
@given(st.text(max_size=60))
def test_round_trip(text):
    model = test_round_trip.__dict__.setdefault("model", pieces.Pieces(MODEL))
    assert model.decode(model.encode(text)) == text


def test_frame(documents):
    docs = documents().withColumns({"ids": F.lit("clash"), "decoded": F.lit(1)})
    back = pieces.decode(pieces.encode(docs, MODEL), MODEL)
    assert set(back.columns) == set(docs.columns)
    rows = back.collect()
    assert len(rows) == docs.count()
    assert all(r.decoded == (r.text or "") for r in rows)
    assert all(not r.ids for r in rows if not r.text)
    assert pieces.encode(documents([]), MODEL).count() == 0
