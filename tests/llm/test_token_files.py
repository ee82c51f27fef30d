from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from dumpflow.llm import token_files

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


@settings(deadline=None, max_examples=300)
@given(st.text(max_size=80))
def test_words_make_the_same_ids(text):
    encode = test_words_make_the_same_ids.__dict__.setdefault("encode", token_files.WordEncoder(PATH))
    ids = np.frombuffer(encode([text.encode()])[0], encode.dtype)
    assert ids.tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_special_strings_and_memory(monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED", 3)
    encode = token_files.WordEncoder(PATH)
    texts = ["a <|endoftext|>b c", "ΑΣ ΑΣΑ Σ", "é ́x", "don't 1st", "q" * 200] * 3
    for text in texts:
        assert np.frombuffer(encode([text.encode()])[0], encode.dtype).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("parts", [1, 5])
def test_files_hold_all_documents(documents, tmp_path, parts):
    docs = documents()
    manifest = token_files.write_tokens(docs, f"{tmp_path}/t", PATH, 1, parts)
    dtype = token_files.dtype_of(PATH)
    assert dtype == "<u2"
    rows = sorted(token_files.read_tokens(manifest, f"{tmp_path}/t", dtype).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((r.doc_id for r in docs.collect()), key=lambda i: (i is not None, i or 0))
    texts = {r.doc_id: r.text for r in docs.collect()}
    at = 0
    for r in rows:
        ids = [*LIBRARY.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 1]
        assert r.start == at and np.frombuffer(r.ids, "<u4").tolist() == ids
        at += len(ids)
    # The files themselves: one run of numbers a part, offsets one more than documents.
    for part in manifest.collect():
        ids, offsets = token_files.open_part(f"{tmp_path}/t", part["name"], dtype)
        assert isinstance(ids, np.memmap) or not len(ids)
        assert (len(ids), len(offsets), offsets[-1]) == (part.n_tokens, part.n_docs + 1, part.n_tokens)


def test_digests(documents, tmp_path):
    out = token_files.as_written(documents([(7, "a b", None, None, None), (3, None, None, None, None)]), f"{tmp_path}/t", PATH, 1).collect()
    ids = [*LIBRARY.encode("a b").ids, 1]
    crc = lambda x: zlib.crc32(np.array(x, "<u4").tobytes())
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in out) == [(3, 0, 1, crc([1])), (7, 1, len(ids), crc(ids))]


def test_no_documents(documents, tmp_path):
    assert token_files.as_written(documents([]), f"{tmp_path}/t", PATH, 1).count() == 0
