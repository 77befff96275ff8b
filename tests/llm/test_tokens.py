"""Encoding, decoding and counting against the libraries themselves."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from glossaflow.llm import bpe, token_counts


@pytest.fixture(scope="module")
def encoding():
    return bpe.load_encoding(bpe.default_path(), bpe.default_pattern())


@pytest.fixture(scope="module")
def counter():
    path = token_counts.default_path()
    return token_counts.Counter(path, bpe.default_pattern(), token_counts.frequent_lengths(path))


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \n\t'stalm1.é\u2003"), st.characters(exclude_categories=["Cs"])), max_size=200))
def test_pieces_change_nothing(text):
    encoding = bpe.load_encoding(bpe.default_path(), bpe.default_pattern())
    assert "".join(bpe.safe_chunks(text, 8)) == text
    whole = encoding.encode_ordinary(text)
    assert [i for c in bpe.safe_chunks(text, 8) for i in encoding.encode_ordinary(c)] == whole
    assert bpe.encode_text(encoding, text) == whole
    assert encoding.decode_bytes(whole) == text.encode()


def test_long_white_space_is_one_match(encoding):
    for text in ("a" + "\n" * 20_000 + "b", " " * 20_000, "a" + " " * 9_000 + "b c", "\t" * 5_000 + " x"):
        assert bpe.encode_text(encoding, text) == encoding.encode_ordinary(text)
    assert len(bpe.encode_text(encoding, "\n" * 2_000_000 + "x")) > 0


def test_round_trip_of_odd_texts(frame, odd_texts, encoding):
    docs = frame(odd_texts)
    got = bpe.digests(bpe.decode(bpe.encode(docs)))
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    rows = sorted((tuple(r) for r in got.collect()), key=str)
    expected = []
    for i, text in odd_texts:
        ids = encoding.encode_ordinary(text or "")
        expected.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert rows == sorted(expected, key=str)
    assert sorted((tuple(r) for r in bpe.digests(bpe.round_trip(docs)).collect()), key=str) == rows
    assert bpe.digests(bpe.round_trip(docs.limit(0))).count() == bpe.decode(bpe.encode(docs.limit(0))).count() == 0


def test_counts_of_odd_texts(frame, odd_texts):
    tokenizer = token_counts.load_tokenizer(token_counts.default_path())
    got = sorted((tuple(r) for r in token_counts.count_tokens(frame(odd_texts), limit=5).collect()), key=str)
    n = [len(tokenizer.encode(t or "", add_special_tokens=False).ids) for _, t in odd_texts]
    assert got == sorted(((i, len((t or "").encode()), k, k > 5) for (i, t), k in zip(odd_texts, n, strict=True)), key=str)
    assert token_counts.count_tokens(frame([(1, "a")]).limit(0)).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \n\t'stalm1.é|<>\u2003"), st.characters(exclude_categories=["Cs"])), max_size=120))
def test_counts_are_the_library_s(text):
    path = token_counts.default_path()
    if not hasattr(test_counts_are_the_library_s, "counter"):
        test_counts_are_the_library_s.counter = token_counts.Counter(path, bpe.default_pattern(), token_counts.frequent_lengths(path))
    counter = test_counts_are_the_library_s.counter
    assert counter.count(text) == len(counter.tokenizer.encode(text, add_special_tokens=False).ids)


def test_stable_characters_are_classed_as_by_the_library(counter):
    stable = re.compile(f"[{token_counts.STABLE}]")
    for cp in range(0x10000):
        if not 0xD800 <= cp < 0xE000 and stable.match(chr(cp)):
            text = f"a{chr(cp)}1{chr(cp)}.{chr(cp)} "
            assert len(counter.pieces.findall(text)) == len(counter.tokenizer.pre_tokenizer.pre_tokenize_str(text)), hex(cp)


def test_a_full_cache_changes_nothing(counter, monkeypatch):
    monkeypatch.setattr(token_counts, "CACHE_SIZE", 3)
    fresh = token_counts.Counter(token_counts.default_path(), bpe.default_pattern(), counter.table)
    for text in ("alpha betta gammma delltta", "epsilonn zetaa etaa", "alpha betta"):
        assert fresh.count(text) == counter.count(text)
