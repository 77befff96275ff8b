"""Alignment against brute force over tokens, on odd texts and small tiers."""

import hashlib
from collections import Counter

import pytest

from glossaflow.llm import alignment
from glossaflow.llm.token_counts import default_path

A, B = default_path(), default_path("piece_bpe_32k.model")


def spans(side, text):
    """(id, start, end) by the libraries, or none."""
    if not text:
        return []
    if side == "a":
        from tokenizers import Tokenizer
        from tokenizers.decoders import ByteLevel

        tokenizer = Tokenizer.from_file(A)
        tokenizer.encode_special_tokens = True
        ids = tokenizer.encode(" " + text, add_special_tokens=False).ids
        letters = alignment.byte_alphabet()
        bodies = [bytes(letters[c] for c in tokenizer.id_to_token(i)) for i in ids]
        assert ByteLevel().decode([tokenizer.id_to_token(i) for i in ids]) == b"".join(bodies).decode("utf-8", "replace")
    else:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=B)
        ids = model.encode(text)
        bodies = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, model.id_to_piece(i)) for i in ids)]
    if b"".join(bodies) != b" " + text.encode():
        return []
    out, at = [], 0
    for i, body in zip(ids, bodies, strict=True):
        out.append((i, at, at + len(body)))
        at += len(body)
    return out


def brute(rows):
    parts, held = [], Counter()
    for name, text in rows:
        a, b = spans("a", text), spans("b", text)
        if not a or not b:
            a = b = []
        links, at = [], 0
        for i, s, e in a:
            while at < len(b) and b[at][2] <= s:
                at += 1
            j = at
            while j < len(b) and b[j][1] < e:
                links.append((i, b[j][0]))
                j += 1
        ends = sorted({e for _, _, e in a} & {e for _, _, e in b})
        starts = [0, *ends]
        within = lambda side, s, e: [str(i) for i, x, y in side if s <= x and y <= e]
        text_ = ";".join(f"{','.join(within(a, s, e))}|{','.join(within(b, s, e))}" for s, e in zip(starts, ends, strict=False)) if len(a) < 3000 else None
        parts.append((name, a, b, len(ends), links, text_))
        held.update(set(links))
    top = {}
    for (i, _), n in held.items():
        top[i] = max(top.get(i, 0), n)
    out = []
    for name, a, b, n_groups, links, text_ in parts:
        best = sum(held[p] == top[p[0]] for p in links)
        out.append((name, len(a), len(b), n_groups, len(links), best, sum(held[p] for p in links), "" if text_ == "" else text_ and hashlib.sha256(text_.encode()).hexdigest()))
    return out


def check(found, rows):
    wanted = sorted(brute(rows), key=str)
    found = sorted((tuple(r) for r in found.collect()), key=str)
    assert [f[:7] for f in found] == [w[:7] for w in wanted]
    assert all(w[7] is None or f[7] == w[7] for f, w in zip(found, wanted, strict=True))


TEXTS = [
    "The quick brown fox jumps over the lazy dog.", "The quick brown dog", "  two  spaces\tand\ttabs\n\nlines ", "naïve café über straße 東京 \U0001f600 é", "▁ marks", "<|endoftext|> <s> <0x41> </s>",
    "x" * 300, "1234567890" * 20, "it's 'tis we'll", "\x00\x01", "ﬁne ½ Å   　", "word",
]


@pytest.mark.parametrize("frequent", [1 << 18, 40, 0])
def test_equal_to_brute_force(spark, frame, frequent):
    rows = [(i, t) for i, t in enumerate(TEXTS * 3)] + [(100 + i, " ".join(TEXTS[0].split()[i % 5 :])) for i in range(40)]
    found = alignment.align(frame(rows), frequent=frequent)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    check(found, rows)


def test_odd_texts(frame, odd_texts, monkeypatch):
    monkeypatch.setattr(alignment, "COUNT_KEYS", 5)
    check(alignment.align(frame(odd_texts)), odd_texts)


def test_without_tokens_and_empty_table(frame):
    rows = [(1, None), (2, ""), (3, "a ▁ b"), (None, None)]
    assert sorted((tuple(r) for r in alignment.align(frame(rows)).collect()), key=str) == sorted([(i, 0, 0, 0, 0, 0, 0, "") for i, _ in rows], key=str)
    assert alignment.align(frame([])).collect() == []


def test_hand_made_groups():
    one, two = alignment.Side(None, [b" a", b"b", b"c", b"de"]), alignment.Side(None, [b" ", b"ab", b"cd", b"e"])
    import numpy as np

    a, b = alignment.tokens_of([np.array([0, 1, 2, 3])], one.sizes, "a"), alignment.tokens_of([np.array([0, 1, 2, 3])], two.sizes, "b")
    links = alignment.links_of(a, b)
    assert sorted(zip(links["a_id"], links["b_id"], strict=True)) == [(0, 0), (0, 1), (1, 1), (2, 2), (3, 2), (3, 3)]
    n, texts = alignment.group_texts(a, b, links, one, two, 1)
    assert (n.tolist(), texts) == ([2], ["0,1|0,1;2,3|2,3"])


def test_ranks_of_the_file_are_used_and_agree(sf_dir):
    import pandas as pd
    from tokenizers import Tokenizer

    side = alignment.byte_side(A)
    assert alignment.ranked(A, side.pieces) is not None
    texts = [t for t in pd.read_parquet(f"{sf_dir}/documents.parquet")["text"] if t][:60] + TEXTS
    tokenizer = Tokenizer.from_file(A)
    tokenizer.encode_special_tokens = True
    assert side.encode(texts) == [tokenizer.encode(f" {t}", add_special_tokens=False).ids for t in texts]
