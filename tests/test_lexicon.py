"""Fuzzy matching by segments against brute force, and what it costs."""

import random
from difflib import SequenceMatcher

import pandas as pd
import pytest
from pyspark.sql import functions as F

from glossaflow.functions import similarity
from glossaflow.operators import lexicon


def similar(a, b):
    return 1.0 if a == b else SequenceMatcher(None, a, b).ratio()


def brute(tokens, words, threshold):
    out = {}
    for t in tokens:
        near = [(-similar(t, w), -f, w) for w, f in words.items() if abs(len(t) - len(w)) <= 2 and 2 * min(len(t), len(w)) / (len(t) + len(w)) >= threshold]
        if near and -min(near)[0] >= threshold:
            out[t] = (min(near)[2], round(-min(near)[0], 9))
    return out


def made(letters, n, longest, seed):
    """Words of all lengths, and variants of them by some edits."""
    rng = random.Random(seed)
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(1, longest))) for _ in range(n)}
    tokens = set()
    for w in sorted(words):
        t = list(w)
        for _ in range(rng.randint(1, 1 + len(w) // 7)):
            i = rng.randrange(len(t) + 1)
            kind = rng.randrange(4)
            if kind == 0:
                t.insert(i, rng.choice(letters))
            elif kind == 1 and len(t) > 1:
                t.pop(min(i, len(t) - 1))
            elif kind == 2 and t:
                t[min(i, len(t) - 1)] = rng.choice(letters)
            elif len(t) > 1:
                i = min(i, len(t) - 2)
                t[i], t[i + 1] = t[i + 1], t[i]
        tokens.add("".join(t))
    return sorted(tokens), {w: rng.randint(1, 3) for w in sorted(words)}


@pytest.mark.parametrize("letters, n, longest, threshold", [("abcdefghijklmnopqrstuvwxyz", 2000, 60, 0.85), ("ab", 300, 14, 0.85), ("كتابمدرسة", 400, 70, 0.8)])
def test_segments_lose_nothing(spark, letters, n, longest, threshold):
    tokens, words = made(letters, n, longest, 1)
    got = lexicon.nearest_words(spark.createDataFrame([(t,) for t in tokens], "token string"), spark.createDataFrame(list(words.items()), "word string, freq long"), threshold).collect()
    assert {r["token"]: (r["word"], round(r["similarity"], 9)) for r in got} == brute(tokens, words, threshold)


def test_keys_are_few():
    ours, theirs = lexicon.segment_plan(lexicon.THRESHOLD, lexicon.LENGTH_GAP)
    keys = lambda plan, n: sum(row[0] == n for row in plan)
    assert all(keys(ours, n) <= 40 for n in range(1, 13)) and all(keys(theirs, n) <= 40 for n in range(1, 31))
    # The plan is of fixed size, and long words have keys in the hundreds.
    assert len(ours) < 20_000 and max(keys(ours, n) for n in range(1, 64)) < 1000


def test_keys_of_ordinary_words_are_nearly_whole():
    """Segments of two or three letters are met by words that are not near, the
    more the larger the lexicon is."""
    for plan in lexicon._plans(lexicon.THRESHOLD, lexicon.LENGTH_GAP):
        assert all(row[0] - sum(row[5::2]) <= lexicon.MOST_LESS for row in plan if row[0] < 17)
        assert max(sum(row[0] == n for row in plan) for n in range(1, 17)) <= 700 and len(plan) < 40_000


def test_ratios_of_many_pairs_are_the_exact_ones():
    words, tokens = [], []
    for letters, n in (("ab", 12), ("abcdefgh", 30), ("كتابمدرسة😀", 80)):
        found, known = made(letters, 60, n, 2)
        known = [*known, ""]
        tokens += found
        words += [known[i % len(known)] for i in range(len(found))]
    exact = [SequenceMatcher(None, t, w, autojunk=False).ratio() if t and w else 0.0 for t, w in zip(tokens, words, strict=True)]
    assert list(similarity.ratios(pd.Series(tokens), pd.Series(words))) == exact


def test_only_changes_are_joined_back(spark):
    lex = spark.createDataFrame([("english", "dictionary", 5), ("arabic", "مدرسة", 5)], "lang string, word string, freq long")
    tokens = spark.createDataFrame([(t,) for t in ("dictionari", "dictionary", "other", "xy")], "token string")
    assert [tuple(r) for r in lexicon.corrections(tokens, lex.where("lang = 'english'")).collect()] == [("dictionari", "dictionary")]
    texts = spark.createDataFrame([(1, " dictionari  and dictionari "), (2, None), (3, "none here"), (4, "")], "k long, text string")
    got = {r["k"]: r["text"] for r in lexicon.correct_text(texts, lex, ["k"]).collect()}
    assert got == {1: "dictionary and dictionary", 2: "", 3: "none here", 4: ""}


def test_a_long_text_with_many_changes(spark):
    """Each of a text's changes was looked for by going through all of them."""
    words = [f"{i:04d}" + "abcdefghij"[i % 10] * 12 for i in range(400)]
    lex = spark.createDataFrame([("english", w, 1) for w in words], "lang string, word string, freq long")
    texts = spark.createDataFrame([(1, "\n".join(w + "x" for w in words))], "k long, text string")
    fixed = lexicon.correct_text(texts, lex, ["k"])
    assert "try_element_at" not in fixed._jdf.queryExecution().optimizedPlan().toString()
    assert fixed.first()["text"] == " ".join(words)


def test_keys_of_edits_are_not_broadcast(spark):
    tokens, words = spark.createDataFrame([("cats",), ("dg",)], "token string"), spark.createDataFrame([("cat", 9), ("dog", 3), ("dig", 3)], "word string, freq long")
    found = lexicon.nearest_by_edits(tokens, words)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, found.collect())) == [("cats", "cat", 1), ("dg", "dig", 1)]


def test_keys_that_meet_nothing_are_not_dealt_out(spark):
    """All keys of all tokens were shuffled, and hardly any is one of a word."""
    rows = spark.range(100_000).select("id", F.xxhash64("id").alias("key"))
    keys = rows.where("id % 100 = 7").select("key")
    for count in (1000, 5000, 3_000_000):
        left = lexicon.may_meet(rows, F.col("key"), keys, count)
        assert left.columns == ["id", "key"] and left.where("id % 100 = 7").count() == 1000
        assert left.count() < 5000
    assert lexicon.may_meet(rows, F.col("key"), keys.limit(0), 0).count() == 0


@pytest.mark.parametrize("letters, n, longest, threshold", [("abcdefghijklmnopqrstuvwxyz", 800, 60, 0.85), ("ab", 300, 14, 0.85), ("كتابمدرسة", 300, 70, 0.8)])
def test_a_bitmap_loses_nothing(spark, monkeypatch, letters, n, longest, threshold):
    monkeypatch.setattr(lexicon, "BROADCAST_BYTES", -1)
    tokens, words = made(letters, n, longest, 3)
    lex = spark.createDataFrame(list(words.items()), "word string, freq long")
    frame = spark.createDataFrame([(t,) for t in tokens], "token string")
    wanted = brute(tokens, words, threshold)
    assert {r["token"]: (r["word"], round(r["similarity"], 9)) for r in lexicon.nearest_words(frame, lex, threshold).collect()} == wanted
    fixes = {t: w for t, (w, _) in wanted.items() if t not in words and len(t) >= lexicon.LEAST["english"]}
    texts = spark.createDataFrame([(i, f" {t}\t{t} {t} ") for i, t in enumerate(tokens)] + [(-1, None)], "k long, text string")
    got = {r["k"]: r["text"] for r in lexicon.correct_text(texts, lex.select(F.lit("english").alias("lang"), "*"), ["k"], threshold=threshold).collect()}
    assert got == {i: " ".join([fixes.get(t, t)] * 3) for i, t in enumerate(tokens)} | {-1: ""}


def test_pairs_meet_by_as_many_letters_as_may_differ(spark):
    """Words with two letters changed met where only one may be."""
    pair = spark.createDataFrame([("abcdefgh",)], "token string"), spark.createDataFrame([("abXdeXgh", 1), ("abcdefgX", 1)], "word string, freq long")
    assert [r["word"] for r in lexicon.candidates(*pair).collect()] == ["abcdefgX"]
