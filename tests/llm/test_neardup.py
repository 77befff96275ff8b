"""Near duplicates against brute force, groups and edge cases included."""

import random
import re

from glossaflow.llm import neardup


def shingles(text):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower))
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= 85 * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def check(frame, rows):
    got = neardup.near_duplicates(frame(rows)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute(rows)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_groups_chains_and_a_shared_passage(frame, monkeypatch):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(4000)]
    passage = rng.choices(words, k=60)
    rows, n = [], 0
    for _ in range(120):  # all share a passage, few are alike
        rows.append((n := n + 1, " ".join(rng.choices(words, k=rng.randint(20, 90)) + passage)))
    base = rng.choices(words, k=150)
    for _ in range(90):  # near copies at all distances of one text
        copy = list(base)
        for at in rng.sample(range(150), rng.randint(0, 9)):
            copy[at] = rng.choice(words)
        rows.append((n := n + 1, " ".join(copy).upper() if n % 3 else "\t".join(copy)))
    chain = rng.choices(words, k=100)
    for _ in range(20):  # each like the one before
        chain = chain[2:] + rng.choices(words, k=2)
        rows.append((n := n + 1, " ".join(chain)))
    rows += [(n + i, rows[130][1]) for i in range(1, 30)]
    rng.shuffle(rows)
    check(frame, rows)
    # The same with nearly all lists long and every block small.
    monkeypatch.setattr(neardup, "SHORT", 3)
    monkeypatch.setattr(neardup, "BLOCK_SHINGLES", 2_000)
    check(frame, rows)


def test_odd_texts(frame, odd_texts):
    got = sorted((tuple(r) for r in neardup.near_duplicates(frame(odd_texts)).collect()), key=str)
    assert got == sorted([(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 2, 4, True), (4, 2, 4, True), (None, 2, None, True), (5, 1, 5, True), (6, 1, 6, True), (7, 1, 7, True), (8, 1, 8, True)], key=str)
    assert neardup.near_duplicates(frame([(1, "a")]).limit(0)).count() == 0
    docs = frame([(2, "a b"), (1, "A  b"), (3, "b a"), (None, "a b")])
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "3", "None"]


def test_rows_are_dropped_not_ids(spark):
    a, b = "the first text of them all is this one here", "quite another text with words of its own to say"
    near = a + " now"

    def left(rows):
        docs = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in rows], "doc_id long, text string, component_id string, id string, doc string")
        out = neardup.keep_one(docs, percent=80)
        assert out.columns == docs.columns
        return sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)

    assert left([(1, a), (2, a), (2, b)]) == [(1, a), (2, b)]
    assert left([(1, a), (1, a)]) == [(1, a)]
    assert left([(1, a), (1, a), (2, near), (2, b), (2, b), (3, near)]) == [(1, a), (2, b)]
    assert len(left([(1, a), (1, near), (2, a)])) == 1
    assert left([(None, a), (1, a), (None, a), (2, None), (2, None)]) == sorted([(None, a), (None, a), (1, a), (2, None), (2, None)], key=str)


def test_the_threshold_is_a_parameter(spark, frame):
    import corpus_pipeline

    rng, words, rows = random.Random(5), [f"w{i}" for i in range(4000)], []
    for k in range(40):  # pairs that share 80 to 84 of 100 shingles
        own = rng.choices(words, k=104 - (k % 4))
        rows += [(2 * k, " ".join(own)), (2 * k + 1, " ".join(own[: len(own) - 10] + rng.choices(words, k=10)))]
    near = [len(a & b) / len(a | b) for a, b in ((shingles(rows[i][1]), shingles(rows[i + 1][1])) for i in range(0, 80, 2))]
    assert 0.8 <= min(near) and max(near) < 0.85
    docs = frame(rows)
    assert neardup.keep_one(docs).count() == 80
    assert {r["doc_id"] for r in corpus_pipeline.drop_copies(spark, docs, "").collect()} == set(range(0, 80, 2))
    assert (neardup.agreeing(32, 85), neardup.agreeing(64, 85), neardup.agreeing(32, 80), neardup.agreeing(64, 80)) == (17, 40, 14, 36)
