"""Line dedup: templates, what stays, edge cases."""

import pytest

from glossaflow.llm import lines, neardup


def test_templates_with_fields_are_dropped_after_the_first(frame):
    own = ["alpha beta gamma delta", "quite another line here", "a third one of its own", "nothing like the others", "fifth text stands alone", "the last says something else"]
    rows = [(i + 1, f"Copyright 20{i:02d} by the makers of this site\n{own[i]}\nshort\nUpdated at {i}:3{i} by user{i} for all of our many readers") for i in range(6)]
    got = {r["doc_id"]: r for r in lines.dedup_lines(frame(rows)).collect()}
    assert got[1]["text"] == rows[0][1] and got[1]["n_dropped"] == 0
    for i in range(1, 6):
        assert got[i + 1]["text"] == f"{own[i]}\nshort"
        assert (got[i + 1]["n_lines"], got[i + 1]["n_dropped"]) == (4, 2)


def test_lines_of_few_documents_stay(frame):
    rows = [(i, "the very same line of text\nand the same again") for i in range(4)]
    assert {r["n_dropped"] for r in lines.dedup_lines(frame(rows)).collect()} == {0}
    rows.append((4, rows[0][1]))
    got = {r["doc_id"]: r["text"] for r in lines.dedup_lines(frame(rows)).collect()}
    assert got == {0: rows[0][1], 1: "", 2: "", 3: "", 4: ""}


def test_a_variant_of_the_commonest_template_goes_too(frame):
    rows = [(i, "please read our full terms of use before you go on") for i in range(6)] + [(6, "please read our full terms of service before you go on"), (7, "please read our old notes on cats and dogs and mice"), (8, "please read it")]
    got = {r["doc_id"]: r["n_dropped"] for r in lines.dedup_lines(frame(rows)).collect()}
    assert got == {0: 0, 1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 6: 1, 7: 0, 8: 0}


def test_odd_texts(frame, odd_texts):
    docs = frame(odd_texts + [(None, "one two three four five six")] * 4 + [(i, "one two three four five six") for i in (9, 10, 11, 12)])
    out = lines.dedup_lines(docs)
    assert out.columns[: len(docs.columns)] == docs.columns
    got = sorted(((r["doc_id"], r["text"], r["n_dropped"]) for r in out.collect()), key=str)
    kept = [(i, t, 0) for i, t in odd_texts if i is not None and t != "one two three four five six"]
    assert got == sorted(kept + [(4, "one two three four five six", 0)] * 2 + [(None, "", 1)] * 5 + [(i, "", 1) for i in (9, 10, 11, 12)], key=str)
    assert lines.dedup_lines(docs.limit(0)).count() == 0


def test_every_family_of_a_leaf_goes(frame):
    # Same leaf: a common family, and one whose fields take values that are
    # each in five documents or more, in combinations that are in fewer.
    rows = [(i, "please read our full terms of use before you go on") for i in range(40)]
    days, towns = [f"day{c}" for c in "abcde"], [f"town{c}" for c in "abcde"]
    rows += [(100 + i, f"please read our notes on {days[i % 5]} trips to {towns[i // 5]} by train") for i in range(25)]
    rows.append((200, "please read our notes on someday trips to elsewhere by train"))
    got = {r["doc_id"]: r["n_dropped"] for r in lines.dedup_lines(frame(rows)).collect()}
    assert got == {i: int(i not in (0, 100)) for i, _ in rows}


def test_a_variant_of_a_second_template_goes_too(frame):
    rows = [(i, "please read our full terms of use before you go on") for i in range(9)]
    rows += [(20 + i, "please read our old notes on cats and dogs and mice") for i in range(6)] + [(30, "please read our old notes on cats and dogs and rats")]
    got = {r["doc_id"]: r["n_dropped"] for r in lines.dedup_lines(frame(rows)).collect()}
    assert got == {i: int(i not in (0, 20)) for i, _ in rows}


def test_long_lines_of_two_documents_go(frame):
    passage = " ".join(f"{c}{d}" for c in "abcdef" for d in "abcdefghij")
    near, far = passage.replace("ff", "zz"), " ".join(passage.split()[:40] + [f"{c}{c}z" for c in "abcdefghijklmnopqrst"])
    more = [f"what document {c} says by itself is {c} and {c} and again {c} in so many words" for c in ("alpha", "beta", "gamma", "delta")]
    own = {i: "\n".join(f"{m} of {chr(96 + i) * 3}" for m in more) for i in (1, 2, 3)}
    rows = [(1, f"{own[1]}\n{passage}"), (2, f"{passage}\n{own[2]}"), (3, f"{near}\n{own[3]}"), (4, far), (5, " ".join(passage.split()[:49])), (6, " ".join(passage.split()[:49]))]
    got = {r["doc_id"]: r["text"] for r in lines.dedup_lines(frame(rows)).collect()}
    assert got == dict(rows) | {2: own[2], 3: own[3]}
    apart = {r["n_dropped"] for r in lines.dedup_lines(frame(rows), long=(lines.LONG_TOKENS, lines.MIN_DOCS, lines.LONG_SIMILAR)).collect()}
    assert apart == {0}


def test_constants_are_counted_by_document(frame):
    rows = [(i, "alpha beta gamma delta one of them here") for i in range(5)] + [(9, "alpha beta gamma q l m n o")]
    alone = {r["doc_id"]: r["n_dropped"] for r in lines.dedup_lines(frame(rows)).collect()}
    more = rows[:5] + [(9, "\n".join(["alpha beta gamma q l m n o"] + [f"alpha beta gamma q l m n {c}" for c in "pqrstuv"]))]
    with_more = {r["doc_id"]: r["n_dropped"] for r in lines.dedup_lines(frame(more)).collect()}
    assert alone == with_more == {0: 0, 1: 1, 2: 1, 3: 1, 4: 1, 9: 0}


def test_names_that_clash(spark):
    names = ["_id", "_hash", "_drops", "doc", "id", "text_hash", "drops", "n_lines", "leaf", "n_dropped"]
    rows = [(i, "the very same line of text", *([f"mine{i}"] * len(names))) for i in range(6)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", *names])
    out = lines.dedup_lines(docs)
    assert out.columns == docs.columns
    for r in out.collect():
        assert [r[c] for c in names if c[:2] != "n_"] == [f"mine{r['doc_id']}"] * 8
        assert (r["n_lines"], r["n_dropped"]) == (1, int(r["doc_id"] > 0))


def test_a_document_that_holds_a_line_twice_keeps_both(frame):
    rows = [(i, "this is said by all of them\nthis is said by all of them") for i in range(5)] + [(0, "another text of id zero\nthis is said by all of them")]
    got = sorted((r["doc_id"], r["n_dropped"]) for r in lines.dedup_lines(frame(rows)).collect())
    assert got == [(0, 0), (0, 0), (1, 2), (2, 2), (3, 2), (4, 2)]


def test_a_few_copies_of_a_document_stay_whole(frame):
    passage = " ".join(f"{c}{d}" for c in "abcdef" for d in "abcdefghij")
    copies = [(i, f"own line of these\n{passage}\nlast words of it") for i in (3, 4, 5)]
    assert {r["n_dropped"] for r in lines.dedup_lines(frame(copies)).collect()} == {0}
    rest = " ".join(f"{c}{d}x" for c in "abcd" for d in "abcdefghij")
    copies = [(i, f"{t}\n{rest}") for i, t in copies]
    # Another text with the passage comes first or later.
    for i, dropped in ((1, {1: 0, 3: 1, 4: 1, 5: 1}), (9, {3: 0, 4: 0, 5: 0, 9: 1})):
        got = lines.dedup_lines(frame([*copies, (i, f"{passage}\nsomething else {rest[::-1]}")])).collect()
        assert {r["doc_id"]: r["n_dropped"] for r in got} == dropped
    # A passage that most of a document is of goes, unless both are near copies.
    near = [(1, f"{passage}\n{rest}"), (2, f"{passage}\nshort end")]
    assert {r["doc_id"]: r["n_dropped"] for r in lines.dedup_lines(frame(near)).collect()} == {1: 0, 2: 1}


def sharing(percent, n=4, size=200):
    """Documents of ``size`` words of which ``percent`` are one line of all."""
    words = size * percent // 100
    passage = " ".join(f"{c}{d}{e}" for c in "abcdef" for d in "abcdefghij" for e in "xyzw")
    passage = " ".join(passage.split()[:words])
    return [(i, passage + "\n" + " ".join(f"{chr(97 + i)}{c}{d}o" for c in "abcdefghijklmnop" for d in "abcdefghij").rsplit(" ", 160 - size + words)[0]) for i in range(1, n + 1)]


@pytest.mark.parametrize("percent", [60, 70, 75, 80, 85, 90, 95])
def test_a_passage_is_left_once_by_line_or_document_dedup(frame, percent):
    docs = frame(sharing(percent))
    assert {len(t.split()) for _, t in sharing(percent)} == {200}
    left = neardup.keep_one(lines.dedup_lines(docs, copies=80), percent=80).collect()
    assert sum("\n" in r["text"] for r in left) == 1
    assert len(left) == (1 if percent >= 90 else 4)
    # With no dedup of documents to follow, lines alone see to it.
    alone = lines.dedup_lines(docs, copies=101).collect()
    assert sum("\n" in r["text"] for r in alone) == 1 and len(alone) == 4


def test_a_copy_within_a_longer_text_loses_its_passage(frame):
    (_, one), (_, two), *_ = sharing(90)
    longer = one + "\n" + " ".join(f"q{c}{d}" for c in "abcdefghijklmnopqrstuvwxyz" for d in "abcdefghij")
    got = {r["doc_id"]: r["n_dropped"] for r in lines.dedup_lines(frame([(1, longer), (2, two)])).collect()}
    assert got == {1: 0, 2: 1}
