"""Sections, lexicons, merging and the stream of pages."""

import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from glossaflow.operators import lexicon, merge, sections
from glossaflow.plans import reference_book
from glossaflow.streaming import pages as stream


def test_sections_carry_over_pages(spark):
    pages = spark.createDataFrame([(1, 1, "الفصل أ\nx\nقسم:\ny"), (1, 2, "w\nالفصل ب\nz"), (2, 1, "v")], "pdf long, page int, text string")
    got = reference_book.structured_lines(pages).orderBy("pdf", "page", "line_no").collect()
    assert [(r["Content"], r["Section"], r["Subsection"]) for r in got if r["Type"] == "content"] == [
        ("x", "الفصل أ", ""), ("y", "الفصل أ", "قسم:"), ("w", "الفصل أ", "قسم:"), ("z", "الفصل ب", ""), ("v", "", ""),
    ]


def test_the_stream_goes_on_where_it_was(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    first = spark.createDataFrame([(1, 1, "الفصل أ\nx")], stream.PAGES)
    first.write.parquet(source)
    stream.ingest(spark, source, out, checkpoint, seconds=120)
    spark.createDataFrame([(1, 2, "y\nقسم:\nz")], stream.PAGES).write.mode("append").parquet(source)
    query = stream.ingest(spark, source, out, checkpoint, seconds=120)
    assert stream.write_progress(spark, query, out, str(tmp_path / "progress")) == {"last_page": 3, "total_lines": 5, "status": "completed"}
    assert spark.read.json(str(tmp_path / "progress")).first()["last_page"] == 3
    got = spark.read.parquet(out).orderBy("page", "line_no").collect()
    assert [(r["Content"], r["Section"], r["Subsection"]) for r in got] == [("الفصل أ", "الفصل أ", ""), ("x", "الفصل أ", ""), ("y", "الفصل أ", ""), ("قسم:", "الفصل أ", "قسم:"), ("z", "الفصل أ", "قسم:")]


def test_a_stream_that_is_stopped_is_no_result(spark, tmp_path):
    """What was written by the limit passed for the whole, and for completed."""
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    spark.createDataFrame([(1, 0, "a")], stream.PAGES).write.parquet(source)
    stream.ingest(spark, source, out, checkpoint)
    spark.createDataFrame([(1, 1, "b\nc")], stream.PAGES).write.mode("append").parquet(source)
    with pytest.raises(stream.Paused) as stopped:
        stream.ingest(spark, source, out, checkpoint, seconds=0.001)
    assert stream.progress(spark, stopped.value.query, out)["status"] == "paused"
    query = stream.ingest(spark, source, out, checkpoint)
    assert stream.progress(spark, query, out) == {"last_page": 2, "total_lines": 3, "status": "completed"}


def test_pages_wait_for_their_turn(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    pages = {0: "الفصل أ\nx", 1: " \n", 2: "قسم:\ny", 3: "z", 5: "late"}
    for batch in ([3, 1], [2, 3], [0, 5]):
        spark.createDataFrame([(1, p, pages[p]) for p in batch] + [(2, p, "own") for p in batch if p == 0], stream.PAGES).coalesce(1).write.mode("append").parquet(source)
        query = stream.ingest(spark, source, out, checkpoint, files=1, seconds=120, first=0)
    got = spark.read.schema(stream.OUT).parquet(out).orderBy("pdf", "page", "line_no").collect()
    assert [(r["pdf"], r["page"], r["Content"], r["Subsection"]) for r in got] == [(1, 0, "الفصل أ", ""), (1, 0, "x", ""), (1, 2, "قسم:", "قسم:"), (1, 2, "y", "قسم:"), (1, 3, "z", "قسم:"), (2, 0, "own", "")]
    # Page 4 is not there yet, so page 5 is not out.
    assert stream.progress(spark, query, out) == {"last_page": 4, "total_lines": 6, "status": "completed"}


def test_routes_and_fallbacks(spark):
    arabic = "هذا نص عربي سليم " * 5
    rows = spark.createDataFrame([(arabic,), ("short",), ("latin text " * 9,), (None,)], "t string")
    assert [r[0] for r in rows.select(sections.text_route(F.col("t"), strict=True)).collect()] == ["text", "ocr", "ocr", "ocr"]
    both = spark.createDataFrame([(" ", "b"), ("a", "b")], "x string, y string")
    assert [r[0] for r in both.select(sections.with_fallback(F.col("x"), F.col("y"))).collect()] == ["b", "a"]


def test_corrections(spark):
    words = spark.createDataFrame([("english", "dictionary", 5), ("english", "cat", 2), ("arabic", "مدرسة", 3)], "lang string, word string, freq long")
    texts = spark.createDataFrame([(1, "Dictionery Cat ab zzz"), (2, ""), (3, None)], "k int, text string")
    got = lexicon.correct_text(texts, words, ["k"]).orderBy("k").collect()
    assert [r["text"] for r in got] == ["dictionary Cat ab zzz", "", ""]
    mixed = spark.createDataFrame([(1, "dictionery مدرسه")], "k int, text string")
    assert lexicon.correct_text(mixed, words, ["k"], lang=None, profile="v4", threshold=0.8).first()["text"] == "dictionary مدرسة"


def test_pruned_neighbours_are_the_true_ones(spark):
    known = ["station", "nation", "rational", "notation", "national"]
    tokens = ["statoin", "natian", "rationall", "xyz", "notatoin"]
    lex = spark.createDataFrame([(w, 1) for w in known], "word string, freq long")
    got = {r["token"]: r["word"] for r in lexicon.nearest_words(spark.createDataFrame([(t,) for t in tokens], "token string"), lex).collect()}
    expected = {}
    for t in tokens:
        near = [(-SequenceMatcher(None, t, w).ratio(), w) for w in known if abs(len(t) - len(w)) <= 2 and SequenceMatcher(None, t, w).ratio() >= 0.85]
        if near:
            expected[t] = min(near)[1]
    assert got == expected


def test_neighbours_of_all_lengths_are_the_true_ones(spark):
    rng, letters = random.Random(4), "abcdefghijkl"
    known = ["".join(rng.choices(letters, k=n)) for n in [*range(3, 26)] * 4]

    def near_copy(w):
        w = list(w)
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(w))
            w[at : at + rng.randint(0, 1)] = rng.choice(["", rng.choice(letters)])
        return "".join(w)

    tokens = sorted({near_copy(w) for w in known for _ in range(3)} - {"", *known})
    got = {r["token"]: r["word"] for r in lexicon.nearest_words(spark.createDataFrame([(t,) for t in tokens], "token string"), spark.createDataFrame([(w, 1) for w in known], "word string, freq long").distinct()).collect()}
    expected = {}
    for t in tokens:
        near = [(-SequenceMatcher(None, t, w).ratio(), w) for w in known if abs(len(t) - len(w)) <= 2 and SequenceMatcher(None, t, w).ratio() >= 0.85]
        if near:
            expected[t] = min(near)[1]
    assert got == expected and len(expected) > 50


def test_lexicon_words_have_letters_of_their_side(spark):
    entries = spark.createDataFrame([("Cat 12 -- قط", "أب abc 3"), (None, "اب")], "english string, arabic string")
    got = {(r["lang"], r["word"], r["freq"]) for r in lexicon.lexicon_of(entries).collect()}
    assert got == {("english", "cat", 1), ("arabic", "اب", 2)}


def test_merges(spark):
    rows = spark.createDataFrame([("chunk1", 0, " Cat ", "قط", "a"), ("chunk10", 0, "cat", "قط", "b"), ("chunk2", 0, "dog", "", "c"), ("chunk2", 1, "ant", "نملة", "d")], "file string, pos int, term string, definition string, source_file string")
    assert [tuple(r) for r in merge.merge_named(rows, ["file", "pos"]).orderBy("id").collect()] == [(1, "Cat", "قط", "a"), (2, "ant", "نملة", "d")]
    cells = rows.withColumn("cells", F.array("file", "term", "definition"))
    assert [tuple(r) for r in merge.merge_positional(cells, ["file", "pos"]).orderBy("id").collect()] == [(1, "Cat", "قط"), (2, "dog", ""), (3, "ant", "نملة")]
    assert merge.merge_lines([rows, rows]).count() == 8
    numbered = merge.renumber(spark.range(1000).withColumn("k", -F.col("id")).drop("id"), ["k"]).orderBy("k").collect()
    assert [r["id"] for r in numbered] == list(range(1, 1001))


def test_overlap_with_a_gold_list(spark):
    ours = spark.createDataFrame([("Cat", "قط"), ("dog", "x")], "term string, definition string")
    gold = spark.createDataFrame([("cat", "قط"), ("Dog", "كلب"), ("ant", "نملة")], "term string, definition string")
    assert tuple(lexicon.overlap(ours, gold).first())[:4] == (3, 2, 2, 1)


def test_documents_of_a_shelf_have_one_state(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "state"))
    n = 2 * stream.SHELF
    for page, text in ((1, "الفصل ب"), (0, "x\ny")):
        spark.createDataFrame([(pdf, page, f"{text} {pdf}") for pdf in range(n)], stream.PAGES).write.mode("append").parquet(source)
        query = stream.ingest(spark, source, out, checkpoint, seconds=120, first=0)
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 2
    rows = spark.read.schema(stream.OUT).parquet(out).orderBy("pdf", "page", "line_no").collect()
    assert [tuple(r)[:4] + (r["Section"], r["Content"]) for r in rows] == [
        x for p in range(n) for x in ((p, 0, 0, "content", "", "x"), (p, 0, 1, "content", "", f"y {p}"), (p, 1, 0, "chapter", f"الفصل ب {p}", f"الفصل ب {p}"))
    ]
