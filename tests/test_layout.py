"""Rows, columns, passes and entries on small pages."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from glossaflow.functions import text as tx
from glossaflow.operators import entries as en
from glossaflow.operators import folding, layout
from glossaflow.plans import dictionary

BOX = "pdf int, page int, pos int, text string, x int, y int, w int, h int, conf int, width int"


def boxes(spark, rows):
    return spark.createDataFrame([(1, p, i, t, x, y, 10, 10, 90, 1000) for i, (p, t, x, y) in enumerate(rows)], BOX)


def test_rows_are_anchored_at_their_first_box(spark):
    words = boxes(spark, [(1, "a", 0, y) for y in (0, 10, 20, 24, 40)]).withColumn("col", F.lit(0))
    got = {r["y"]: r["row"] for r in layout.cluster_rows(words).collect()}
    assert got == {0: 0, 10: 0, 20: 1, 24: 1, 40: 2}


def test_rows_of_a_page_of_many_boxes(spark):
    heights = [i * 7 % 1000 for i in range(3 * layout.CHUNK + 1)]
    words = boxes(spark, [(1, "a", 0, y) for y in heights]).withColumn("col", F.lit(0))
    expected, anchor, row = {}, None, -1
    for y, pos in sorted((y, i) for i, y in enumerate(heights)):
        if anchor is None or y - anchor > layout.ROW_TOLERANCE:
            anchor, row = y, row + 1
        expected[pos] = row
    assert {r["pos"]: r["row"] for r in layout.cluster_rows(words).collect()} == expected


def test_of_boxes_of_one_place_the_earliest_pass_and_the_last_box_count(spark):
    twice = boxes(spark, [(1, "ab", 5, 5), (1, "ab", 5, 5)])
    got = layout.dual_pass(twice, twice, twice.withColumn("conf", F.lit(99))).collect()
    assert [(r["pos"], r["conf"], r["scan"]) for r in got] == [(1, 90, 1)]


def test_confidence_rules(spark):
    rows = spark.createDataFrame([("a", "96.5"), ("b", "96"), (" ", "99"), ("c", None), ("d", "29")], "text string, conf string")
    assert [r["text"] for r in layout.confident(rows).collect()] == ["b"]


def test_an_arabic_box_near_a_latin_one_is_dropped(spark):
    one = boxes(spark, [(1, "ab", 0, 0)])
    two = boxes(spark, [(1, "كت", 19, 19), (1, "كت", 20, 0), (1, "كت", -19, -19)])
    three = boxes(spark, [(1, "ab", 0, 0), (1, "7", 5, 5)])
    got = {(r["text"], r["x"], r["y"]) for r in layout.dual_pass(one, two, three).collect()}
    assert got == {("ab", 0, 0), ("كت", 20, 0), ("7", 5, 5)}


PAGE = [(1, "1", 0, 0), (1, "cat", 20, 0), (1, "قط", 400, 0), (1, "كبير", 300, 20), (1, "big", 20, 40), (1, "2", 0, 60), (1, "كلب", 300, 60)]


@pytest.mark.parametrize(
    ("profile", "expected"),
    [
        ("v2", [(1, "cat", "قط كبير كلب")]),
        ("v3", [(1, "cat big", "قط كبير"), (2, "", "كلب")]),
        ("v4", [(None, "cat", "قط"), (None, "", "كبير"), (None, "big", ""), (None, "", "كلب")]),
    ],
)
def test_entries_by_profile(spark, profile, expected):
    got = dictionary.raw_entries(boxes(spark, PAGE), dictionary.Options(profile)).orderBy("entry").collect()
    assert [(r["number"], r["english"], r["arabic"]) for r in got] == expected


def test_entries_without_numbers_need_the_headword_first(spark):
    page = [(1, "cat", 0, 0), (1, "قط", 100, 0), (1, "كبير", 0, 20), (1, "فيل", 0, 40), (1, "elephant", 100, 40)]
    got = dictionary.raw_entries(boxes(spark, page), dictionary.Options("v3", numbered=False)).collect()
    assert [(r["english"], r["arabic"]) for r in got] == [("cat elephant", "قط كبير فيل")]
    got = dictionary.raw_entries(boxes(spark, page), dictionary.Options("v3", numbered=False, arabic_first=True)).collect()
    assert [(r["english"], r["arabic"]) for r in got] == [("elephant", "فيل")]


def test_a_first_wins_dictionary_is_numbered(spark):
    page = [(1, "1", 0, 0), (1, "Cat", 20, 0), (1, "قط", 400, 0), (2, "2", 0, 0), (2, "cat", 20, 0), (2, "قط", 400, 0), (2, "3", 0, 30), (2, "dog", 20, 30), (2, "كلب", 400, 30)]
    got = dictionary.dictionary(boxes(spark, page), dictionary.Options("v2")).orderBy("id").collect()
    assert [(r["id"], r["English"], r["Arabic"]) for r in got] == [(1, "Cat", "قط"), (2, "dog", "كلب")]


def test_chunks_of_pages_give_what_the_whole_gives(spark):
    pages = boxes(spark, [(p, t, x, y) for p in range(6) for _, t, x, y in PAGE])
    whole = dictionary.raw_entries(pages, dictionary.Options("v3"))
    parts = [dictionary.raw_entries(pages, dictionary.Options("v3", chunk_size=2, chunk=k)) for k in range(3)]
    merged = parts[0].unionByName(parts[1]).unionByName(parts[2])
    assert sorted(map(tuple, whole.collect()), key=str) == sorted(map(tuple, merged.collect()), key=str)


def test_script_runs_of_a_line(spark):
    rows = spark.createDataFrame([("book كتاب جديد",), ("كتاب book",)], "t string")
    strict = rows.select(*en.segment_line(F.col("t"))).collect()
    assert [tuple(r) for r in strict] == [("book", "كتاب جديد"), ("book", "كتاب")]
    loose = rows.select(*en.segment_line(F.col("t"), strict=False)).collect()
    assert [tuple(r) for r in loose] == [("book", "كتاب ج ديد"), ("book", "ك تاب")]


def test_noise_rules(spark):
    rows = spark.createDataFrame([("cat", "قط"), ("cat", ""), ("c", "قط"), ("12", "قط"), ("Google books", "قط"), ("", "")], "e string, a string")
    e, a = F.col("e"), F.col("a")
    got = rows.select(*(en.is_noise(e, a, p) for p in ("v2", "v3", "v4"))).collect()
    assert [tuple(r) for r in got] == [(False, False, False), (True, False, False), (True, True, True), (True, True, True), (False, True, False), (True, True, True)]


def test_votes_and_samples(spark):
    assert layout.sample_pages(3) == [0, 1, 2, 2, 2]
    pages = spark.createDataFrame([(1, True, False, 2, 30, 100, 200, 0, 0), (1, True, False, 2, 33, 100, 200, 5, 6), (1, False, True, 1, 99, 100, 200, 7, 8)], "pdf int, is_scanned boolean, has_text boolean, num_columns int, gutter_x int, page_width int, page_height int, image_w int, image_h int")
    assert tuple(layout.layout_vote(pages).first()) == (1, True, False, 2, 31, 100, 200, 6, 7)


def test_empty_pages(spark):
    none = boxes(spark, PAGE).limit(0)
    for profile in ("v2", "v3", "v4"):
        assert dictionary.dictionary(none, dictionary.Options(profile)).count() == 0


def _shuffles(frame):
    return frame._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_packed_pages_are_not_shuffled(spark):
    packed = layout.pages_of(boxes(spark, PAGE)).localCheckpoint()
    rest = [c for c in BOX.replace(" int", "").replace(" string", "").split(", ") if c not in ("pdf", "page")]
    three = packed.withColumn("boxes", layout.let(F.col("boxes"), lambda b: layout.passes(b, b, b, rest)))
    options = dictionary.Options("v3")
    assert [_shuffles(df) for df in (three, layout.line_buckets(packed), dictionary.place_words(packed, options), dictionary.raw_entries(three, options))] == [0, 0, 0, 0]
    assert _shuffles(dictionary.dictionary(packed, options)) == 1
    words = boxes(spark, PAGE)
    whole, ours = dictionary.dictionary(words, options), dictionary.dictionary(packed, options)
    assert sorted(whole.collect()) == sorted(ours.collect())
    scanned = layout.unpacked(three, ["pdf", "page"], F.col("boxes"))
    assert sorted(map(str, scanned.collect())) == sorted(map(str, layout.dual_pass(words, words, words).select(*scanned.columns).collect()))


def test_passes_of_a_page_of_many_boxes_meet_in_bands(spark):
    latin = [(1, "a", i * 37 % 200, i * 11 % 500) for i in range(150)]
    arabic = [(1, "كت", i * 53 % 200, i * 7 % 500) for i in range(3 * layout.BAND + 5)]
    one, two = boxes(spark, latin), boxes(spark, arabic)
    got = {(r["x"], r["y"]) for r in layout.dual_pass(one, two, one.limit(0)).where("scan = 2").collect()}
    assert got == {(x, y) for _, _, x, y in arabic if not any(abs(x - u) < 20 and abs(y - v) < 20 for _, _, u, v in latin)}


def _by_rows(words, options):
    """Entries by the operators on rows of words."""
    rows = en.row_texts(dictionary.place_words(words, options), options.profile)
    return en.fold_entries(rows, options.profile, arabic_first=options.arabic_first, numbered=options.numbered)


@pytest.mark.parametrize("options", [("v2", False, True), ("v3", False, True), ("v3", True, True), ("v3", False, False), ("v3", True, False), ("v4", False, True)])
def test_entries_of_batches_are_those_of_rows(spark, options):
    draw = random.Random(7)
    texts = ["cat", "rn", "a", "0ld", "قط", "و", "7", "12", "٣٤", "१२", "dogكلب", ".aب", "--", " cl ", " ", "", None, "123456"]
    place = lambda: draw.choice([None, *range(0, 1000, 40)])
    rows = [(pdf, page, i, draw.choice(texts), place(), draw.choice([None, *range(90), *range(90)]), 10, 10, draw.choice([None, 20, 90, 95]), draw.choice([1000, 1000, 0])) for pdf in range(3) for page in range(9) for i in range(draw.choice([0, 1, 2, 30]))]
    words = spark.createDataFrame(rows, BOX).where("conf is not null")
    options = dictionary.Options(options[0], arabic_first=options[1], numbered=options[2])
    ours = dictionary.raw_entries(words, options)
    assert sorted(map(str, ours.collect())) == sorted(map(str, _by_rows(words, options).select(ours.columns).collect()))


def test_pages_are_worked_on_in_parts():
    text = pa.array(["1", "cat", "قط", "2", "dog", "كلب"])
    page, x, y, pos = (np.array(v, float) for v in ([0, 0, 0, 2, 2, 2], [0, 20, 40] * 2, [0, 0, 5] * 2, range(6)))
    got = folding._entries(page.astype(int), 3, text, np.zeros(6, int), x, y, pos, "v2", 12, False, True).to_pylist()
    assert [[(e["entry"], e["number"], e["english"], e["arabic"]) for e in p] for p in got] == [[(1, "1", "cat", "قط")], [], [(1, "2", "dog", "كلب")]]
    none = folding._entries(page[:0].astype(int), 2, text[:0], np.zeros(0, int), x[:0], y[:0], pos[:0], "v3", 12, False, False)
    assert none.to_pylist() == [[], []]


def test_no_lambda_goes_over_the_boxes_of_an_entry(spark):
    packed = layout.pages_of(boxes(spark, PAGE)).localCheckpoint()
    for found in (dictionary.raw_entries, dictionary.dictionary):
        plan = found(packed, dictionary.Options("v3"))._jdf.queryExecution().optimizedPlan().toString()
        assert "lambda" not in plan and "ArrowEvalPython" in plan


def test_sides_are_collapsed_once_and_ends_are_trimmed_of_blanks_only(spark):
    rows = spark.createDataFrame([("  cat  big .\t",), (" ;",), ("‏ قط‌  ,",), ("",)], "t string")
    cleaned = rows.select(tx.clean_english(F.col("t")).alias("e"), tx.clean_arabic(F.col("t"), "v3").alias("a"), tx.clean_arabic(F.col("t")).alias("b"))
    assert [tuple(r) for r in cleaned.collect()] == [("cat big", "cat big", "cat big ."), (";", ";", ";"), ("‏ قط‌", "قط", "قط‌ ,"), ("", "", "")]
    packed = layout.pages_of(boxes(spark, PAGE)).localCheckpoint()
    plan = dictionary.dictionary(packed, dictionary.Options("v3"))._jdf.queryExecution().optimizedPlan().toString()
    exploded = [line for line in plan.splitlines() if "Generate" in line]
    assert exploded and not any("regexp_replace" in line for line in exploded)
