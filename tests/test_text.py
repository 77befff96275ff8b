"""Vectors for the column functions, quirks of every profile included."""

import re
import unicodedata
from difflib import SequenceMatcher

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from glossaflow.functions import similarity as sim
from glossaflow.functions import text as tx


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "v string").select(f(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    ("f", "value", "expected"),
    [
        (tx.clean, "a  b​ \x1cc", "a b c"),
        (tx.clean, None, ""),
        (tx.safe_name, "Dictionary.of.Terms", "Dictionary.of.Terms"),
        (tx.safe_name, "file..name", "file.name"),
        (tx.safe_name, "test_", "test"),
        (tx.number, "٣١", 31),
        (tx.number, "3a", None),
        (tx.is_number, "٣١", True),
        (tx.is_number, "12345", False),
        (lambda c: tx.is_number(c, "v3"), "12345", True),
        (tx.classify, "abكتاب", "mixed"),
        (tx.classify, "é", "noise"),
        (tx.classify, "كتاب", "arabic"),
        (tx.latin_part, "abكتاب", "ab"),
        (tx.arabic_part, "abكتاب", "كتاب"),
        (tx.fix_ocr, "0pen fo0 a|l", "open foo all"),
        (lambda c: tx.fix_ocr(c, "v3"), "rn cl |a | a|", "m d la | al"),
        (lambda c: tx.fix_ocr(c, "v4"), "rn |a", "rn la"),
        (tx.clean_arabic, " كتاب ‏  . ", "كتاب  ."),
        (lambda c: tx.clean_arabic(c, "v3"), " كتاب‌ . ", "كتاب"),
        (tx.clean_english, " a  b ; ", "a b"),
        (tx.normalize_arabic, "أإآٰى ؤَئ", "اااي وي"),
        (tx.content_type, "الفصل الأول", "chapter"),
        (tx.content_type, "مضادات", "chapter"),
        (tx.content_type, "جرعة:", "section"),
        (tx.content_type, "3) a", "list_item"),
        (tx.content_type, "• a", "list_item"),
        (lambda c: tx.content_type(c, bullets=False), "• a", "content"),
        (tx.content_type, "a | b", "table"),
        (tx.content_type, "  ", "content"),
        (lambda c: tx.split_columns(c)[0], "term\t\tdef", "term def"),
        (lambda c: tx.split_columns(c)[1], "term\t\tdef", ""),
        (lambda c: tx.split_columns(c, strict=True)[1], "term   def  x", "def x"),
        (tx.is_safe_category, "قسم-1", True),
        (tx.is_safe_category, "a b", False),
        (tx.strip_html, "<p>a</p><script>var t='</p>'</script><b>b &amp; c</b>", "a b & c"),
        (tx.is_garbled, "short", False),
        (tx.is_garbled, "ًٌَُِ " * 20, True),
        (lambda c: tx.is_garbled(c, strict=True), "هذا نص عربي سليم تماما ولا عيب فيه على الإطلاق يا صديقي العزيز", False),
    ],
)
def test_vectors(spark, f, value, expected):
    assert one(spark, value, f) == expected


def test_ratio_depends_on_the_order(spark):
    rows = spark.createDataFrame([("tide", "diet"), ("diet", "tide"), ("", "a"), ("a", "a")], "a string, b string")
    assert [r[0] for r in rows.select(sim.guarded_ratio(F.col("a"), F.col("b"))).collect()] == [0.25, 0.5, 0.0, 1.0]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.text("abcdé", max_size=9), st.text("abcdé", max_size=9)), min_size=20, max_size=60))
def test_the_ratio_is_as_in_python_and_never_above_its_bounds(spark, pairs):
    rows = spark.createDataFrame(pairs, "a string, b string")
    a, b = F.col("a"), F.col("b")
    for r in rows.select("a", "b", sim.ratio(a, b).alias("r"), sim.letter_bound(a, b).alias("l"), sim.length_bound(a, b).alias("n")).where("a <> '' or b <> ''").collect():
        assert abs(r["r"] - SequenceMatcher(None, r["a"], r["b"]).ratio()) < 1e-12
        assert r["r"] <= r["l"] + 1e-9 and r["l"] <= r["n"] + 1e-9


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(max_size=30), min_size=10, max_size=40))
def test_cleaning_is_idempotent_and_as_in_python(spark, texts):
    texts = [t.replace("\0", "").encode("utf-8", "ignore").decode() for t in texts]
    rows = spark.createDataFrame([(t,) for t in texts], "v string").select("v", tx.clean(F.col("v")).alias("c"), tx.clean(tx.clean(F.col("v"))).alias("cc")).collect()
    for r in rows:
        assert r["c"] == r["cc"]
        assert r["c"] == " ".join(r["v"].replace("\xa0", " ").replace("​", "").replace("‏", "").split())


def test_names_of_notes_and_archives(spark):
    row = spark.createDataFrame([("a b/c (d)\\e",)], "n string").select(tx.note_name(F.col("n")), tx.archive_name(F.col("n"))).first()
    assert tuple(row) == ("a_b_c_(d)\\e", "a_b_c_d_e")


def test_presentation_forms(spark):
    """Each character as the library has it; neighbours are not composed."""
    blocks = [chr(c) for c in range(0xFB40, 0xFF10)]
    inside = [c for c in blocks if re.match(tx.FORM, c)]
    for make in (lambda c: c, lambda c: f"a{c}{c}b", lambda c: f"كتاب {c}"):
        rows = spark.createDataFrame([(c, make(c)) for c in blocks], "c string, t string").select("c", tx.presentation_forms(F.col("t")).alias("t")).collect()
        wanted = {c: unicodedata.normalize("NFKC", c) if c in inside else c for c in blocks}
        assert {r["c"]: r["t"] for r in rows} == {c: make(wanted[c]) for c in blocks}
    texts = ["", None, "plain", "\U0001f600\ufefb\U0001f600", "\ufdfa", "x" * 100_000 + "\ufe8d"]
    found = spark.createDataFrame([(t,) for t in texts], "t string").select(tx.presentation_forms(F.col("t")).alias("t")).collect()
    assert [r["t"] for r in found] == ["", None, "plain", "\U0001f600\u0644\u0627\U0001f600", unicodedata.normalize("NFKC", "\ufdfa"), "x" * 100_000 + "\u0627"]


def test_normalize_forms(spark):
    text = "\u202b\ufeb3\ufefc\ufee1\u202c (cid:12)(cid:x) \u200ea\u2069"
    found = spark.createDataFrame([(text,)], "t string").select(tx.normalize_forms(F.col("t")).alias("t")).first()
    assert found["t"] == "\u0633\u0644\u0627\u0645 (cid:x) a"


def test_tails_and_shapes_are_as_by_their_patterns(spark):
    import re
    import unicodedata

    from glossaflow.functions import text as tx

    shapes = [chr(c) for c in range(0xFB50, 0xFF00) if re.match(tx.FORM, chr(c))]
    tails = ["a .", "a. ", " .", ".", "a . .", "a ‏ .", "‏ .", "a .‌ ", "a ;", "a : ‍ ", "", " ", "a\n.\n", "a b"]
    texts = [*tails, *shapes, "x" + "".join(shapes) + "y", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", tx.presentation_forms(F.col("t")).alias("s"), tx.clean_english(F.col("t")).alias("e"), tx.clean_arabic(F.col("t"), "v3").alias("a"))
    off = lambda t: t.strip(tx.SPACES)
    for t, s, e, a in rows.collect():
        if t is None:
            assert (s, e, a) == (None, None, None)
            continue
        assert s == "".join(unicodedata.normalize("NFKC", c) if re.match(tx.FORM, c) else c for c in t)
        one = re.sub(f"{tx.SPACE}+", " ", off(t))
        assert e == off(re.sub(rf"{tx.SPACE}+[.,;:]{tx.SPACE}*\Z", "", one))
        assert a == off(re.sub(rf"{tx.SPACE}+[.,;:]{tx.SPACE}*\Z", "", re.sub("[‎‏‍‌]", "", one)))
