"""From rows of word boxes to dictionary entries, by profile.

``v2`` and ``v3`` fold numbered rows into entries, ``v3`` can fold rows without
numbers and rows of Arabic headwords, ``v4`` takes each row as an entry. A fold
is a running count of the rows that start an entry, within one column of a
page, so pages never wait for each other.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glossaflow.functions import text as tx

KEYS = ("pdf", "page", "col")
#: Where entries without a number sort.
NO_NUMBER = 1_000_000

# What marks a line as no entry.
NOISE = {
    "v2": (r"(?U)^\d{1,3}$", "^©.*$", "^(الجامعة|قسم|مجلة|©|صفحة)", f"^[A-Z{tx.SPACE[1:-1]}]{{20,}}$"),
    "v3": (
        r"(?U)^\d{1,3}$",
        "^©.*$",
        "^(الجامعة|قسم|مجلة|©|صفحة|المحتوى|الفهرس)",
        f"^[A-Z{tx.SPACE[1:-1]}]{{20,}}$",
        "^(Digitized|Internet Archive|Google|University|Library|Catholic Press)",
    ),
}


def is_noise(english: Column, arabic: Column, profile: str = "v2", latin: str = tx.LATIN, letters: str = tx.ARABIC) -> Column:
    """Whether an entry is dropped. ``v2`` requires both scripts, ``v3`` keeps
    entries of one, ``v4`` looks at the Latin side only."""
    no_latin = ~english.rlike(latin)
    short = F.length(english) < 2
    if profile == "v4":
        return ((english == "") & (arabic == "")) | ((english != "") & (no_latin | short))
    marked = reduce(lambda a, b: a | b, (c.rlike(p) for p in NOISE[profile] for c in (english, arabic)))
    no_arabic = ~arabic.rlike(letters)
    if profile == "v2":
        return marked | no_latin | no_arabic | short
    return marked | ((english == "") & (arabic == "")) | ((english != "") & (no_latin | short)) | ((arabic != "") & no_arabic)


def _ordered(column: str, descending: bool) -> Column:
    """Texts of (x, pos, text) structs by x; equal places keep their order."""
    at = F.transform(column, lambda b: F.struct((-b["x"] if descending else b["x"]).alias("x"), b["pos"].alias("pos"), b["text"].alias("text")))
    return F.array_join(F.transform(F.array_sort(at), lambda b: b["text"]), " ")


def row_texts(words: DataFrame, profile: str = "v2", keys: Sequence[str] = KEYS) -> DataFrame:
    """(keys, row, y, number, english, arabic, english_x, arabic_x) of each row.

    Mixed tokens give a part to each side. Latin parts need two characters.
    ``v4`` keeps the row's order on the Latin side and sorts the Arabic one
    backwards by its letters.
    """
    kind = tx.classify(F.col("text"), profile)
    mixed = F.col("kind") == "mixed"
    typed = words.withColumn("kind", kind).withColumns(
        {
            "latin": F.when(F.col("kind") == "english", F.col("text")).when(mixed, tx.latin_part(F.col("text"))),
            "letters": F.when(F.col("kind") == "arabic", F.col("text")).when(mixed, tx.arabic_part(F.col("text"))),
        }
    )
    typed = typed.withColumns({"latin": F.when(F.length("latin") >= 2, F.col("latin")), "letters": F.when(F.col("letters") != "", F.col("letters"))})
    # Within a row the scanner's order is by x, then by y and place.
    seat = F.struct("x", "y", "pos")
    side = lambda c: F.collect_list(F.when(F.col(c).isNotNull(), F.struct("x", F.struct("y", "pos").alias("pos"), F.col(c).alias("text"))))
    rows = typed.groupBy(*keys, "row").agg(
        F.min_by("y", seat).alias("y"),
        F.min_by(tx.number(F.col("text")), F.when(F.col("kind") == "digit", seat)).alias("number"),
        side("latin").alias("e"),
        side("letters").alias("a"),
    )
    english = tx.fix_ocr(tx.strip(_ordered("e", False)), profile)
    english = english if profile == "v4" else tx.strip(tx.collapse(english))
    arabic = tx.strip(F.array_join(F.sort_array(F.transform("a", lambda b: b["text"]), asc=False), " ") if profile == "v4" else _ordered("a", True))
    return rows.select(
        *keys, "row", "y", "number", english.alias("english"), arabic.alias("arabic"),
        F.array_min(F.transform("e", lambda b: b["x"])).alias("english_x"), F.array_min(F.transform("a", lambda b: b["x"])).alias("arabic_x"),
    )


def _starts(profile: str, arabic_first: bool, numbered: bool) -> Column:
    """Whether a row starts an entry."""
    field = F.col
    english, arabic, number = field("english") != "", field("arabic") != "", field("number").isNotNull()
    if not numbered:
        first = field("arabic_x") < field("english_x") if arabic_first else field("english_x") < field("arabic_x")
        return F.coalesce(first, F.lit(False))
    if arabic_first:
        return number & arabic
    return number & english if profile == "v2" else number & (english | arabic)


def fold_entries(rows: DataFrame, profile: str = "v2", *, arabic_first: bool = False, numbered: bool = True, keys: Sequence[str] = KEYS) -> DataFrame:
    """(keys, entry, number, english, arabic, y) of a column's entries.

    Rows before the first entry are dropped. Later rows add their Arabic, and
    their English where the profile does: never in ``v2``, for rows without
    Arabic in ``v3``, always for Arabic headwords or without numbers.
    """
    if profile == "v4":
        kept = rows.where((F.col("english") != "") | (F.col("arabic") != ""))
        return kept.select(*keys, F.col("row").alias("entry"), F.lit(None).cast("bigint").alias("number"), "english", "arabic", "y")
    number = F.col("number") if numbered else F.lit(None).cast("bigint")
    used = rows.withColumn("number", number).where((F.col("english") != "") | (F.col("arabic") != "") | F.col("number").isNotNull())
    along = Window.partitionBy(*keys).orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    marked = used.withColumn("start", _starts(profile, arabic_first, numbered)).withColumn("entry", F.sum(F.col("start").cast("int")).over(along)).where("entry > 0")
    if profile == "v2":
        more = F.lit(False)
    else:
        more = F.lit(True) if arabic_first or not numbered else F.col("arabic") == ""
    english = F.when(F.col("start") | more, F.col("english")).otherwise("")
    parts = marked.groupBy(*keys, "entry").agg(
        F.max(F.when(F.col("start"), F.col("number"))).alias("number"),
        F.max(F.when(F.col("start"), F.col("y"))).alias("y"),
        F.array_sort(F.collect_list(F.struct("row", english.alias("e"), F.col("arabic").alias("a")))).alias("parts"),
    )
    text = lambda side: F.array_join(F.filter(F.transform("parts", lambda p: p[side]), lambda t: t != ""), " ")
    number = F.col("number") if numbered else F.col("entry").cast("bigint")
    return parts.select(*keys, F.col("entry").cast("int").alias("entry"), number.alias("number"), text("e").alias("english"), text("a").alias("arabic"), "y")


def entry_order(entries: DataFrame) -> list[Column]:
    """By number, page and height; a left column comes before a right one."""
    return [F.coalesce(F.nullif("number", F.lit(0)), F.lit(NO_NUMBER)), F.col("page"), F.col("y"), F.col("col"), F.col("entry")]


def segment_line(line: Column, *, strict: bool = True) -> tuple[Column, Column]:
    """(English, Arabic) parts of a line of both scripts.

    ``strict`` cuts at the borders of script runs. Otherwise the character
    machine is reproduced in which a run is only closed at a non-blank buffer
    and a first letter can be left behind.
    """
    if strict:
        # Runs are trimmed below. No group is repeated, so that very long lines
        # need no deep stack.
        runs = F.regexp_extract_all(line, F.lit(f"({tx.ARABIC}[{tx.ARABIC[1:-1]}{tx.SPACE[1:-1]}]*+|[^{tx.ARABIC[1:-1]}]++)"), 1)
    else:
        runs = _machine(line)
    runs = F.transform(runs, tx.strip)
    pick = lambda pattern: F.array_join(F.filter(runs, lambda r: r.rlike(pattern)), " ")
    return tx.strip(pick(tx.LATIN)), tx.strip(pick(tx.ARABIC))


def _machine(line: Column) -> Column:
    start = F.struct(F.lit("").alias("part"), F.lit(False).alias("inside"), F.array().cast("array<string>").alias("done"))

    def step(s: Column, c: Column) -> Column:
        arabic = c.rlike(tx.ARABIC)
        flips = (arabic != s["inside"]) & ~s["part"].rlike(f"^{tx.SPACE}*$")
        return F.struct(
            F.when(flips, c).otherwise(F.concat(s["part"], c)).alias("part"),
            F.when(flips, arabic).otherwise(s["inside"]).alias("inside"),
            F.when(flips, F.array_append(s["done"], s["part"])).otherwise(s["done"]).alias("done"),
        )

    return F.aggregate(F.split(line, ""), start, step, lambda s: F.array_append(s["done"], s["part"]))


def fold_text_lines(lines: DataFrame, keys: Sequence[str] = ("pdf", "page"), *, strict: bool = True) -> DataFrame:
    """(keys, entry, english, arabic) from lines (keys, line_no, text) of a
    text layer: a line of both scripts starts an entry, and so does a page's
    first line of one script; other lines add to the entry before."""
    trimmed = lines.withColumn("text", tx.strip(F.coalesce("text", F.lit(""))))
    one, two = tx.has_latin(F.col("text")), tx.has_arabic(F.col("text"))
    used = trimmed.withColumns({"latin": one, "letters": two}).where(F.col("latin") | F.col("letters"))
    both = F.col("latin") & F.col("letters")
    english, arabic = segment_line(F.col("text"), strict=strict)
    used = used.withColumns(
        {
            "e": F.when(both, english).when(F.col("latin"), F.col("text")).otherwise(""),
            "a": F.when(both, arabic).when(F.col("letters"), F.col("text")).otherwise(""),
        }
    )
    page = Window.partitionBy(*keys).orderBy("line_no")
    used = used.withColumn("start", both | (F.row_number().over(page) == 1))
    used = used.withColumn("entry", F.sum(F.col("start").cast("int")).over(page.rowsBetween(Window.unboundedPreceding, 0)))
    parts = used.groupBy(*keys, "entry").agg(F.array_sort(F.collect_list(F.struct("line_no", "e", "a"))).alias("parts"))
    text = lambda side: F.array_join(F.filter(F.transform("parts", lambda p: p[side]), lambda t: t != ""), " ")
    return parts.select(*keys, F.col("entry").cast("int").alias("entry"), text("e").alias("english"), text("a").alias("arabic"))
