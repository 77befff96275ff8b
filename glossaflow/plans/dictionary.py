"""From word boxes to a numbered bilingual dictionary, by profile."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from glossaflow.functions import text as tx
from glossaflow.operators import entries as en
from glossaflow.operators import folding, layout, lexicon, merge


@dataclass(frozen=True)
class Options:
    """One run over scanned dictionary pages."""

    profile: str = "v3"
    start: int = 0
    end: int | None = None
    gutter_ratio: float = layout.GUTTER_RATIO
    row_tolerance: int = layout.ROW_TOLERANCE
    min_conf: int = layout.MIN_CONF
    arabic_first: bool = False
    numbered: bool = True
    chunk_size: int = 0
    chunk: int = -1
    correct: bool = False


class Counters:
    """Raw, skipped and valid entries of a run, counted while it runs.

    They are there once the dictionary was written or collected, without a pass
    of their own; a run that is repeated counts the first time only.
    """

    def __init__(self) -> None:
        self._seen = Observation(f"run-{uuid.uuid4().hex}")

    def observe(self, entries: DataFrame, noise: Column) -> DataFrame:
        return entries.observe(self._seen, F.count(F.lit(1)).alias("raw_entries"), F.count_if(noise).alias("skipped"), F.count_if(~noise).alias("valid_entries"))

    def read(self) -> dict[str, int]:
        return self._seen.get


def column_ratio(words: DataFrame, layouts: DataFrame | None, given: float) -> tuple[DataFrame, Column]:
    """Boxes with the share of the width where their document's columns part:
    at the detected gutter of two columns, or as ``given``. ``layouts`` has
    pdf, num_columns, gutter_x and page_width, as a layout vote makes them."""
    if layouts is None:
        return words, F.lit(given)
    wide = F.when(F.col("page_width") > 0, F.col("gutter_x") / F.col("page_width")).otherwise(0.5)
    ratios = layouts.select("pdf", F.when((F.col("num_columns") == 2) & (F.col("gutter_x") > 0), wide).alias("_ratio"))
    return words.join(ratios, "pdf", "left"), F.coalesce("_ratio", F.lit(given))


def _pages_in_range(words: DataFrame, options: Options) -> DataFrame:
    return layout.pages_of(layout.page_range(words, options.start, options.end, chunk_size=options.chunk_size, chunk=options.chunk))


def _page_rows(words: DataFrame, options: Options, layouts: DataFrame | None = None) -> tuple[DataFrame, Column]:
    """Packed pages of the range, and their rows: (col, row, boxes) of the
    boxes that are kept by confidence."""
    kept, ratio = column_ratio(layout.confident(_pages_in_range(words, options), options.min_conf), layouts, options.gutter_ratio)
    side = lambda b: layout.split_by_ratio(b["x"], b["w"], b["width"], ratio)
    return kept, layout.rows_of(F.col("boxes"), side, options.row_tolerance)


def place_words(words: DataFrame, options: Options, layouts: DataFrame | None = None) -> DataFrame:
    """Boxes of the page range, kept by confidence, with col and row. Boxes
    come one a row or packed by page; packed pages are not shuffled."""
    kept, rows = _page_rows(words, options, layouts)
    placed = F.flatten(F.transform(rows, lambda r: F.transform(r["boxes"], lambda b: F.struct(b.alias("box"), r["col"].alias("col"), r["row"].alias("row")))))
    return layout.unpacked(kept, ["pdf", "page"], placed).select("pdf", "page", "box.*", "col", "row")


def raw_entries(words: DataFrame, options: Options, layouts: DataFrame | None = None) -> DataFrame:
    """(pdf, page, col, entry, number, english, arabic, y). A page is one row
    from its boxes to its entries."""
    pages, ratio = column_ratio(_pages_in_range(words, options), layouts, options.gutter_ratio)
    found = folding.page_entries("boxes", layout.confidences(pages), ratio, profile=options.profile, least=options.min_conf, tol=options.row_tolerance, arabic_first=options.arabic_first, numbered=options.numbered)
    entries = layout.unpacked(pages, ["pdf", "page"], found)
    # What OCR mends is within words, so texts of several rows are mended at once.
    english = tx.fix_ocr(F.col("english"), options.profile)
    english = english if options.profile == "v4" else tx.condense(english)
    return entries.withColumns({"number": tx.number(F.col("number")), "english": english, "y": F.col("y").cast(layout.box_type(pages, "y"))})


def tidy(entries: DataFrame, options: Options, words: DataFrame | None = None, counters: Counters | None = None) -> DataFrame:
    """Cleaned entries without noise, corrected where asked for."""
    profile = options.profile
    english = F.col("english") if profile in ("v2", "v4") else tx.clean_english(F.col("english"))
    arabic = F.col("arabic") if profile == "v4" else tx.clean_arabic(F.col("arabic"), profile)
    # Exploded, as what is only projected is worked out again for every
    # condition of the filter that follows; projected before, as what an
    # explode holds is worked out again wherever it is used within it.
    entries = entries.withColumns({"english": english, "arabic": arabic})
    sides = F.explode_outer(F.array(F.struct("english", "arabic")))
    cleaned = entries.select(*(c for c in entries.columns if c not in ("english", "arabic")), sides.alias("_sides")).select("*", "_sides.*").drop("_sides")
    noise = en.is_noise(F.col("english"), F.col("arabic"), profile)
    if counters:
        cleaned = counters.observe(cleaned, noise)
    cleaned = cleaned.where(~noise)
    if options.correct and words is not None:
        keys = ["pdf", "page", "col", "entry"]
        for side in ("english", "arabic"):
            cleaned = lexicon.correct_text(cleaned, words, keys, side, side if profile == "v3" else None, profile)
    return cleaned


def dictionary(words: DataFrame, options: Options = Options(), lexicon_words: DataFrame | None = None, *, layouts: DataFrame | None = None, counters: Counters | None = None) -> DataFrame:
    """(pdf, id, English, Arabic): first-wins entries of each PDF, numbered.

    Each PDF is numbered by itself, so PDFs are the unit of parallelism.
    ``layouts`` are detected columns, ``counters`` count as the run goes.
    """
    tidied = tidy(raw_entries(words, options, layouts), options, lexicon_words, counters)
    if options.profile == "v4":
        order = [F.col("page"), F.col("col"), F.col("entry")]
    else:
        order = en.entry_order(tidied)
    # One shuffle, by PDF, for the first of each entry and for its number.
    placed = tidied.repartition("pdf").withColumn("_order", F.struct(*(c.alias(f"o{i}") for i, c in enumerate(order))))
    kept = merge.first_wins(placed, [F.col("pdf"), F.lower("english"), F.col("arabic")], ["_order"])

    number = F.row_number().over(Window.partitionBy("pdf").orderBy("_order")).cast("bigint")
    return kept.select("pdf", number.alias("id"), F.col("english").alias("English"), F.col("arabic").alias("Arabic"))


def text_dictionary(lines: DataFrame, profile: str = "v3", strict: bool = True) -> DataFrame:
    """(pdf, id, English, Arabic) of pages with a text layer, from their lines
    (pdf, page, line_no, text)."""

    found = en.fold_text_lines(lines, strict=strict)
    cleaned = found.withColumns({"english": tx.clean_english(F.col("english")), "arabic": tx.clean_arabic(F.col("arabic"), profile)})
    kept = cleaned.where(~en.is_noise(F.col("english"), F.col("arabic"), profile)).withColumn("_order", F.struct("page", "entry"))
    kept = merge.first_wins(kept, [F.col("pdf"), F.lower("english"), F.col("arabic")], ["_order"])
    number = F.row_number().over(Window.partitionBy("pdf").orderBy("_order")).cast("bigint")
    return kept.select("pdf", number.alias("id"), F.col("english").alias("English"), F.col("arabic").alias("Arabic"))
