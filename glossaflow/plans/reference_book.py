"""From page texts of a reference book to structured lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossaflow.operators import lexicon, sections


def page_texts(pages: DataFrame, *, incremental: bool = False, strict: bool = False) -> DataFrame:
    """(pdf, page, text) with the text layer where it can be used, else the
    Arabic scan, else the bilingual one. Input: pdf, page, text, text_ara,
    text_both."""
    route = sections.text_route(F.col("text"), presentation=not incremental, strict=strict)
    scan = sections.with_fallback(F.col("text_ara"), F.col("text_both"))
    return pages.select("pdf", "page", F.when(route == "text", F.col("text")).otherwise(scan).alias("text"))


def structured_lines(pages: DataFrame, *, incremental: bool = False, lexicon_words: DataFrame | None = None, **kinds) -> DataFrame:
    """(pdf, page, line_no, Type, Section, Subsection, Content) of (pdf, page,
    text). Sections are named by their lines as read; only Content is
    corrected."""
    lines = sections.page_lines(pages, ["pdf", "page"])
    out = sections.structure(lines, ["pdf"], ["page", "line_no"], bullets=not incremental, **kinds)
    if lexicon_words is not None:
        out = lexicon.correct_text(out, lexicon_words, ["pdf", "page", "line_no"], "Content", None, "v4")
    return out
