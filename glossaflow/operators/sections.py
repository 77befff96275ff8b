"""Chapters and sections of structured text lines, and page routing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glossaflow.functions import text as tx


def text_route(text: Column, *, letters: str = tx.ARABIC, presentation: bool = True, strict: bool = False) -> Column:
    """``text`` for pages whose text layer can be used, else ``ocr``: over 50
    characters, over a tenth of them Arabic, and not garbled."""
    body = F.coalesce(text, F.lit(""))
    enough = (F.length(body) > 50) & (tx.count_of(body, letters) > F.length(body) * 0.1)
    return F.when(enough & ~tx.is_garbled(body, presentation=presentation, strict=strict), "text").otherwise("ocr")


def is_text_page(text: Column, scanned: Column) -> Column:
    """Pages with a text layer worth reading instead of scanning."""
    return (F.length(tx.strip(F.coalesce(text, F.lit("")))) > 100) & ~scanned


def with_fallback(first: Column, second: Column) -> Column:
    """The first scan's text, or the second's where the first is blank."""
    return F.coalesce(F.nullif(tx.strip(first), F.lit("")), second)


def page_lines(pages: DataFrame, keys: Sequence[str], text: str = "text") -> DataFrame:
    """(keys, line_no, text): the non-blank lines of each page, trimmed."""
    cut = pages.select(*keys, F.posexplode(F.split(F.coalesce(text, F.lit("")), "\n")).alias("line_no", "raw"))
    return cut.select(*keys, "line_no", tx.strip(F.col("raw")).alias("text")).where("text <> ''")


def fill_sections(lines: DataFrame, document: Sequence[str], order: Sequence[str], kind: str = "Type", text: str = "text") -> DataFrame:
    """``lines`` with Section and Subsection carried forward.

    A chapter line sets Section and clears Subsection, a section line sets
    Subsection; both hold until the next one of the same document, over pages.
    """
    so_far = Window.partitionBy(*document).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    chapter = F.col(kind) == "chapter"
    counted = lines.withColumns({"Section": F.coalesce(F.last(F.when(chapter, F.col(text)), True).over(so_far), F.lit("")), "_chapter": F.sum(chapter.cast("int")).over(so_far)})
    within = Window.partitionBy(*document, "_chapter").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    filled = F.coalesce(F.last(F.when(F.col(kind) == "section", F.col(text)), True).over(within), F.lit(""))
    return counted.withColumn("Subsection", filled).drop("_chapter")


def structure(lines: DataFrame, document: Sequence[str], order: Sequence[str], **kinds) -> DataFrame:
    """Lines (text) as (document, order, Type, Section, Subsection, Content)."""
    typed = lines.withColumn("Type", tx.content_type(F.col("text"), **kinds))
    return fill_sections(typed, document, order).select(*document, *order, "Type", "Section", "Subsection", F.col("text").alias("Content"))
