"""Word boxes and bilingual lines derived from the documents table.

The scanner's output is an input of this library; where only running text is
at hand these relations stand in for it. Every third token is put into Arabic
letters, some are numbers, some of both scripts, and places on the page follow
from a token's position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossaflow.operators import layout

LATIN_LETTERS = "abcdefghijklmnopqrstuvwxyz"
ARABIC_LETTERS = "ابتثجحخدذرزسشصضطظعغفقكلمنه"
WIDTH = 1000


def to_arabic(text):
    return F.translate(F.lower(text), LATIN_LETTERS, ARABIC_LETTERS)


def lines_of(docs: DataFrame) -> DataFrame:
    """(pdf, page, text): each document a file, each of its lines a page."""
    return docs.select(F.col("doc_id").alias("pdf"), F.posexplode(F.split("text", "\n")).alias("page", "text"))


def page_boxes(docs: DataFrame) -> DataFrame:
    """(pdf, page, boxes): a page of a scanner's output a row, its boxes an
    array of (pos, text, x, y, w, h, conf, width)."""

    def printed(token, i):
        arabic = to_arabic(token)
        return (
            F.when(i % 7 == 3, (i * 31 % 4000).cast("string"))
            .when(i % 11 == 5, F.concat(token, arabic))
            .when(i % 3 == 1, arabic)
            .otherwise(token)
        )

    # Cut once, in a row of its own, as each of the arrays below goes over them.
    # An array for each field is far cheaper than a struct for each token.
    tokens = lines_of(docs).select("pdf", "page", F.explode(F.array(F.array_remove(F.split("text", " "), ""))).alias("t"))
    each = lambda f: F.transform("t", lambda t, i: f(i))
    fields = {
        "pos": each(lambda i: i), "text": F.transform("t", printed), "x": each(lambda i: i * 173 % 900), "y": each(lambda i: (i - i % 7) * 2 + i * 5 % 9),
        "w": F.array_repeat(F.lit(40), F.size("t")), "h": F.array_repeat(F.lit(12), F.size("t")), "conf": each(lambda i: i * 7 % 100), "width": F.array_repeat(F.lit(WIDTH), F.size("t")),
    }
    boxes = F.arrays_zip(*(F.col(c) for c in fields))
    return tokens.select("pdf", "page", *(c.alias(k) for k, c in fields.items())).select("pdf", "page", boxes.alias("boxes"))


def word_boxes(docs: DataFrame) -> DataFrame:
    """(pdf, page, pos, text, x, y, w, h, conf, width)."""
    return layout.unpacked(page_boxes(docs), ["pdf", "page"], F.col("boxes"))


def bilingual_lines(docs: DataFrame) -> DataFrame:
    """(pdf, page, line_no, text): lines of one or both scripts."""
    lines = docs.select(F.col("doc_id").alias("pdf"), F.posexplode(F.split("text", "\n")).alias("i", "raw"))
    i, raw = F.col("i"), F.col("raw")
    text = F.when(i % 3 == 0, F.concat(raw, F.lit(" "), to_arabic(raw))).when(i % 3 == 1, to_arabic(raw)).otherwise(raw)
    return lines.select("pdf", F.floor(i / 4).cast("int").alias("page"), F.col("i").alias("line_no"), text.alias("text"))
