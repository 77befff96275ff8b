"""The relations that the operators read and write."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(ddl: str) -> T.StructType:
    kinds = {"string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "binary": T.BinaryType()}
    fields = []
    for part in ddl.split(", "):
        name, kind = part.split(" ")
        nested = T.ArrayType(T.StringType()) if kind == "strings" else None
        fields.append(T.StructField(name, nested or kinds[kind]))
    return T.StructType(fields)


ENTRY = _struct("term string, definition string, source_file string")
NUMBERED = _struct("id bigint, term string, definition string, source_file string")
BILINGUAL = _struct("id bigint, English string, Arabic string")
STRUCTURED_LINE = _struct("Type string, Section string, Subsection string, Content string")
WORD_BOX = _struct("pdf bigint, page int, pos int, text string, x int, y int, w int, h int, conf int, width int")
PAGE_TEXT = _struct("pdf bigint, page int, text string")
PAGE_SCANS = _struct("pdf bigint, page int, text string, text_ara string, text_both string")
PDF_CELLS = _struct("pdf bigint, page int, table int, row int, cells strings")
PAGE_LAYOUT = _struct("pdf bigint, page int, is_scanned boolean, has_text boolean, num_columns int, gutter_x int, page_width int, page_height int, image_w int, image_h int")
COLUMN_INK = _struct("pdf bigint, page int, x int, ink double, width int")
WORKING_ENTRY = _struct("pdf bigint, page int, col int, entry int, number bigint, english string, arabic string, y int")
LEXICON = _struct("lang string, word string, freq bigint")
STATUS = _struct("name string, csv_name string, format string, rows bigint, status string")
