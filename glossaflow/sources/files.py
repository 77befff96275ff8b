"""Readers of dictionary files, as DataFrames.

All bytes come through Spark's own readers, so any store that Spark opens will
do. A file is the unit of work; its parser turns one row into many.
"""

from __future__ import annotations

import csv
import gzip
import io
import itertools
import lzma
import re
import struct
import xml.etree.ElementTree as ET
import zipfile
import zlib
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossaflow.functions import text as tx
from glossaflow.shared import materialize

ENTRY = "pos int, term string, definition string, source_file string"
GZIP = b"\x1f\x8b"
LZO = b"\x89LZO"


def binary_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(path, name, stem, content) of files."""
    reader = spark.read.format("binaryFile")
    files = (reader.option("pathGlobFilter", glob) if glob else reader).load(path)
    name = F.element_at(F.split("path", "/"), -1)
    return files.select("path", name.alias("name"), F.regexp_replace(name, r"(\.dict\.dz|\.[^.]*)$", "").alias("stem"), "content")


def gunzip(data: bytes) -> bytes:
    return gzip.decompress(data) if data[:2] == GZIP else data


def refuse_lzo(content: Column) -> Column:
    """The bytes, or an error for LZO-compressed ones."""
    return F.when(F.substring(content, 1, 4) == F.lit(LZO), F.raise_error(F.lit("LZO compression is not supported")).cast("binary")).otherwise(content)


#: Files up to whose number the relation of first lines is broadcast.
FEW_FILES = 100_000
#: Most rows of a file that are handed on at once.
BATCH_ROWS = 4096


def _parsed(files: DataFrame, parse: Callable[[dict], Iterable[tuple]], schema: str, names: list[str]) -> DataFrame:
    """``parse`` of each file's row, exploded; ``names`` are its columns."""
    types = {"pos": pa.int32(), "table": pa.int32(), "row": pa.int32(), "cells": pa.list_(pa.string())}
    fields = pa.schema([(n, types.get(n, pa.string())) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                for found in itertools.batched(parse(row), BATCH_ROWS):
                    yield pa.RecordBatch.from_pylist([dict(zip(names, x, strict=True)) for x in found], fields)

    return files.mapInArrow(run, schema)


class _Text(HTMLParser):
    """Text outside scripts, styles and links, with blanks between pieces."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.hidden = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.hidden += tag in ("script", "style")

    def handle_endtag(self, tag: str) -> None:
        self.hidden -= tag in ("script", "style") and self.hidden > 0

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            self.parts.append(data)


def squeeze(text: str) -> str:
    """As :func:`glossaflow.functions.text.clean`, for parsers."""
    return " ".join(text.replace("\xa0", " ").replace("\u200b", "").replace("\u200f", "").split())


def html_text(html: str) -> str:
    parser = _Text()
    parser.feed(html)
    parser.close()
    return squeeze(" ".join(parser.parts))


def index_records(idx: bytes) -> Iterator[tuple[str, int, int]]:
    """(word, offset, size) of an index; a cut-off tail ends it."""
    at = 0
    while (end := idx.find(b"\0", at)) >= 0 and end + 9 <= len(idx):
        offset, size = struct.unpack_from(">II", idx, end + 1)
        yield idx[at:end].decode("utf-8", "replace"), offset, size
        at = end + 9


def read_stardict(spark: SparkSession, folder: str) -> DataFrame:
    """(pos, term, definition, source_file) of a folder's StarDict files."""
    return stardict_entries(binary_files(spark, folder, "*.{ifo,idx,dict,dz}"))


def stardict_entries(files: DataFrame) -> DataFrame:
    """(pos, term, definition, source_file) of StarDict dictionaries, from
    files (name, stem, content).

    Definitions of type ``h`` or ``x`` lose their markup. Compressed data are
    preferred where both forms are there.
    """
    kind = F.regexp_extract("name", r"\.(ifo|idx|dict\.dz|dict)$", 1)
    content = lambda k: F.max(F.when(kind == k, F.col("content")))
    whole = files.groupBy("stem").agg(content("ifo").alias("ifo"), content("idx").alias("idx"), F.coalesce(content("dict.dz"), content("dict")).alias("dict"))

    def parse(row: dict) -> Iterator[tuple]:
        info = dict(line.split("=", 1) for line in row["ifo"].decode("utf-8", "replace").splitlines() if "=" in line)
        data, marked = gunzip(row["dict"]), info.get("sametypesequence", "").strip()[:1] in ("h", "x")
        tidy = html_text if marked else squeeze
        return ((i, word, tidy(data[a : a + n].decode("utf-8", "replace")), row["stem"]) for i, (word, a, n) in enumerate(index_records(row["idx"])))

    complete = whole.where("ifo is not null and idx is not null and dict is not null")
    return _parsed(complete, parse, ENTRY, ["pos", "term", "definition", "source_file"])


class _Words(HTMLParser):
    """Entries of ``<w>`` elements: the first anchor's name as it is, or else
    the first bold text, is the term; the first block without its first bold
    text is the definition, or all text where there is no block."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.found: list[tuple[str, str]] = []
        self.open = False

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "w":
            self.open, self.anchor, self.depth, self.blocks, self.bolds = True, None, 0, 0, 0
            self.bold, self.block, self.all, self.in_bold, self.skip, self.taken = [], [], [], 0, False, False
        elif self.open and tag == "a" and self.anchor is None:
            self.anchor = dict(attrs).get("name") or ""
        elif self.open and tag == "div":
            self.blocks += self.depth == 0
            self.depth += 1
        elif self.open and tag == "b":
            self.bolds += self.in_bold == 0
            self.in_bold += 1
            if self.depth and self.blocks == 1 and not self.taken:
                self.skip, self.taken = True, True

    def handle_endtag(self, tag: str) -> None:
        if not self.open:
            return
        if tag == "div" and self.depth:
            self.depth -= 1
        elif tag == "b" and self.in_bold:
            self.in_bold -= 1
            self.skip = self.skip and self.in_bold > 0
        elif tag == "w":
            if term := self.anchor or "".join(t.strip() for t in self.bold):
                self.found.append((term, squeeze(" ".join(self.block if self.blocks else self.all))))
            self.open = False

    def handle_data(self, data: str) -> None:
        if not self.open:
            return
        self.all.append(data)
        if self.in_bold and self.bolds == 1:
            self.bold.append(data)
        if self.depth and self.blocks == 1 and not self.skip:
            self.block.append(data)


def read_dicthtml(spark: SparkSession, folder: str) -> DataFrame:
    """(pos, term, definition, source_file) of a folder's HTML dictionaries."""
    return dicthtml_entries(binary_files(spark, folder, "*.html"))


def html_entries(content: bytes) -> list[tuple[str, str]]:
    """(term, definition) of an HTML file, gzipped or not."""
    words = _Words()
    words.feed(gunzip(content).decode("utf-8", "replace"))
    words.close()
    return words.found


def dicthtml_entries(files: DataFrame) -> DataFrame:
    """(pos, term, definition, source_file) of HTML files (stem, content) of
    ``<w>`` entries, gzipped or not; files that cannot be read are left out."""

    def parse(row: dict) -> list[tuple]:
        try:
            found = html_entries(row["content"])
        except (OSError, EOFError, ValueError, AssertionError, zlib.error):
            return []
        return [(i, term, definition, row["stem"]) for i, (term, definition) in enumerate(found)]

    return _parsed(files.select("stem", "content"), parse, ENTRY, ["pos", "term", "definition", "source_file"])


_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def _docx_parts(content: bytes) -> tuple[list[tuple[int, int, list[str]]], list[tuple[int, str]]]:
    """Table rows (table, row, cells) and paragraphs (place, text) of a file."""

    def text(node: ET.Element) -> str:
        return "".join(t.text or "" for t in node.iter(f"{_W}t"))

    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        body = ET.fromstring(archive.read("word/document.xml")).find(f"{_W}body")
    rows = [(t, r, ["\n".join(map(text, cell.iter(f"{_W}p"))) for cell in line.findall(f"{_W}tc")]) for t, table in enumerate(body.findall(f"{_W}tbl")) for r, line in enumerate(table.findall(f"{_W}tr"))]
    return rows, [(i, text(p)) for i, p in enumerate(body.findall(f"{_W}p"))]


def docx_rows(content: bytes) -> Iterator[tuple[int, str, str]]:
    """(pos, term, definition) of a file: its table rows, or its paragraphs
    where no table has an entry."""
    rows, paragraphs = _docx_parts(content)
    full = [(t * 1_000_000 + r, [c for c in cells if c.strip()]) for t, r, cells in rows]
    entries = [(pos, squeeze(cells[0]), squeeze(" ".join(cells[1:]))) for pos, cells in full if cells]
    yield from (e for e in entries if e[1] or e[2])
    if not any(e[1] or e[2] for e in entries):
        yield from ((i, squeeze(p), "") for i, p in paragraphs if squeeze(p))


def docx_cells(files: DataFrame) -> DataFrame:
    """(file, kind, table, row, cells): table rows and paragraphs of DOCX
    files (stem, content)."""

    def parse(row: dict) -> list[tuple]:
        rows, paragraphs = _docx_parts(row["content"])
        return [(row["stem"], "table", *r) for r in rows] + [(row["stem"], "paragraph", 0, i, [p]) for i, p in paragraphs]

    return _parsed(files.select("stem", "content"), parse, "file string, kind string, table int, row int, cells array<string>", ["file", "kind", "table", "row", "cells"])


def cells_to_entry(cells: Column) -> tuple[Column, Column, Column]:
    """(term, definition, kept) of a table row: blank cells out, the first is
    the term, the rest the definition; kept if either is there."""
    full = F.filter(cells, lambda c: c.isNotNull() & (tx.strip(c) != ""))
    term = tx.clean(F.try_element_at(full, F.lit(1)))
    definition = tx.clean(F.array_join(F.slice(full, 2, F.greatest(F.size(full) - 1, F.lit(0))), " "))
    return term, definition, (term != "") | (definition != "")


def cell_entries(rows: DataFrame, keys: list[str], cells: str = "cells") -> DataFrame:
    """(keys, term, definition) of table rows (S6, S7)."""
    term, definition, kept = cells_to_entry(F.col(cells))
    return rows.where(kept).select(*keys, term.alias("term"), definition.alias("definition"))


def read_docx(spark: SparkSession, path: str, *, strict: bool = False) -> DataFrame:
    """(pos, term, definition, source_file) of DOCX files."""
    return docx_entries(docx_cells(binary_files(spark, path, "*.docx")), strict=strict)


def docx_entries(cells: DataFrame, *, strict: bool = False) -> DataFrame:
    """(pos, term, definition, source_file) of :func:`docx_cells`: table rows,
    or the paragraphs of files that have no table entries."""
    tables = cell_entries(cells.where("kind = 'table'"), ["file", "table", "row"])
    term, definition = tx.split_columns(F.col("cells")[0], strict=strict)
    paragraphs = cells.where("kind = 'paragraph'").join(tables.select("file").distinct(), "file", "left_anti").select("file", "table", "row", term.alias("term"), definition.alias("definition")).where("term <> ''")
    both = tables.unionByName(paragraphs)
    return both.select((F.col("table") * 1_000_000 + F.col("row")).cast("int").alias("pos"), "term", "definition", F.col("file").alias("source_file"))


def read_tab_export(spark: SparkSession, path: str, *, placed: bool = False) -> DataFrame:
    """(term, definition, source_file) of lines cut at their first tab; where
    ``placed``, (block, pos) too: where the part of the file begins that the line
    is in, and a number that grows within it."""
    place = (F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("pos")) if placed else ()
    lines = spark.read.text(path).select("value", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("source_file"), *place).where(F.contains("value", F.lit("\t")))
    parts = F.split("value", "\t", 2)
    return lines.select(parts[0].alias("term"), parts[1].alias("definition"), "source_file", *(("block", "pos") if placed else ()))


def read_zip(spark: SparkSession, path: str) -> DataFrame:
    """(archive, member, content) of the files in ZIP archives."""
    return zip_members(binary_files(spark, path, "*.zip"))


def zip_members(files: DataFrame) -> DataFrame:
    """(archive, member, content) of archives (name, content), one member at a
    time. Broken archives are left out, and so are members that are damaged,
    encrypted or packed by a method that is not known; ``sources.archives`` has
    a row with the reason for each."""
    damage = (zipfile.BadZipFile, zlib.error, lzma.LZMAError, EOFError, OSError, struct.error, NotImplementedError, RuntimeError)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # One archive at a time is copied out of the batch.
            for name, packed in zip(*batch.columns, strict=True):
                try:
                    archive = zipfile.ZipFile(io.BytesIO(packed.as_py()))
                except damage:
                    continue
                for info in archive.infolist():
                    try:
                        content = None if info.is_dir() else archive.read(info)
                    except damage:
                        continue
                    if content is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([name.as_py()]), pa.array([info.filename]), pa.array([content], pa.binary())], ["archive", "member", "content"])

    return files.select("name", "content").mapInArrow(run, "archive string, member string, content binary")


# Headers that name the two sides of a lexicon.
ENGLISH_HEADERS = ("english", "term", "en", "eng")
ARABIC_HEADERS = ("arabic", "definition", "ar", "ara")


def lexicon_columns(header: list[str]) -> tuple[int | None, int | None]:
    """Places of the English and Arabic columns; the last match wins."""
    at = {side: None for side in ("en", "ar")}
    for i, name in enumerate(header):
        tidy = name.strip().lstrip("\ufeff").lower()
        at["en"] = i if tidy in ENGLISH_HEADERS else at["en"]
        at["ar"] = i if tidy in ARABIC_HEADERS else at["ar"]
    return at["en"], at["ar"]


@dataclass(frozen=True)
class Records:
    """Records of files with headers of their own: ``rows`` (file, pos, line,
    cells), ``line`` the first line of the file; and the cells of each distinct
    first line. Empty cells are empty, those that a short row lacks are null."""

    rows: DataFrame
    shapes: dict[str, list[str]]

    def place(self, choose: Callable[[list[str]], int | None]) -> Column:
        """The cell that ``choose`` finds by a file's header, or null."""
        at = {line: choose(names) for line, names in self.shapes.items()}
        pairs = [F.lit(x) for line, i in at.items() if i is not None for x in (line, i)]
        if not pairs:
            return F.lit(None).cast("string")
        return F.get("cells", F.try_element_at(F.create_map(*pairs), F.col("line")))

    def named(self, name: str) -> Column:
        """The cell under ``name``; of equal names the last."""
        return self.place(lambda names: next((i for i in reversed(range(len(names))) if names[i] == name), None))


def read_records(spark: SparkSession, paths: str | Sequence[str], sep: str = ",", glob: str | None = None) -> Records:
    """Delimited files, each read by its own header, in one plan.

    The first lines are a relation of their own (file, line). There are few
    distinct ones, whatever the number of files: they are cut into names here,
    and one scan reads all records, as wide as the widest header, and meets its
    file's line.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    more = {"pathGlobFilter": glob} if glob else {}
    file = F.col("_metadata.file_path").alias("file")
    lines = spark.read.options(**more).text(paths).select(file, F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("n"), "value")
    first = materialize(lines.where("start = 0").groupBy("file").agg(F.min_by("value", "n").alias("line")), "first-lines")
    shapes = {}
    for row in first.select("line").distinct().toLocalIterator():
        names = next(csv.reader([row["line"].rstrip("\r")], delimiter=sep), [])
        if names:
            shapes[row["line"]] = [n.lstrip("\ufeff") for n in names]
    width = max([3, *map(len, shapes.values())])
    schema = T.StructType([*(T.StructField(f"_c{i}", T.StringType()) for i in range(width)), T.StructField("_raw", T.StringType())])
    settings = {"header": True, "multiLine": True, "escape": '"', "sep": sep, "nullValue": "\0", "enforceSchema": True, "columnNameOfCorruptRecord": "_raw", **more}
    rows = spark.read.schema(schema).options(**settings).csv(paths)
    # Rows of another length come with their own text.
    held = F.size(F.split(F.regexp_replace("_raw", '"[^"]*"', "x"), re.escape(sep)))
    present = F.when(F.col("_raw").isNull(), width).otherwise(held)
    cells = F.array(*(F.when(present > i, F.coalesce(f"_c{i}", F.lit(""))) for i in range(width)))
    kept = rows.select(file, F.monotonically_increasing_id().alias("pos"), cells.alias("cells"))
    # A row for each file: broadcast while these are few.
    few = F.broadcast(first) if first.count() <= FEW_FILES else first
    return Records(kept.join(few, "file").select("file", "pos", "line", "cells"), shapes)


def read_lexicon_csv(spark: SparkSession, paths: list[str], profile: str = "v3") -> DataFrame:
    """(english, arabic) of CSV files and folders of them, by their headers or
    else by place: the last two of two columns (``v3``), the second and third
    of three or more. Empty files are left out."""
    known = [p for p in paths if not spark.read.option("pathGlobFilter", "*.csv").text(p).isEmpty()]
    if not known:
        return spark.createDataFrame([], "english string, arabic string")
    found = read_records(spark, known, glob="*.csv")

    def sides(names: list[str]) -> tuple[int | None, int | None]:
        en, ar = lexicon_columns(names)
        if en is None and ar is None:
            en, ar = (1, 2) if len(names) >= 3 else (0, 1) if len(names) == 2 and profile == "v3" else (None, None)
        return en, ar

    side = lambda n: F.coalesce(found.place(lambda names: sides(names)[n]), F.lit(""))
    return found.rows.select(side(0).alias("english"), side(1).alias("arabic"))


def read_lexicon_json(spark: SparkSession, path: str) -> DataFrame:
    """(lang, word, freq) of ``{"english": [...], "arabic": [...]}`` or of a
    list, whose words are told apart by script."""
    whole = spark.read.text(path, wholetext=True).select("value")
    named = whole.select(F.from_json("value", "english array<string>, arabic array<string>").alias("j"))
    sides = [named.select(F.lit(lang).alias("lang"), F.explode(f"j.{lang}").alias("word")) for lang in ("english", "arabic")]
    listed = whole.where(tx.strip(F.col("value")).startswith("[")).select(F.explode(F.from_json("value", "array<string>")).alias("word"))
    listed = listed.select(tx.strip(F.col("word")).alias("word"))
    # Latin letters come first: a word of both scripts is an English one.
    latin = tx.has_latin(F.col("word"))
    listed = listed.where(latin | tx.has_arabic(F.col("word"))).select(F.when(latin, "english").otherwise("arabic").alias("lang"), F.when(latin, F.lower("word")).otherwise(F.col("word")).alias("word"))
    words = sides[0].unionByName(sides[1]).unionByName(listed)
    return words.groupBy("lang", "word").agg(F.count("*").alias("freq"))


def read_chunks(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Rows of chunk files with ``file``, ``pos`` and ``cells``, in the order of
    the files' names (``chunk10`` before ``chunk2``), and a column for each name
    in any header, filled by the file's own. Empty cells are empty; those that
    a short row or a file's header lacks are null."""
    found = read_records(spark, path, sep)
    names = dict.fromkeys(n for shape in found.shapes.values() for n in shape if n not in ("file", "pos", "cells"))
    return found.rows.select(*(found.named(n).alias(n) for n in names), "file", "pos", "cells")
