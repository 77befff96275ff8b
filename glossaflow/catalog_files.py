"""Registered queries of readers, writers, streams and whole runs.

Files are derived from the tables by Spark: formats of text are written and
read back, binary ones are built as columns and handed to their readers. The
SQL is over the tables alone.
"""

from __future__ import annotations

import gzip
import io
import itertools
import uuid
import zipfile
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossaflow.catalog import _CHAPTERS, _LETTERS, _ARABIZE, AR, BOXES, FILLED, ORACLES, S, _clean, _dictionary, _headed, _query, _scanned, _strip, _table, quality_report
from glossaflow.functions import text as tx
from glossaflow.operators import merge, quality
from glossaflow.plans import dictionary, reference_book, samples
from glossaflow.shared import shared_dir
from glossaflow.sinks import files as sinks
from glossaflow.sources import files as sources
from glossaflow.streaming import pages as stream

#: Documents in one built file.
BLOCK = 100


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/glossaflow/{name}-{uuid.uuid4().hex}"


def _blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").withColumn("block", F.floor(F.col("doc_id") / BLOCK))


def _escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def _bytes(text: Column) -> Column:
    return F.encode(text, "UTF-8")


@F.pandas_udf(T.BinaryType())
def _gzipped(content: pd.Series) -> pd.Series:
    return content.map(gzip.compress)


@F.pandas_udf(T.BinaryType())
def _zipped(names: pd.Series, texts: pd.Series) -> pd.Series:
    def pack(members, contents):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
            for member, content in zip(members, contents, strict=True):
                archive.writestr(member, content)
        return out.getvalue()

    return pd.Series([pack(*pair) for pair in zip(names, texts, strict=True)])


def _archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """An archive for each block of rows (block, doc_id, text) in order: a task
    holds one archive and a batch of documents, however many blocks it has."""
    rows = (row for batch in batches for row in zip(*batch.columns, strict=True))
    for block, members in itertools.groupby(rows, key=lambda row: row[0].as_py()):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
            for _, doc, text in members:
                archive.writestr(f"{doc.as_py()}.txt", text.as_py())
        yield pa.RecordBatch.from_arrays([pa.array([f"z{block}.zip"]), pa.array([out.getvalue()], pa.binary())], ["name", "content"])


# --- binary formats ----------------------------------------------------------


@_query("stardict_entries", f"""SELECT (row_number() OVER (PARTITION BY doc_id // {BLOCK} ORDER BY doc_id) - 1)::INT AS pos, 'w' || doc_id AS term,
  {_clean('text')} AS definition, 'd' || doc_id // {BLOCK} AS source_file FROM documents""")
def stardict_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dictionaries of a hundred documents; every other one is of marked text,
    every third one is compressed."""
    word = lambda n: F.unhex(F.lpad(F.hex(n), 8, "0"))
    before = Window.partitionBy("block").orderBy("doc_id").rowsBetween(Window.unboundedPreceding, -1)
    marked = F.concat(F.lit("<p>"), _escaped(F.col("text")), F.lit("</p><script>skipped()</script>"))
    docs = _blocks(spark, sf_dir).withColumn("body", F.when(F.col("block") % 2 == 0, F.col("text")).otherwise(marked)).withColumn("size", F.octet_length("body").cast("bigint"))
    docs = docs.withColumn("at", F.coalesce(F.sum("size").over(before), F.lit(0)))
    record = F.concat(_bytes(F.concat(F.lit("w"), F.col("doc_id"))), F.unhex(F.lit("00")), word(F.col("at")), word(F.col("size")))
    books = docs.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("doc_id", record.alias("record"), "body"))).alias("e"))
    idx = F.unhex(F.array_join(F.transform("e", lambda x: F.hex(x["record"])), ""))
    data = _bytes(F.array_join(F.transform("e", lambda x: x["body"]), ""))
    ifo = _bytes(F.concat(F.lit("StarDict's dict ifo file\nsametypesequence="), F.when(F.col("block") % 2 == 0, "m").otherwise("h"), F.lit("\n")))
    books = books.select(F.concat(F.lit("d"), F.col("block")).alias("stem"), "block", ifo.alias("ifo"), idx.alias("idx"), data.alias("data"))
    part = lambda ending, content: F.struct(F.concat("stem", F.lit(ending)).alias("name"), content.alias("content"))
    plain = books.select("stem", F.inline(F.array(part(".ifo", F.col("ifo")), part(".idx", F.col("idx")))))
    packed = books.where("block % 3 = 0").select("stem", F.concat("stem", F.lit(".dict.dz")).alias("name"), _gzipped("data").alias("content"))
    loose = books.where("block % 3 <> 0").select("stem", F.concat("stem", F.lit(".dict")).alias("name"), F.col("data").alias("content"))
    return sources.stardict_entries(plain.unionByName(packed).unionByName(loose))


@_query("dicthtml_entries", f"""SELECT (row_number() OVER (PARTITION BY doc_id // {BLOCK} ORDER BY doc_id) - 1)::INT AS pos, 'w' || doc_id AS term,
  {_clean('text')} AS definition, 'd' || doc_id // {BLOCK} AS source_file FROM documents""")
def dicthtml_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HTML dictionaries of a hundred documents, every other one compressed;
    a definition's first bold text is not part of it."""
    entry = F.concat(F.lit('<w><a name="w'), F.col("doc_id"), F.lit('"/><div><b>'), F.col("lang"), F.lit("</b>"), _escaped(F.col("text")), F.lit("</div></w>"))
    books = _blocks(spark, sf_dir).groupBy("block").agg(F.sort_array(F.collect_list(F.struct("doc_id", entry.alias("w")))).alias("e"))
    books = books.select("block", F.concat(F.lit("d"), F.col("block")).alias("stem"), _bytes(F.array_join(F.transform("e", lambda x: x["w"]), "\n")).alias("content"))
    packed = books.where("block % 2 = 0").select("stem", _gzipped("content").alias("content"))
    return sources.dicthtml_entries(packed.unionByName(books.where("block % 2 <> 0").select("stem", "content")))


@_query("docx_entries", f"""WITH l AS (SELECT doc_id, unnest(range(len(l)))::INT AS pos, {_clean('unnest(l)')} AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE doc_id % 2 = 1))
SELECT 0::INT AS pos, {_clean('source')} AS term, {_clean('text')} AS definition, 'b' || doc_id AS source_file FROM documents WHERE doc_id % 2 = 0
UNION ALL SELECT pos, line, '', 'b' || doc_id FROM l WHERE line <> ''""")
def docx_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document a DOCX file: a table row with a blank cell, or paragraphs."""
    paragraph = lambda t: F.concat(F.lit("<w:p><w:r><w:t>"), _escaped(t), F.lit("</w:t></w:r></w:p>"))
    lines = F.array_join(F.transform(F.split("text", "\n"), paragraph), "")
    cell = lambda t: F.concat(F.lit("<w:tc>"), t, F.lit("</w:tc>"))
    table = F.concat(F.lit("<w:tbl><w:tr>"), cell(paragraph(F.lit(" "))), cell(paragraph(F.col("source"))), cell(lines), F.lit("</w:tr></w:tbl>"))
    body = F.when(F.col("doc_id") % 2 == 0, table).otherwise(lines)
    xml = F.concat(F.lit('<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body>'), body, F.lit("</w:body></w:document>"))
    files = _table(spark, sf_dir, "documents").select(F.concat(F.lit("b"), F.col("doc_id")).alias("stem"), _zipped(F.array(F.lit("word/document.xml")), F.array(xml)).alias("content"))
    # Cells are read once more to see which files have tables: unpack once.
    return sources.docx_entries(sources.docx_cells(files))


@_query("zip_members", f"SELECT 'z' || doc_id // {BLOCK} || '.zip' AS archive, doc_id || '.txt' AS member, text FROM documents")
def zip_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _blocks(spark, sf_dir).select("block", "doc_id", "text").repartition("block").sortWithinPartitions("block", "doc_id")
    files = docs.mapInArrow(_archives, "name string, content binary")
    members = sources.zip_members(files)
    return members.select("archive", "member", F.decode(sources.refuse_lzo(F.col("content")), "UTF-8").alias("text"))


@_query("file_names", "SELECT page_id, replace(replace(url, ' ', '_'), '/', '_') AS note, replace(replace(replace(replace(replace(url, ' ', '_'), '(', ''), ')', ''), '/', '_'), chr(92), '_') AS archive FROM pages")
def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "pages").select("page_id", tx.note_name(F.col("url")).alias("note"), tx.archive_name(F.col("url")).alias("archive"))


# --- formats of text, written and read back ----------------------------------


@_query("tab_export", "SELECT doc_id::VARCHAR AS term, unnest(string_split(text, chr(10))) AS definition FROM documents")
def tab_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines after their document's id and a tab, and lines without a tab."""
    path = _folder(spark, "tab")
    lines = samples.lines_of(_table(spark, sf_dir, "documents"))
    lines.select(F.explode(F.array(F.concat(F.col("pdf").cast("string"), F.lit("\t"), F.col("text")), F.translate("text", "\t", " "))).alias("value")).write.text(path)
    return sources.read_tab_export(spark, path).select("term", "definition")


@_query("entries_csv", "SELECT lang AS term, text AS definition, 'Book' AS source_file FROM documents")
def entries_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark, "entries")
    sinks.write_entries(_table(spark, sf_dir, "documents").select(F.col("lang").alias("term"), F.col("text").alias("definition")), path, "Book")
    return sources.read_chunks(spark, path).select("term", "definition", "source_file")


@_query("numbered_csv", "SELECT doc_id::VARCHAR AS id, lang AS term, text AS definition, source AS source_file FROM documents")
def numbered_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark, "numbered")
    sinks.write_numbered(_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("term"), F.col("text").alias("definition"), F.col("source").alias("source_file")), path)
    return sources.read_chunks(spark, path).select("id", "term", "definition", "source_file")


@_query("merge_files", f"""WITH e AS (SELECT doc_id, {_strip('text')} AS e, {_strip(_ARABIZE.format('text'))} AS a FROM documents),
firsts AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY lower(e), a ORDER BY doc_id) = 1)
SELECT row_number() OVER (ORDER BY doc_id) AS id, e AS "English", a AS "Arabic" FROM firsts""")
def merge_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bilingual files, written in order and merged by the places of cells."""
    path = _folder(spark, "bilingual")
    # Put in order before there is a second side.
    docs = _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("English")).repartitionByRange("id")
    sinks.write_bilingual(docs.withColumn("Arabic", samples.to_arabic(F.col("English"))), path, placed=True)
    rows = sources.read_chunks(spark, path).withColumn("cells", F.array("id", "English", "Arabic"))
    return merge.merge_positional(rows, ["file", "pos"])


@_query("lines_tsv", f'WITH {FILLED} SELECT "Type", "Section", "Subsection", "Content" FROM filled')
def lines_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structured lines of two chunks, repeats and all."""
    path = _folder(spark, "lines")
    lines = _headed(spark, sf_dir).withColumn("text", tx.strip(F.col("text"))).where("text <> ''")
    sinks.write_lines(reference_book.sections.structure(lines, ["pdf"], ["line_no"], chapters=_CHAPTERS, letters=_LETTERS), path, order=["pdf", "line_no"])
    rows = sources.read_chunks(spark, path, "\t")
    return merge.merge_lines([rows]).select("Type", "Section", "Subsection", "Content")


@_query("lexicon_csv", f"SELECT text AS english, {_ARABIZE.format('text')} AS arabic FROM documents")
def lexicon_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark, "lexicon")
    rows = _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("ID"), F.col("text").alias("English"), samples.to_arabic(F.col("text")).alias("Arabic"))
    rows.write.csv(path, header=True, escape='"')
    return sources.read_lexicon_csv(spark, [path])


@_query("lexicon_json", f"""WITH w AS (SELECT doc_id, unnest(list_filter(regexp_split_to_array(text, '{S}+'), lambda t: t <> '')) AS w FROM documents),
named AS (SELECT 'english' AS lang, w AS word FROM w WHERE doc_id // {BLOCK} % 2 = 0 UNION ALL SELECT 'arabic', {_ARABIZE.format('w')} FROM w WHERE doc_id // {BLOCK} % 2 = 0),
mixed AS (SELECT w FROM w WHERE doc_id // {BLOCK} % 2 = 1 UNION ALL SELECT {_ARABIZE.format('w')} FROM w WHERE doc_id // {BLOCK} % 2 = 1),
listed AS (SELECT CASE WHEN regexp_matches(w, '[A-Za-z]') THEN 'english' ELSE 'arabic' END AS lang, CASE WHEN regexp_matches(w, '[A-Za-z]') THEN lower(w) ELSE w END AS word FROM mixed WHERE regexp_matches(w, '[A-Za-z]') OR regexp_matches(w, '{AR}'))
SELECT lang, word, count(*) AS freq FROM (FROM named UNION ALL FROM listed) GROUP BY lang, word""")
def lexicon_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lexicon file for each hundred documents: two named sides, or a list."""
    path = _folder(spark, "lexicon")
    books = _blocks(spark, sf_dir).groupBy("block").agg(F.flatten(F.collect_list(tx.words(F.col("text")))).alias("w"))
    arabic = F.transform("w", samples.to_arabic)
    value = F.when(F.col("block") % 2 == 0, F.to_json(F.struct(F.col("w").alias("english"), arabic.alias("arabic")))).otherwise(F.to_json(F.concat("w", arabic)))
    # A file holds one value.
    books.select(value.alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return sources.read_lexicon_json(spark, path)


@_query("report_json", ORACLES["quality_report"])
def report_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    report, path = quality_report(spark, sf_dir), _folder(spark, "report")
    sinks.write_report(report, path)
    return spark.read.schema(report.schema).json(path)


# --- streams and whole runs --------------------------------------------------


@_query("page_stream", f'WITH {FILLED} SELECT pdf, (line_no // 4)::INT AS page, (line_no % 4)::INT AS line_no, "Type", "Section", "Subsection", "Content" FROM filled')
def page_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of four lines as a stream that is stopped and taken up again:
    the second run goes on with the sections that the first left open."""
    source, out, state = (_folder(spark, name) for name in ("pages", "structured", "progress"))
    lines = _headed(spark, sf_dir).withColumn("page", F.floor(F.col("line_no") / 4).cast("int"))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line_no", "text"))), lambda x: x["text"]), "\n")
    pages = lines.groupBy("pdf", "page").agg(text.alias("text"))
    # Batches may take files in any order: a document's pages are in one.
    for part in ("page < 2", "page >= 2"):
        pages.where(part).repartition("pdf").write.mode("append").parquet(source)
        stream.ingest(spark, source, out, state, chapters=_CHAPTERS, letters=_LETTERS)
    return spark.read.schema(stream.OUT).parquet(out)


_BOOK = f"""l AS (SELECT doc_id AS pdf, unnest(range(len(l)))::INT AS i, unnest(l) AS raw FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)),
h AS (SELECT pdf, i, raw, {_ARABIZE.format('raw')} AS a FROM l),
m AS (SELECT pdf, i // 4 AS page, i, raw, CASE WHEN i % 9 = 0 THEN 'الفصل ' || a WHEN length(raw) < 59 AND i % 2 = 0 THEN a || ':' WHEN i % 5 = 3 THEN i || '. ' || a ELSE a END AS a FROM h),
g AS (SELECT pdf, page, string_agg(a, chr(10) ORDER BY i) AS body, string_agg(raw, chr(10) ORDER BY i) AS latin FROM m GROUP BY pdf, page),
t AS (SELECT *, CASE pdf % 3 WHEN 0 THEN body WHEN 1 THEN '' ELSE replace(body, 'ه', 'ًًـ') END AS t, CASE WHEN pdf % 2 = 0 THEN body ELSE ' ' END AS ara FROM g),
n AS (SELECT *, length(t) AS n, len(regexp_extract_all(t, '{AR}')) AS ar, len(regexp_extract_all(t, '[\\x{{064B}}-\\x{{0652}}]{{2,}}')) AS marks, len(regexp_extract_all(t, '[\\x{{0621}}-\\x{{063A}}\\x{{0641}}-\\x{{064A}}]{{2,}}')) AS words,
  len(regexp_extract_all(t, '[\\x{{0640}}-\\x{{065F}}\\x{{0670}}-\\x{{06FF}}]')) AS odd, len(regexp_extract_all(t, '[\\x{{0621}}-\\x{{063A}}\\x{{0641}}-\\x{{064A}}]')) AS letters, len(regexp_extract_all(t, '[\\x{{FB50}}-\\x{{FDFF}}\\x{{FE70}}-\\x{{FEFF}}]')) AS forms FROM t),
p AS (SELECT pdf, page, CASE WHEN n > 50 AND ar > n * 0.1 AND NOT (greatest(words, 1) * 0.15 < marks OR forms > 5 OR (letters > 0 AND odd / letters > 0.5)) THEN t ELSE coalesce(nullif({_strip('ara')}, ''), latin) END AS text FROM n),
c AS (SELECT pdf, page, unnest(range(len(c)))::INT AS line_no, unnest(c) AS raw FROM (SELECT pdf, page, string_split(text, chr(10)) AS c FROM p)),
s AS (SELECT pdf, page, line_no, {_strip('raw')} AS x FROM c),
k AS (SELECT *, CASE WHEN regexp_matches(x, '^(مضادات|أدوية|فيتامينات|هرمونات|مستحضرات|أشربة|مراهم|قطرات|تحاميل|لصقات|حقن)') OR regexp_matches(x, '^(الفصل|باب|القسم){S}') THEN 'chapter'
  WHEN regexp_matches(x, '{AR}') AND length(x) < 60 AND x LIKE '%:' THEN 'section' WHEN regexp_matches(x, '^[0-9]+[.)_]') OR regexp_matches(x, '^[-\\x{{2022}}*]') THEN 'list_item'
  WHEN x LIKE '%|%' OR x LIKE '%' || chr(9) || '%' THEN 'table' ELSE 'content' END AS kind FROM s WHERE x <> ''),
q AS (SELECT *, sum((kind = 'chapter')::INT) OVER (PARTITION BY pdf ORDER BY page, line_no) AS ch FROM k),
book AS (SELECT pdf, page::INT AS page, line_no, kind AS "Type",
  coalesce(last_value(CASE WHEN kind = 'chapter' THEN x END IGNORE NULLS) OVER (PARTITION BY pdf ORDER BY page, line_no ROWS UNBOUNDED PRECEDING), '') AS "Section",
  coalesce(last_value(CASE WHEN kind = 'section' THEN x END IGNORE NULLS) OVER (PARTITION BY pdf, ch ORDER BY page, line_no ROWS UNBOUNDED PRECEDING), '') AS "Subsection", x AS "Content" FROM q)"""


def _book(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structured lines of books whose pages have a good text layer, none, or
    a garbled one, and whose Arabic scans are blank in part."""
    lines = samples.lines_of(_table(spark, sf_dir, "documents")).withColumnsRenamed({"page": "i", "text": "raw"})
    i, a = F.col("i"), samples.to_arabic(F.col("raw"))
    arabic = F.when(i % 9 == 0, F.concat(F.lit("الفصل "), a)).when((F.length("raw") < 59) & (i % 2 == 0), F.concat(a, F.lit(":"))).when(i % 5 == 3, F.concat(i.cast("string"), F.lit(". "), a)).otherwise(a)
    rows = lines.withColumns({"page": F.floor(i / 4).cast("int"), "a": arabic})
    joined = lambda c: F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("i", c))), lambda x: x[c]), "\n")
    pages = rows.groupBy("pdf", "page").agg(joined("a").alias("body"), joined("raw").alias("text_both"))
    layer = F.when(F.col("pdf") % 3 == 0, F.col("body")).when(F.col("pdf") % 3 == 1, "").otherwise(F.replace("body", F.lit("ه"), F.lit("ًًـ")))
    scans = pages.select("pdf", "page", layer.alias("text"), F.when(F.col("pdf") % 2 == 0, F.col("body")).otherwise(" ").alias("text_ara"), "text_both")
    return reference_book.structured_lines(reference_book.page_texts(scans))


@_query("book_lines", f"WITH {_BOOK} SELECT * FROM book")
def book_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _book(spark, sf_dir)


@_query("book_report", f"""WITH {_BOOK}, sums AS (SELECT pdf, count(*) AS total_lines, count(*) FILTER ("Type" = 'chapter') AS chapters, count(*) FILTER ("Type" = 'section') AS sections,
  count(*) FILTER ("Type" = 'content') AS content_lines, count(*) FILTER ("Type" = 'content' AND regexp_matches("Content", '{AR}')) AS arabic_lines FROM book GROUP BY pdf)
SELECT *, round_even(coalesce(arabic_lines / nullif(content_lines, 0), 0)::DOUBLE, 3)::DOUBLE AS arabic_content_ratio, coalesce(arabic_lines / nullif(content_lines, 0), 0) > 0.5 AND total_lines > 50 AS pdf_deletable FROM sums""")
def book_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.line_report(_book(spark, sf_dir), ["pdf"])


#: The three scans of ``dual_pass`` instead of the boxes themselves.
_SCANNED = f"""boxes AS (SELECT * EXCLUDE (scan) FROM (
  SELECT *, 1 AS scan FROM boxes0 WHERE regexp_matches(text, '[A-Za-z]')
  UNION ALL SELECT *, 2 FROM boxes0 t WHERE regexp_matches(text, '{AR}') AND NOT EXISTS (SELECT 1 FROM boxes0 o WHERE regexp_matches(o.text, '[A-Za-z]') AND o.pdf = t.pdf AND o.page = t.page AND o.x > t.x - 20 AND o.x < t.x + 20 AND abs(o.y - t.y) < 20)
  UNION ALL SELECT *, 3 FROM boxes0) QUALIFY row_number() OVER (PARTITION BY pdf, page, x, y, text ORDER BY scan, pos DESC) = 1)"""
_DUAL = _dictionary("v3").replace(BOXES, f"{BOXES.replace('boxes AS (', 'boxes0 AS (')}, {_SCANNED}")


@_query("dual_dictionary", f"""WITH d AS ({_DUAL}), c AS (SELECT pdf, count(*) AS total_entries, count(*) FILTER ("English" <> '') AS entries_with_english, count(*) FILTER ("Arabic" <> '') AS entries_with_arabic,
  count(*) FILTER ("English" <> '' AND "Arabic" <> '') AS entries_with_both, round_even(avg(length("English"))::DOUBLE, 1)::DOUBLE AS avg_english_len, round_even(avg(length("Arabic"))::DOUBLE, 1)::DOUBLE AS avg_arabic_len FROM d GROUP BY pdf)
SELECT *, round_even((entries_with_both / total_entries)::DOUBLE, 3)::DOUBLE AS estimated_accuracy, entries_with_both / total_entries > 0.7 AND total_entries > 100 AS pdf_deletable FROM c""")
def dual_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of a whole run over three scans of each page."""
    return quality.entry_report(dictionary.dictionary(_scanned(spark, sf_dir), dictionary.Options("v3")), ["pdf"], profile="v3")
