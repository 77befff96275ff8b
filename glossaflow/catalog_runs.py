"""Registered queries of files read in parts, of headers and of conversions.

Files are built of the tables by Spark, written to the shared folder and read
back; the SQL is over the tables alone.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossaflow.catalog import _ARABIZE, _CHAPTERS, _LETTERS, BOXES, ORACLES, _boxes, _clean, _dictionary, _folded, _headed, _noise, _pages, _query, _strip, _table, _tidied_arabic, _tidied_english, quality_report
from glossaflow.catalog_files import BLOCK, _blocks, _escaped, _folder
from glossaflow.functions import text as tx
from glossaflow.operators import layout, merge
from glossaflow.plans import built, conversion, dictionary, samples
from glossaflow.sinks import files as sinks
from glossaflow.sources import datasources
from glossaflow.sources import files as sources
from glossaflow.streaming import pages as stream

#: Documents of one dictionary that is read in parts, and bytes of a part.
BOOK, PART = 1000, 1 << 18


@F.pandas_udf(T.BinaryType())
def _mdx(words: pd.Series, bodies: pd.Series, kind: pd.Series) -> pd.Series:
    """MDict files of both versions, both widths, and with a secret index."""
    forms = ({}, {"wide": True}, {"secret": True}, {"new": False})
    return pd.Series([built.mdx(list(zip(w, b, strict=True)), block=8192, header="utf-8" if k % 3 == 0 else "utf-16-le", **forms[k % 4]) for w, b, k in zip(words, bodies, kind, strict=True)])


_STAR = T.StructType([T.StructField(n, T.BinaryType()) for n in ("ifo", "idx", "dict")])


@F.pandas_udf(_STAR)
def _stardict(words: pd.Series, bodies: pd.Series, kind: pd.Series) -> pd.DataFrame:
    """StarDict files; every other one has a chunk table, some wide offsets."""
    rows = []
    for w, b, k in zip(words, bodies, kind, strict=True):
        ifo, idx, data = built.stardict(list(zip(w, b, strict=True)), "h", wide=k % 3 == 0)
        rows.append((ifo, idx, built.dictzip(data, 32_768) if k % 2 else data))
    return pd.DataFrame(rows, columns=["ifo", "idx", "dict"])


def _books(docs: DataFrame, size: int) -> DataFrame:
    """(book, words, bodies): entries of so many documents each, in order."""
    marked = F.concat(F.lit("<p>"), _escaped(F.col("text")), F.lit("</p><script>skipped()</script>"))
    entry = F.struct("doc_id", F.concat(F.lit("w"), F.col("doc_id")).alias("w"), marked.alias("b"))
    books = docs.groupBy(F.floor(F.col("doc_id") / size).cast("int").alias("book")).agg(F.sort_array(F.collect_list(entry)).alias("e"))
    return books.select("book", F.transform("e", lambda x: x["w"]).alias("words"), F.transform("e", lambda x: x["b"]).alias("bodies"))


def _entries_sql(size: int, prefix: str) -> str:
    return f"""SELECT (row_number() OVER (PARTITION BY doc_id // {size} ORDER BY doc_id) - 1)::INT AS pos, 'w' || doc_id AS term,
  {_clean('text')} AS definition, '{prefix}' || doc_id // {size} AS source_file FROM documents"""


def _mdx_folder(spark: SparkSession, sf_dir: str) -> str:
    path, books = _folder(spark, "mdx"), _books(_table(spark, sf_dir, "documents"), BLOCK)
    sinks.write_files(books.select(F.concat(F.lit("m"), F.col("book"), F.lit(".mdx")).alias("name"), _mdx("words", "bodies", "book").alias("content")), path)
    return path


@_query("mdx_entries", _entries_sql(BLOCK, "m"))
def mdx_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MDict files, each read in parts of its key blocks."""
    return datasources.read_entries(spark, "mdx", _mdx_folder(spark, sf_dir), partBytes=PART)


@_query("stardict_parts", _entries_sql(BOOK, "s"))
def stardict_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """StarDict dictionaries of a thousand documents, each read by many tasks
    that cut their own slices out of its data."""
    path, books = _folder(spark, "stardict"), _books(_table(spark, sf_dir, "documents"), BOOK)
    files = books.select("book", _stardict("words", "bodies", "book").alias("f"))
    part = lambda ending, c: F.struct(F.concat(F.lit("s"), F.col("book"), ending).alias("name"), F.col(f"f.{c}").alias("content"))
    data = part(F.when(F.col("book") % 2 == 1, ".dict.dz").otherwise(".dict"), "dict")
    sinks.write_files(files.select(F.inline(F.array(part(F.lit(".ifo"), "ifo"), part(F.lit(".idx"), "idx"), data))), path)
    return datasources.read_entries(spark, "stardict", path, partBytes=PART)


_ORDERS = (("id", "term", "definition", "source_file"), ("definition", "source_file", "term", "id"), ("source_file", "more", "id", "definition", "term"), ("term", "definition"))


@_query("merge_headers", f"""WITH e AS (SELECT doc_id, 'chunk' || doc_id // {BLOCK} || '.csv' AS file, {_strip("string_split(text, chr(10))[1]")} AS term, {_strip(_ARABIZE.format("source || ' ' || lang"))} AS definition,
  CASE WHEN doc_id // {BLOCK} % 4 = 3 THEN '' ELSE {_strip('source')} END AS source_file FROM documents),
firsts AS (SELECT * FROM e WHERE term <> '' AND definition <> '' QUALIFY row_number() OVER (PARTITION BY lower(term), definition ORDER BY file, doc_id) = 1)
SELECT row_number() OVER (ORDER BY file, doc_id) AS id, term, definition, source_file FROM firsts""")
def merge_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunk files of a hundred documents with their columns in four orders,
    the last with two columns only, each with a short row at its end."""
    docs = _blocks(spark, sf_dir).select(
        "block", "doc_id", F.col("doc_id").cast("string").alias("id"), F.split("text", "\n")[0].alias("term"),
        samples.to_arabic(F.concat_ws(" ", "source", "lang")).alias("definition"), F.col("source").alias("source_file"), F.lit("x,\"y\"\nz").alias("more"),
    )
    line = lambda order: F.to_csv(F.struct(*order), {"escape": '"', "quoteAll": "true"})
    lines = reduce(lambda c, i: c.when(F.col("block") % 4 == i, line(_ORDERS[i])), range(4), F.when(F.lit(False), ""))
    head = reduce(lambda c, i: c.when(F.col("block") % 4 == i, ",".join(_ORDERS[i])), range(4), F.when(F.lit(False), ""))
    files = docs.groupBy("block", head.alias("head")).agg(F.sort_array(F.collect_list(F.struct("doc_id", lines.alias("line")))).alias("l"))
    text = F.concat_ws("\n", "head", F.array_join(F.transform("l", lambda x: x["line"]), "\n"), F.lit("short\n"))
    path = _folder(spark, "chunks")
    sinks.write_files(files.select(F.concat(F.lit("chunk"), F.col("block"), F.lit(".csv")).alias("name"), F.encode(text, "UTF-8").alias("content")), path)
    return merge.merge_named(sources.read_chunks(spark, path), ["file", "pos"])


@_query("page_ranges", f"""WITH {BOXES} SELECT 'third' AS range, pdf, page, pos FROM boxes WHERE page >= 5 AND page < 7
UNION ALL SELECT 'open', pdf, page, pos FROM boxes WHERE page >= 3 UNION ALL SELECT 'cut', pdf, page, pos FROM boxes WHERE page >= 2 AND page < 4""")
def page_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A chunk of two pages from page 1 on, an open range, and a chunk that the
    range's end cuts short."""
    boxes = _boxes(spark, sf_dir).select("pdf", "page", "pos")
    ranges = {"third": layout.page_range(boxes, 1, chunk_size=2, chunk=2), "open": layout.page_range(boxes, 3), "cut": layout.page_range(boxes, 0, 4, chunk_size=2, chunk=1)}
    return reduce(DataFrame.unionByName, (df.withColumn("range", F.lit(name)) for name, df in ranges.items()))


@_query("conversion_run", f"""WITH c AS (SELECT name, csv_name, format, rows::BIGINT AS rows, status FROM (VALUES
  ('Words', 'words.csv', 'mdx', (SELECT count(*) FROM documents), 'OK'), ('Lines', 'lines.csv', 'tab', (SELECT count(*) FROM documents), 'OK'),
  ('Blank', 'blank.csv', 'tab', 0, 'EMPTY'), ('Gone', 'gone.csv', 'stardict', 0, 'MISSING'), ('Broken', 'broken.csv', 'mdx', 0, 'ERROR: AnalysisException'),
  ('Other', 'other.csv', 'bgl', 0, 'UNSUPPORTED_FORMAT')) t(name, csv_name, format, rows, status)),
w AS (SELECT 'Words' AS name, 'w' || doc_id AS term, {_clean('text')} AS definition FROM documents
  UNION ALL SELECT 'Lines', doc_id::VARCHAR, replace(text, chr(10), ' ') FROM documents
  UNION ALL SELECT 'Other', '[CONVERSION NOTE]', 'export as tab-separated text first')
SELECT c.*, term, definition FROM c LEFT JOIN w USING (name)""")
def conversion_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalogue with a dictionary of each status, converted and read back:
    what was written beside each status, notes among it."""
    docs, out = _table(spark, sf_dir, "documents"), _folder(spark, "converted")
    tab, blank, bad = _folder(spark, "tab"), _folder(spark, "blank"), _folder(spark, "bad")
    docs.select(F.concat(F.col("doc_id").cast("string"), F.lit("\t"), F.translate("text", "\n", " ")).alias("value")).write.text(tab)
    docs.select(F.translate("text", "\t\n", "  ").alias("value")).write.text(blank)
    first = docs.groupBy().agg(F.encode(F.min("text"), "UTF-8").alias("content")).select(F.lit("b.mdx").alias("name"), "content")
    sinks.write_files(first, bad)
    catalogue = [
        conversion.Dictionary("Words", "words.csv", _mdx_folder(spark, sf_dir), "mdx"), conversion.Dictionary("Lines", "lines.csv", tab, "tab"),
        conversion.Dictionary("Blank", "blank.csv", blank, "tab"), conversion.Dictionary("Gone", "gone.csv", f"{out}/none", "stardict"),
        conversion.Dictionary("Broken", "broken.csv", bad, "mdx"), conversion.Dictionary("Other", "other.csv", tab, "bgl"),
    ]
    statuses = conversion.convert(spark, catalogue, out)
    written = [sources.read_chunks(spark, f"{out}/{d.csv_name}").select(F.col("source_file").alias("name"), "term", "definition") for d in catalogue if d.name in ("Words", "Lines", "Other")]
    rows = reduce(DataFrame.unionByName, written)
    # Of few names each: statuses go to the rows, not a name's rows to one task.
    bare = statuses.join(F.broadcast(rows.select("name").distinct()), "name", "left_anti").select("*", F.lit(None).cast("string").alias("term"), F.lit(None).cast("string").alias("definition"))
    return rows.join(F.broadcast(statuses), "name").select(*bare.columns).unionByName(bare)


@_query("verified_flag", f"""WITH r AS (SELECT max(total_entries) AS n, bool_or(pdf_deletable) AS pdf_deletable FROM ({ORACLES['quality_report']}))
SELECT unnest(['Verification: PASSED', 'n: ' || n, 'pdf_deletable: true']) AS line FROM r WHERE pdf_deletable""")
def verified_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The note of a run that passes, but for its date; a run that does not
    pass leaves no file."""
    report = quality_report(spark, sf_dir).agg(F.max("total_entries").alias("n"), F.bool_or("pdf_deletable").alias("pdf_deletable"))
    path = _folder(spark, "flag")
    sinks.write_flag(report, path)
    lines = spark.read.text(path) if conversion.exists(spark, path) else spark.createDataFrame([], "value string")
    return lines.where(~tx.strip(F.col("value")).startswith("Date: ")).select(F.col("value").alias("line"))


@_query("page_stream_shuffled", ORACLES["page_stream"])
def page_stream_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of four lines that come out of order: those of odd number in a
    first run, the others in a second one, spread over files and batches."""
    source, out, state = (_folder(spark, name) for name in ("pages", "structured", "progress"))
    lines = _headed(spark, sf_dir).withColumn("page", F.floor(F.col("line_no") / 4).cast("int"))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line_no", "text"))), lambda x: x["text"]), "\n")
    pages = lines.groupBy("pdf", "page").agg(text.alias("text"))
    for rest in (1, 0):
        pages.where(F.col("page") % 2 == rest).repartition(8, F.xxhash64("pdf", "page")).write.mode("append").parquet(source)
        stream.ingest(spark, source, out, state, first=0, chapters=_CHAPTERS, letters=_LETTERS)
    return spark.read.schema(stream.OUT).parquet(out)


@_query("stream_progress", f"WITH s AS ({ORACLES['page_stream']}) SELECT max(page) + 1 AS last_page, count(*) AS total_lines, 'completed' AS status FROM s")
def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The progress file of a stream of many batches, as read back."""
    source, out, state, told = (_folder(spark, name) for name in ("pages", "structured", "progress", "told"))
    lines = _headed(spark, sf_dir).withColumn("page", F.floor(F.col("line_no") / 4).cast("int"))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line_no", "text"))), lambda x: x["text"]), "\n")
    lines.groupBy("pdf", "page").agg(text.alias("text")).repartition(8, "pdf").write.parquet(source)
    query = stream.ingest(spark, source, out, state, files=1, chapters=_CHAPTERS, letters=_LETTERS)
    stream.write_progress(spark, query, out, told)
    return spark.read.schema("last_page int, total_lines bigint, status string").json(told)


#: Two columns that part at 400 of 1000 in every other document.
_PARTED = "CASE WHEN x + 20 < 500 THEN 0 ELSE 1 END AS col", "CASE WHEN x + 20 < (CASE WHEN pdf % 2 = 0 THEN 400 ELSE 500 END) THEN 0 ELSE 1 END AS col"


def _layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vote of three pages of each document."""
    page = F.explode(F.array(*map(F.lit, range(3)))).alias("page")
    pages = _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("pdf"), page)
    two = (F.col("pdf") % 2 == 0) & (F.col("page") < 2)
    facts = {"is_scanned": F.lit(True), "has_text": F.lit(False), "num_columns": F.when(two, 2).otherwise(1), "gutter_x": F.when(two, 390 + 20 * F.col("page")).otherwise(0), "page_width": F.lit(1000), "page_height": F.lit(1400), "image_w": 100 * F.col("page"), "image_h": F.lit(70)}
    return layout.layout_vote(pages.withColumns(facts))


@_query("layout_dictionary", _dictionary("v3").replace(*_PARTED))
def layout_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run whose columns part where the layout of each document says."""
    return dictionary.dictionary(_pages(spark, sf_dir), dictionary.Options("v3"), layouts=_layouts(spark, sf_dir))


@_query("run_counters", f"""WITH RECURSIVE {_folded("v3")}, tidy AS (SELECT {_tidied_english("english")} AS e, {_tidied_arabic("arabic", "v3")} AS a FROM folded)
SELECT count(*) AS raw_entries, count(*) FILTER ({_noise("e", "a", "v3")}) AS skipped, count(*) FILTER (NOT ({_noise("e", "a", "v3")})) AS valid_entries FROM tidy""")
def run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run counted while its dictionary was written: small PDFs share
    a file, as a folder for each would be as many as there are documents."""
    counters = dictionary.Counters()
    found = dictionary.dictionary(_pages(spark, sf_dir), dictionary.Options("v3"), counters=counters)
    sinks.write_table(found, _folder(spark, "bilingual"), ["pdf", "id", "English", "Arabic"], order=["pdf", "id"], placed=True)
    found = counters.read()
    return spark.createDataFrame([tuple(found.values())], ", ".join(f"{k} bigint" for k in found))
