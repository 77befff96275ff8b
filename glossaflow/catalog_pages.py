"""Registered queries of page rasters, letter shapes and archives.

Rasters and files are derived from the tables by Spark; the SQL is over the
tables alone.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossaflow.catalog import _ARABIZE, _query, _table
from glossaflow.catalog_files import BLOCK, _blocks, _folder
from glossaflow.functions import text as tx
from glossaflow.operators import raster
from glossaflow.plans import built, samples
from glossaflow.sinks import files as sinks
from glossaflow.sources import archives

#: Vectors of one page.
HIGH = 64


def _raster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector a line of grey values, 64 to a page and ten pages to a PDF."""
    grey = lambda v: F.floor(F.greatest(F.lit(0.0), F.least(F.lit(255.0), v.cast("double") * 256 + 128)))
    pixels = F.unhex(F.array_join(F.transform("embedding", lambda v: F.lpad(F.hex(grey(v)), 2, "0")), ""))
    place = F.floor(F.col("vec_id") / HIGH)
    return _table(spark, sf_dir, "embeddings").select(F.floor(place / 10).cast("int").alias("pdf"), (place % 10).cast("int").alias("page"), (F.col("vec_id") % HIGH).cast("int").alias("y"), pixels.alias("pixels"))


GREY = f"""px AS (SELECT (vec_id // {HIGH} // 10)::INT AS pdf, (vec_id // {HIGH} % 10)::INT AS page, unnest(range(len(embedding)))::INT AS x, floor(greatest(0.0, least(255.0, unnest(embedding)::DOUBLE * 256 + 128)))::INT AS v FROM embeddings),
counts AS (SELECT pdf, page, v, count(*) AS n FROM px GROUP BY pdf, page, v),
parts AS (SELECT pdf, page, v, sum(n) OVER lo AS n0, sum(v * n) OVER lo AS s0, sum(n) OVER al AS n1, sum(v * n) OVER al AS s1 FROM counts
  WINDOW lo AS (PARTITION BY pdf, page ORDER BY v), al AS (PARTITION BY pdf, page)),
cuts AS (SELECT pdf, page, coalesce(arg_max(v, (pow(s0 / n0 - (s1 - s0) / (n1 - n0), 2) * (n0::DOUBLE * (n1 - n0)), -v)) FILTER (n1 > n0), 0) AS threshold FROM parts GROUP BY pdf, page),
dark AS (SELECT pdf, page, x, threshold, count(*) FILTER (v <= threshold) AS ink FROM px JOIN cuts USING (pdf, page) GROUP BY pdf, page, x, threshold)"""


@_query("raster_ink", f"WITH {GREY} SELECT * FROM dark")
def raster_ink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One threshold a page and the dark pixels of each vertical."""
    lines = raster.single_lines(_raster(spark, sf_dir))
    cuts = raster.otsu(raster.histogram(lines))
    return raster.ink(lines, cuts).join(cuts, ["pdf", "page"]).select("pdf", "page", "x", "threshold", "ink")


@_query("raster_columns", f"""WITH {GREY}, mid AS (SELECT pdf, page, arg_min(x, (ink, x)) AS gutter_x, min(ink) AS least, avg(ink) AS mean FROM dark WHERE x >= 16 AND x < 48 GROUP BY pdf, page)
SELECT pdf, page, gutter_x, CASE WHEN least < mean * 0.3 THEN 2 ELSE 1 END AS num_columns, 64 AS page_width FROM mid""")
def raster_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raster.page_columns(_raster(spark, sf_dir)).select("pdf", "page", "gutter_x", "num_columns", "page_width")


@_query("raster_enhanced")
def raster_enhanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as recognition wants them, with their dark pixels; no SQL (tests
    compare with whole pages)."""
    done = raster.preprocess(_raster(spark, sf_dir), "enhanced", height=24)
    return done.select("pdf", "page", "y", F.expr("len(replace(hex(pixels), 'F', '')) DIV 2").alias("dark"))


# Letters within words, and two of them as one, in their shapes.
_PLAIN, _SHAPES = "ابتثجحخدذرزسشصضطظعغفقكلمنه", "ﺎﺒﺘﺜﺠﺤﺨﺪﺬﺮﺰﺴﺸﺼﻀﻄﻈﻌﻐﻔﻘﻜﻠﻤﻨﻬ"
_PAIRS = (("لا", "\ufefc"), ("لج", "\ufcc9"), ("تم", "\ufca4"))


@_query("letter_shapes", f"SELECT doc_id, {_ARABIZE.format('text')} || ' ' || lower(text) AS folded FROM documents")
def letter_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts in letter shapes with ligatures, marks of direction and numbers of
    glyphs put in, and their plain letters again."""
    shaped = samples.to_arabic(F.col("text"))
    for pair, one in _PAIRS:
        shaped = F.replace(shaped, F.lit(pair), F.lit(one))
    shaped = F.concat(F.lit("\u202b"), F.translate(shaped, _PLAIN, _SHAPES), F.lit(" \u202c(cid:17)"), F.lower("text"))
    return _table(spark, sf_dir, "documents").select("doc_id", tx.normalize_forms(shaped).alias("folded"))


#: Documents of an innermost archive, and innermost archives of one about them.
LEAF, MIDDLE = 5, 4
_FILES = T.ArrayType(T.StructType([T.StructField("name", T.StringType()), T.StructField("content", T.BinaryType())]))


@F.pandas_udf(_FILES)
def _nested(blocks: pd.Series, ids: pd.Series, texts: pd.Series) -> pd.Series:
    """Archives of three levels with a locked and a broken member each and, in
    every fifth, a broken archive; every other one is cut into three volumes."""

    def pack(block, keys, bodies):
        docs = [(f"{k}.txt", t.encode()) for k, t in zip(keys, bodies, strict=True)]
        leaves = [(f"leaf{n}.zip", built.zipped(docs[at : at + LEAF])) for n, at in enumerate(range(0, len(docs), LEAF))]
        middles = [(f"in/middle{n}.zip", built.zipped(leaves[at : at + MIDDLE], stored=n % 2 == 0)) for n, at in enumerate(range(0, len(leaves), MIDDLE))]
        more = [("locked.txt", b"x"), ("broken.txt", b"y" * 9000), *([("sick.zip", b"no archive")] if block % 5 == 0 else [])]
        whole = built.zipped([*middles, *more], locked=["locked.txt"], broken=["broken.txt"])
        if block % 2 == 0:
            return [{"name": f"a{block}.zip", "content": whole}]
        third = -(-len(whole) // 3)
        return [{"name": f"a{block}.zip.{n + 1:03}", "content": whole[n * third : (n + 1) * third]} for n in range(3)]

    return pd.Series([pack(*r) for r in zip(blocks, ids, texts, strict=True)])


@_query("nested_archives", f"""WITH d AS (SELECT doc_id, text, doc_id // {BLOCK} AS b, row_number() OVER (PARTITION BY doc_id // {BLOCK} ORDER BY doc_id) - 1 AS n FROM documents),
b AS (SELECT DISTINCT b FROM d)
SELECT 'a' || b || '.zip/in/middle' || n // {LEAF * MIDDLE} || '.zip/leaf' || n // {LEAF} || '.zip' AS archive, doc_id || '.txt' AS member, 'OK' AS status, text FROM d
UNION ALL SELECT 'a' || b || '.zip', 'locked.txt', 'ENCRYPTED', NULL FROM b UNION ALL SELECT 'a' || b || '.zip', 'broken.txt', 'DAMAGED', NULL FROM b
UNION ALL SELECT 'a' || b || '.zip/sick.zip', NULL, 'DAMAGED', NULL FROM b WHERE b % 5 = 0""")
def nested_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives in archives in archives, some in volumes; members in pieces of
    64 KB are put together again."""
    path = _folder(spark, "nested")
    books = _blocks(spark, sf_dir).groupBy("block").agg(F.sort_array(F.collect_list(F.struct("doc_id", "text"))).alias("e"))
    packed = books.select(F.inline(_nested("block", F.transform("e", lambda x: x["doc_id"]), F.transform("e", lambda x: x["text"]))))
    sinks.write_files(packed, path)
    found = archives.unpack(spark, path, pieceBytes=1 << 16, partBytes=1 << 20)
    pieces = F.sort_array(F.collect_list(F.when(F.col("status") == archives.OK, F.struct("at", "content"))))
    whole = F.unhex(F.array_join(F.transform("pieces", lambda p: F.hex(p["content"])), ""))
    text = F.when(F.col("status") == archives.OK, F.decode(whole, "UTF-8"))
    return found.groupBy("archive", "member", "status").agg(pieces.alias("pieces")).select("archive", "member", "status", text.alias("text"))
