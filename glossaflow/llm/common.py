"""Shared pieces: shared-folder tables, size-checked joins, column checks."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossaflow.shared import delete_table, materialize, scratch, shared_dir

__all__ = ["WHITE", "bytes_of", "checked_broadcast", "delete_table", "keep_ids", "lean", "materialize", "read", "scratch", "shared_dir", "without_rows"]

#: Bytes in memory up to which a side may be broadcast. Larger sides take a
#: shuffled join.
BROADCAST_BYTES = 64 << 20

#: White space as the regex engines of the tokenizer libraries have it.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def bytes_of(df: DataFrame) -> int:
    """Bytes of ``df``'s rows as a broadcast holds them: eight for each value,
    the lengths of strings, bytes and arrays, and forty for the row."""
    sizes = [F.lit(40 + 8 * len(df.columns))]
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            sizes.append(F.coalesce(F.octet_length(f.name), F.lit(0)))
        elif isinstance(f.dataType, T.ArrayType):
            sizes.append(F.coalesce(F.size(f.name) * 8, F.lit(0)))
    return df.agg(F.coalesce(F.sum(reduce(lambda a, b: a + b, sizes).cast("long")), F.lit(0))).first()[0]


def checked_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast of ``df``, a written table, if its summed bytes keep
    the bound, else a join by shuffle."""
    return F.broadcast(df) if bytes_of(df) <= limit else df.hint("merge")


def without_rows(docs: DataFrame, gone: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose id and text hash are in ``gone``, a
    written table (id, text_hash). A null id equals a null id."""
    whole = docs.select(F.struct("*").alias("doc"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"))
    side = checked_broadcast(gone)
    same = whole["id"].eqNullSafe(side["id"]) & (whole["text_hash"] == side["text_hash"])
    return whole.join(side, same, "left_anti").select(*(F.col("doc").getField(c).alias(c) for c in docs.columns))


def keep_ids(docs: DataFrame, wanted: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` with the ids in ``wanted``, a written table, only."""
    return docs.join(checked_broadcast(wanted), id_col, "left_semi")


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``, giving freed memory back after each task:
    workers live on between tasks, and what they keep adds up."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
                trim(0)

    return wrapped
