"""First-wins deduplication, sequential numbering and chunk merging.

Order is always an explicit list of columns. Numbering ranks inside range
partitions and adds the counts of those before, so no step puts all rows into
one task. Where texts are long, their digests are dealt out and numbered, and
the numbers go back to the texts.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glossaflow.functions import text as tx
from glossaflow.shared import materialize

#: Bits of a row's place in its block, whose numbers travel together, and bytes
#: of numbers up to which they are broadcast.
BLOCK_BITS, BROADCAST_BYTES = 10, 64 << 20


def first_wins(rows: DataFrame, keys: Sequence[Column], order: Sequence[str]) -> DataFrame:
    """The first row by ``order`` of each combination of ``keys``."""
    names = [f"_key{i}" for i in range(len(keys))]
    first = Window.partitionBy(*names).orderBy(*order)
    keyed = rows.withColumns(dict(zip(names, keys, strict=True)))
    return keyed.withColumn("_place", F.row_number().over(first)).where("_place = 1").drop(*names, "_place")


def entry_keys(english: str = "term", arabic: str = "definition") -> list[Column]:
    """Digests of both sides: entries are dealt out and sorted by them, and a
    long text does not travel beside its own copy."""
    return [F.sha2(F.lower(english), 256), F.sha2(F.col(arabic), 256)]


def renumber(rows: DataFrame, order: Sequence[str], name: str = "id", partitions: int | None = None) -> DataFrame:
    """``rows`` numbered from 1 in ``order``.

    Rows are put into ranges of the order; each is ranked by itself, and the
    counts of the ranges before it are added. The counts are one row for each
    range, whatever the table's size. The ranges are written once, as their
    bounds come from a sample that a second run would draw anew.
    """
    n = partitions or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialize(rows.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()), "ranges")
    ranked = ranged.withColumn("_rank", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    counts = ranged.groupBy("_part").count()
    before = counts.withColumn("_before", F.sum("count").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))).drop("count")
    numbered = ranked.join(F.broadcast(before), "_part")
    return numbered.withColumn(name, (F.col("_rank") + F.coalesce("_before", F.lit(0))).cast("bigint")).drop("_part", "_rank", "_before")


def number_firsts(rows: DataFrame, keys: Sequence[Column], order: Sequence[str], name: str = "id") -> DataFrame:
    """The first row by ``order`` of each combination of ``keys``, digests both,
    numbered from 1 in ``order``: :func:`renumber` of :func:`first_wins`.

    Rows are written once, with a place, and stay where they are. Only digests,
    order and place are dealt out and put in order; numbers come back by place,
    a block of places together, at some 12 bytes a row. Beyond
    ``BROADCAST_BYTES`` of them the rows are dealt out by block.
    """
    held = materialize(rows.withColumn("_row", F.monotonically_increasing_id()), "rows", compression="zstd")
    block, place = F.shiftright("_row", BLOCK_BITS).alias("_block"), F.col("_row").bitwiseAND((1 << BLOCK_BITS) - 1).cast("short").alias("_place")
    names = [f"_key{i}" for i in range(len(keys))]
    digests = held.select(*(F.unhex(k).alias(n) for k, n in zip(keys, names, strict=True)), F.struct(*order, "_row").alias("_first"))
    firsts = digests.groupBy(*names).agg(F.min("_first").alias("_first")).select("_first.*")
    numbers = renumber(firsts, order, "_number").select(block, F.struct(place, "_number").alias("n")).groupBy("_block").agg(F.sort_array(F.collect_list("n")).alias("n"))
    blocks = materialize(numbers.select("_block", F.col("n._place").alias("_places"), F.col("n._number").alias("_numbers")), "numbers")
    size = blocks.agg(F.coalesce(F.sum(F.size("_places") * 12 + 64), F.lit(0))).first()[0]
    side = F.broadcast(blocks) if size <= BROADCAST_BYTES else blocks.hint("shuffle_hash")
    found = held.select("*", block, place).join(side, "_block").withColumn("_at", F.array_position("_places", F.col("_place")).cast("int")).where("_at > 0")
    return found.withColumn(name, F.get("_numbers", F.col("_at") - 1)).drop("_row", "_block", "_place", "_places", "_numbers", "_at")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    if not frames:
        raise ValueError("no chunks to merge")
    return reduce(lambda a, b: a.unionByName(b), frames)


def merge_named(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """(id, term, definition, source_file): both sides required, first wins."""
    trimmed = rows.withColumns({c: tx.strip(F.coalesce(c, F.lit(""))) for c in ("term", "definition", "source_file")})
    both = trimmed.where("term <> '' and definition <> ''").select(*order, "term", "definition", "source_file")
    return number_firsts(both, entry_keys(), order).select("id", "term", "definition", "source_file")


def merge_positional(rows: DataFrame, order: Sequence[str], cells: str = "cells") -> DataFrame:
    """(id, English, Arabic) of rows of three cells or more; empty sides stay.
    Null cells at the end are cells that a row lacks."""
    wide = rows.where((F.size(cells) >= 3) & F.get(cells, F.lit(2)).isNotNull()).withColumns({"English": tx.strip(F.element_at(cells, 2)), "Arabic": tx.strip(F.element_at(cells, 3))}).select(*order, "English", "Arabic")
    return number_firsts(wide, entry_keys("English", "Arabic"), order).select("id", "English", "Arabic")


def merge_lines(frames: Sequence[DataFrame]) -> DataFrame:
    """Structured lines of all chunks, repeats and all."""
    return union_all(frames)
