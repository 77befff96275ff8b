"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells of (source, language, topic); a cell's mass is its
number of tokens. Raking scales the cells until their sums over each of the
three dimensions are the target marginals (within ``TOLERANCE``), and documents are then sampled, each
with its cell's calibrated probability, by a hash of the id: the same document
is always judged the same way.

Only cells are ever grouped or joined: a cell with a third of all rows is one
row after the map-side sum. The cells are joined to the documents by broadcast
where their counted number allows it, and by a shuffle of the documents' cell
names and ids otherwise.

Targets are mappings of value to weight. Where a dimension has none, its
target is the corpus's own shares raised to ``TEMPERATURE`` (1 keeps them, 0
makes them equal). Values that do not occur are left out and the rest is
normalised.

Cases: null texts count as empty and have no tokens; documents without tokens
weigh nothing, have probability 0 and are not kept; a null source, language or
topic is a value of its own, ``""``; equal ids share their draw, rows with a
null id are drawn as id ``""``; very long texts are counted whole; repeated
rows are kept or dropped alike and count in their cell each; a draw equal to
the probability is not kept, so probability 0 keeps nothing; an empty table
gives an empty result. Extra columns of any name are ignored by ``mix`` and
kept by ``sample``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glossaflow.llm.common import checked_broadcast, materialize

TEMPERATURE = 0.7
#: Tokens kept, as a share of all.
SHARE = 0.5
#: Rounds of raking at most, and the relative error of a marginal at which
#: they end.
ROUNDS = 100
TOLERANCE = 1e-10
ROUNDS_PER_TABLE = 4
SPACE = r"[ \t-\r]+"


def token_count(text: Column) -> Column:
    """White-space tokens of a whole text.

    Where no two spaces meet the spaces are counted; only other texts are
    rewritten by a pattern first.
    """
    plain = F.btrim(F.replace(F.coalesce(text, F.lit("")), F.lit("\n"), F.lit(" ")))
    odd = reduce(lambda a, b: a | b, (plain.contains(s) for s in ("  ", "\t", "\r", "\x0b", "\x0c")))
    single = F.when(odd, F.btrim(F.regexp_replace(plain, SPACE, " "))).otherwise(plain)
    return F.when(single == "", 0).otherwise(F.length(single) - F.length(F.replace(single, F.lit(" "), F.lit(""))) + 1).cast("long")


def topic(text: Column) -> Column:
    """A coarse topic from what a text holds: licence notices, contact data,
    tables, or prose by length."""
    legal = text.contains("icense") | text.contains("icence") | text.contains("ll rights reserved")
    return (
        F.when(legal, "legal")
        .when(text.contains("@") & text.rlike("[A-Za-z0-9]@[A-Za-z0-9]"), "contact")
        .when(text.contains(" | "), "table")
        .when(F.length(text) < 1000, "short")
        .otherwise("prose")
    )


def cells_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang", topic_col: str | None = None, *more: Column) -> DataFrame:
    """(id, source, lang, topic, tokens) of every document, and ``more``."""
    about = F.col(topic_col) if topic_col else topic(F.col(text_col))
    return docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"),
        F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"),
        F.coalesce(about.cast("string"), F.lit("")).alias("topic"),
        token_count(F.col(text_col)).alias("tokens"),
        *more,
    )


def marginal(cells: DataFrame, dim: str, target: Mapping[str, float] | None, temperature: float) -> DataFrame:
    """(dim, share): the target of one dimension over the values that occur."""
    sums = cells.groupBy(dim).agg(F.sum("mass").alias("m"))
    if target is None:
        weight = F.pow(F.col("m"), F.lit(float(temperature)))
    else:
        given = cells.sparkSession.createDataFrame([(str(k), float(v)) for k, v in target.items()], f"{dim} string, w double")
        sums, weight = sums.join(F.broadcast(given), dim), F.col("w")
    weighed = materialize(sums.select(dim, weight.alias("w")).where("w > 0"), f"target-{dim}")
    total = weighed.agg(F.sum("w")).first()[0]
    return weighed.select(dim, (F.col("w") / F.lit(total or 1.0)).alias("share"))


def rake(cells: DataFrame, marginals: Mapping[str, DataFrame], rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> DataFrame:
    """``cells`` (dimensions, mass) with ``weight``, the raked share.

    Rounds over all dimensions go on until every marginal is within
    ``tolerance`` of its target, ``rounds`` at most: targets that no weights of
    the cells can meet are never met. :func:`marginal_error` tells.
    """
    fitted = cells.withColumn("weight", F.col("mass").cast("double"))
    for dim, target in marginals.items():
        fitted = fitted.join(target.withColumnRenamed("share", f"share_{dim}"), dim, "left")
    for k in range(rounds):
        for dim in marginals:
            # A window, not a join with a sum: the plan stays a chain.
            total = F.sum("weight").over(Window.partitionBy(dim))
            fitted = fitted.withColumn("weight", F.coalesce(F.try_divide(F.col("weight") * F.col(f"share_{dim}"), total), F.lit(0.0)))
        if (k + 1) % ROUNDS_PER_TABLE == 0 or k + 1 == rounds:
            fitted = materialize(fitted, "raked")
            if marginal_error(fitted, list(marginals)) <= tolerance:
                break
    return fitted


def marginal_error(raked: DataFrame, dims: Sequence[str]) -> float:
    """The largest relative error of a marginal of ``raked``, 0 for no cells."""
    sums = [raked.groupBy(d).agg(F.sum("weight").alias("w"), F.max(f"share_{d}").alias("t")).where("t > 0") for d in dims]
    errors = reduce(lambda a, b: a.unionByName(b), (s.select(F.abs(F.col("w") / F.col("t") - 1).alias("e")) for s in sums))
    return errors.agg(F.max("e")).first()[0] or 0.0


def calibrate(raked: DataFrame, share: float = SHARE) -> DataFrame:
    """``raked`` with ``probability``: weight over mass, scaled so that the
    expected tokens are ``share`` of all, and 1 where that would exceed 1.

    The scale is exact: with the cells that are full set aside, the others take
    what is left in proportion; that may fill some more, until none is. Each
    step is one aggregate of the cells.
    """
    raked = materialize(raked, "weights")
    wanted = share * (raked.agg(F.sum("mass")).first()[0] or 0)
    scale, full = 0.0, -1
    while True:
        filled = (F.col("weight") * scale >= F.col("mass")) & F.lit(full >= 0)
        row = raked.where("weight > 0").agg(F.count_if(filled), F.sum(F.when(filled, F.col("mass"))), F.sum(F.when(~filled, F.col("weight")))).first()
        if row[0] == full or not row[2]:
            break
        full, scale = row[0], (wanted - (row[1] or 0)) / row[2]
    # All that can be kept is less than what is wanted: keep that.
    over = F.lit(bool(row[0]) and not row[2])
    return raked.withColumn("probability", F.when(over & (F.col("weight") > 0), 1.0).otherwise(F.least(F.lit(1.0), F.col("weight") / F.col("mass") * scale)))


def draw(id_column: Column) -> Column:
    """A number in [0, 1) from the id alone."""
    return F.conv(F.substring(F.md5(F.concat(F.lit("mix:"), F.coalesce(id_column.cast("string"), F.lit("")))), 1, 8), 16, 10).cast("double") / 4294967296.0


DIMENSIONS = ("source", "lang", "topic")


def plan(each: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None, *, temperature: float = TEMPERATURE, share: float = SHARE, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> DataFrame:
    """(source, lang, topic, mass, weight, probability) of every cell."""
    cells = materialize(each.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("mass")).where("mass > 0"), "cells")
    marginals = {d: marginal(cells, d, (targets or {}).get(d), temperature) for d in DIMENSIONS}
    return calibrate(rake(cells, marginals, rounds, tolerance), share)


def mix(docs: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang", topic_col: str | None = None, **settings) -> DataFrame:
    """(id, source, lang, topic, tokens, probability, kept) of every document."""
    # One pass over the texts; what follows needs none of them.
    each = materialize(cells_of(docs, id_col, text_col, source_col, lang_col, topic_col), "cells-of")
    cells = materialize(plan(each, targets, **settings).select(*DIMENSIONS, "probability"), "calibrated")
    out = each.join(checked_broadcast(cells), list(DIMENSIONS), "left")
    probability = F.when(F.col("tokens") > 0, F.coalesce("probability", F.lit(0.0))).otherwise(0.0)
    out = out.select(F.col("id").alias(id_col), *DIMENSIONS, "tokens", probability.alias("probability"))
    return out.withColumn("kept", draw(F.col(id_col)) < F.col("probability"))


def sample(docs: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang", topic_col: str | None = None, **settings) -> DataFrame:
    """The documents that :func:`mix` keeps, all columns as they were."""
    about = (id_col, text_col, source_col, lang_col, topic_col)
    cells = materialize(plan(cells_of(docs, *about), targets, **settings).select(*DIMENSIONS, "probability"), "calibrated")
    # The document is one struct, so that none of its names meets one of ours.
    placed = cells_of(docs, *about, F.struct("*").alias("doc")).where("tokens > 0").join(checked_broadcast(cells), list(DIMENSIONS))
    return placed.where(draw(F.col("id")) < F.col("probability")).select(*(F.col("doc").getField(c).alias(c) for c in docs.columns))
