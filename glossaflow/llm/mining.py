"""Hard negatives by segment summaries that bound inner products.

A vector of whole numbers is cut into segments, at each level of ``SEGMENTS``
more of them. Of each segment its mean m and deviation s (the root of the sum
of squares about the mean) are kept; over n components

    n m m' - s s'  <=  inner product  <=  n m m' + s s'

and the sums over a level's segments bound a score. Each level looks at the
rows that the level before has left; what is left at last is scored exactly.
Bounds count with a margin for their rounding and only leave rows out that
cannot be in the result, so the result is exact.

Rows are dealt over shards by a hash of the id; a shard is built once and
written as one row: ids, labels, vectors and summaries in order of label, so a
label's rows are one slice. Anchors go to every shard of their vector length in
blocks, and a task holds one shard and one block. There are two passes: each
anchor's best rows of its own label, then for each of these the best rows of
other labels whose score lies in its window. Both keep the best of each shard
and rank them once more.

Cases: rows with a null id, label or vector, or a component that is null, not
finite or not so after scaling, take no part; vectors of another length than
the anchor's are not its candidates; empty vectors are candidates of each other
with score 0; of rows that repeat an id the one of smallest label, then vector
counts; ties go to smaller ids; an anchor without positives has no rows, nor a
positive without negatives in its window (as where its score is below zero); a
score beyond 64 bits counts as the last that fits; an empty table gives an
empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossaflow.llm.common import materialize

SCALE = 256
POSITIVES, NEGATIVES = 5, 5
#: A negative's score is at least this share of its positive's, in hundredths.
LEAST_SHARE = 80
SEGMENTS = (1, 4, 16)
#: Values of one shard (rows times length), and rows of a shard where there are
#: few: up to ``FEW_SHARDS`` shards are made of fewer values.
SHARD_VALUES, FEW_ROWS, FEW_SHARDS = 1 << 21, 2_048, 32
BLOCK_ANCHORS = 16_384
#: Anchors and rows that are bounded at once.
GROUP, BLOCK = 128, 4_096
#: Share of pairs left above which a level takes them all.
DENSE = 0.2
MARGIN = 1e-9
LIMIT = (1 << 63) - 1


def summaries(q: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(sizes, means, deviations) of each level's segments."""
    out, d = [], q.shape[1]
    for n in SEGMENTS:
        if n <= d:
            cuts = np.arange(n) * d // n
            sizes = np.diff(np.append(cuts, d))
            mean = np.add.reduceat(q, cuts, axis=1) / sizes
            rest = q - np.repeat(mean, sizes, axis=1)
            out.append((sizes.astype(np.float64), mean, np.sqrt(np.add.reduceat(rest * rest, cuts, axis=1))))
    return out


def products(a: np.ndarray, b: np.ndarray, paired: bool = False) -> np.ndarray:
    """Exact inner products as 64-bit numbers: of all rows, or of pairs."""
    if not a.size or not b.size:
        return np.zeros(len(a) if paired else (len(a), len(b)), np.int64)
    if np.abs(a).max() * np.abs(b).max() * a.shape[1] < 2**53:
        return (np.einsum("pd,pd->p", a, b) if paired else a @ b.T).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    out = (whole(a) * whole(b)).sum(1) if paired else whole(a).dot(whole(b).T)
    return np.clip(out, -LIMIT, LIMIT).astype(np.int64)


@np.errstate(over="ignore", invalid="ignore")  # a bound that is no number leaves nothing out
def left_over(a: np.ndarray, sa: list, b: np.ndarray, sb: list, need: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, score): the pairs whose score may be ``need`` or more and
    ``most`` or less, left by all levels, with their exact score."""
    # Scores at the limits may stand for any beyond them.
    need = np.where(need <= -LIMIT, -np.inf, need - np.abs(need) * MARGIN)
    most = np.where(most >= LIMIT, np.inf, most + np.abs(most) * MARGIN)
    na, nb = np.linalg.norm(a, axis=1) * MARGIN, np.linalg.norm(b, axis=1)
    i = j = None
    for (sizes, ma, da), (_, mb, db) in zip(sa, sb, strict=True):
        if i is None:
            middle, reach = (ma * sizes) @ mb.T, da @ db.T + na[:, None] * nb + MARGIN
            open_ = ~((middle + reach < need[:, None]) | (middle - reach > most[:, None]))
            if np.count_nonzero(open_) <= DENSE * open_.size:
                i, j = np.nonzero(open_)
        else:
            middle = np.einsum("ps,ps->p", (ma * sizes)[i], mb[j])
            reach = np.einsum("ps,ps->p", da[i], db[j]) + na[i] * nb[j] + MARGIN
            open_ = ~((middle + reach < need[i]) | (middle - reach > most[i]))
            i, j = i[open_], j[open_]
    if i is None:
        score = products(a, b)
        i, j = np.nonzero(open_) if sa else np.indices(score.shape).reshape(2, -1)
        return i, j, score[i, j]
    return i, j, products(a[i], b[j], paired=True)


def best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` largest scores, ties to smaller ids."""
    at = np.arange(len(score))
    if len(score) > 4 * k:
        at = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
    return at[np.lexsort((ids[at], -score[at]))[:k]]


class Shard:
    """Ids, labels and vectors in order of label, with their summaries."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, q: np.ndarray, levels: list | None = None):
        self.ids, self.labels, self.q = ids, labels, q
        self.levels = summaries(q) if levels is None else levels

    def slices(self, label: int, own: bool) -> Iterator[tuple[int, int]]:
        """Blocks of the rows of ``label``, or of all others."""
        a, b = np.searchsorted(self.labels, label), np.searchsorted(self.labels, label, "right")
        for start, end in [(a, b)] if own else [(0, a), (b, len(self.ids))]:
            for at in range(start, end, BLOCK):
                yield at, min(at + BLOCK, end)

    def search(self, ids: np.ndarray, labels: np.ndarray, q: np.ndarray, low: list[list[int]], high: list[list[int]], k: int, own: bool) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(anchor, window, ids, scores): of each anchor's windows [low, high]
        the ``k`` best rows here, of its own label or of others."""
        for label in np.unique(labels):
            of = np.flatnonzero(labels == label)
            for part in np.split(of, range(GROUP, len(of), GROUP)):
                levels = summaries(q[part])
                held = [[(np.empty(0, np.int64), np.empty(0, np.int64))] * len(low[i]) for i in part]
                for start, end in self.slices(label, own):
                    # The least that can still be among the best of a window.
                    least = [[max(lo, int(s[-1])) if len(s) == k else lo for lo, (_, s) in zip(low[i], h, strict=True)] for i, h in zip(part, held, strict=True)]
                    need, most = np.array([min(x) for x in least], float), np.array([max(high[i]) for i in part], float)
                    rows = [(sizes, mean[start:end], dev[start:end]) for sizes, mean, dev in self.levels]
                    i, j, score = left_over(q[part], levels, self.q[start:end], rows, need, most)
                    found = self.ids[start:end][j]
                    other = found != ids[part][i]
                    i, found, score = i[other], found[other], score[other]
                    cuts = np.searchsorted(i, np.arange(len(part) + 1))
                    for n in np.flatnonzero(np.diff(cuts)):
                        names, s = found[cuts[n] : cuts[n + 1]], score[cuts[n] : cuts[n + 1]]
                        for w, (lo, hi) in enumerate(zip(least[n], high[part[n]], strict=True)):
                            within = (s >= lo) & (s <= hi)
                            if within.any():
                                both, scores = np.concatenate([held[n][w][0], names[within]]), np.concatenate([held[n][w][1], s[within]])
                                top = best(scores, both, k)
                                held[n][w] = both[top], scores[top]
                for n, i in enumerate(part):
                    for w, (names, s) in enumerate(held[n]):
                        if len(names):
                            yield i, w, names, s


# --- tables ------------------------------------------------------------------


def usable(vectors: DataFrame, id_col: str, label: Column, vector_col: str) -> DataFrame:
    """(id, label, v, dim) of the rows that take part, one for each id."""
    v = F.col("v")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) * SCALE < float("inf")))
    once = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & fine).groupBy("id").agg(F.min(F.struct("label", "v")).alias("row"))
    return once.select("id", "row.label", "row.v", F.size("row.v").alias("dim"))


def whole_numbers(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    """Each component x as floor(SCALE x); exact in double precision."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.floor(np.asarray(flat.flatten(), np.float64).reshape(len(flat), dim) * SCALE)


_SHARD = [T.StructField(c, T.BinaryType()) for c in ("ids", "labels", "q", "means", "deviations")]


def shards(rows: DataFrame) -> DataFrame:
    """One row (dim, shard, ids, labels, q, means, deviations) of each shard."""

    def build(keys: tuple, table: pa.Table) -> pa.Table:
        dim = keys[0].as_py()
        ids, labels = np.asarray(table["id"]), np.asarray(table["label"])
        order = np.lexsort((ids, labels))
        q = whole_numbers(table["v"], dim)[order]
        levels = summaries(q)
        parts = [ids[order], labels[order], q, *(np.concatenate([level[n] for level in levels], axis=1) if levels else q for n in (1, 2))]
        return pa.Table.from_arrays([pa.array([dim], pa.int32()), pa.array([keys[1].as_py()], pa.int32()), *(pa.array([p.tobytes()], pa.binary()) for p in parts)], ["dim", "shard", *(f.name for f in _SHARD)])

    schema = T.StructType([T.StructField("dim", T.IntegerType()), T.StructField("shard", T.IntegerType()), *_SHARD])
    return rows.select("dim", "shard", "id", "label", "v").groupBy("dim", "shard").applyInArrow(build, schema)


def opened(row: dict, dim: int) -> Shard:
    """The shard of a row made by :func:`shards`."""
    ids, labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64)
    table = lambda c, width: np.frombuffer(row[c], np.float64).reshape(len(ids), width)
    counts = [n for n in SEGMENTS if n <= dim]
    cut = lambda c: np.split(table(c, sum(counts)), np.cumsum(counts)[:-1], axis=1) if counts else []
    sizes = [np.diff(np.append(np.arange(n) * dim // n, dim)).astype(np.float64) for n in counts]
    return Shard(ids, labels, table("q", dim), list(zip(sizes, cut("means"), cut("deviations"), strict=True)))


def meet(asked: DataFrame, planted: DataFrame, k: int, own: bool) -> DataFrame:
    """(anchor_id, positive_score, id, score): the ``k`` best of each shard for
    ``asked`` (dim, shard, block, id, label, v, scores), whose windows end at
    ``scores``; with ``own`` there is one window of everything. ``planted`` has
    a row of each shard for each block."""

    def run(keys: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if left.num_rows and right.num_rows:
            dim = keys[0].as_py()
            shard = opened(left.slice(0, 1).to_pylist()[0], dim)
            ids, labels = np.asarray(right["id"]), np.asarray(right["label"])
            ends = [[None]] * len(ids) if own else [sorted(set(s)) for s in right["scores"].to_pylist()]
            low = [[-LIMIT if s is None else -(-LEAST_SHARE * s // 100) for s in e] for e in ends]
            high = [[LIMIT if s is None else s for s in e] for e in ends]
            for i, w, names, scores in shard.search(ids, labels, whole_numbers(right["v"], dim), low, high, k, own):
                out.append((np.full(len(names), ids[i]), [ends[i][w]] * len(names), names, scores))
        flat = [np.concatenate([o[n] for o in out]) if out else [] for n in (0, 2, 3)]
        ends_ = [e for o in out for e in o[1]]
        return pa.Table.from_arrays([pa.array(flat[0], pa.int64()), pa.array(ends_, pa.int64()), pa.array(flat[1], pa.int64()), pa.array(flat[2], pa.int64())], ["anchor_id", "positive_score", "id", "score"])

    key = ["dim", "shard", "block"]
    return planted.groupBy(*key).cogroup(asked.groupBy(*key)).applyInArrow(run, "anchor_id long, positive_score long, id long, score long")


def hard_negatives(vectors: DataFrame, is_anchor: Column, label: Column, *, id_col: str = "vec_id", vector_col: str = "embedding", positives: int = POSITIVES, negatives: int = NEGATIVES, shard_values: int = SHARD_VALUES, few_rows: int = FEW_ROWS, block_anchors: int = BLOCK_ANCHORS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score) of every anchor row; ``is_anchor`` is a condition on the id
    column."""
    rows = materialize(usable(vectors, id_col, label, vector_col), "vectors")
    anchors = rows.withColumnRenamed("id", id_col).where(is_anchor).withColumnRenamed(id_col, "id")
    # A row for each vector length.
    sizes = {r["dim"]: r["count"] for r in rows.groupBy("dim").count().toLocalIterator()}
    asked = {r["dim"]: r["count"] for r in anchors.groupBy("dim").count().toLocalIterator()}
    parts = [(d, max(-(-n * max(d, 1) // shard_values), min(FEW_SHARDS, -(-n // few_rows))), -(-asked.get(d, 0) // block_anchors)) for d, n in sizes.items()]
    spans = F.broadcast(rows.sparkSession.createDataFrame(parts, "dim int, parts long, blocks long"))
    dealt = rows.join(spans, "dim").withColumn("shard", F.pmod(F.xxhash64("id"), "parts").cast("int"))
    planted = materialize(shards(dealt), "shards").join(spans, "dim").where("blocks > 0").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)))
    copies = planted.select("dim", "shard", "block", *(f.name for f in _SHARD))
    # The stated queries against all rows: each anchor once for each shard.
    block = F.pmod(F.xxhash64("id", F.lit(1)), "blocks").cast("int")
    sent = lambda df: df.join(spans, "dim").withColumn("block", block).withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("parts").cast("int") - 1)))

    def ranked(found: DataFrame, keys: list[str], k: int) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    mine = ranked(meet(sent(anchors), copies, positives, True), ["anchor_id"], positives)
    pairs = materialize(mine.select("anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    windows = pairs.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_set("positive_score").alias("scores"))
    found = ranked(meet(sent(anchors.join(windows, "id")), copies, negatives, False), ["anchor_id", "positive_score"], negatives)
    out = pairs.join(found, ["anchor_id", "positive_score"])
    return out.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
