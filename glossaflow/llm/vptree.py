"""Nearest neighbours by vantage-point trees, one per shard.

Pivots are a bounded sample of the vectors (``PIVOTS``, those of smallest id
hash); every vector goes to the pivot of largest inner product, and pivots of
more than ``SHARD_ROWS`` vectors are dealt over several shards by a hash of the
id. Each shard's tree is built once and written as one row.

In a tree, largest inner product is smallest distance by one more coordinate:
with M the shard's largest norm, (x, sqrt(M^2 - |x|^2)) lies at distance
|q|^2 + M^2 - 2 q.x (squared) from (q, 0). A tree splits its points at the
median distance from a vantage point, and the triangle inequality tells which
branches can hold a nearer one. Between shards it does the same: no vector at
distance r or less from pivot p has a larger product than q.p + |q| r. Both
bounds count with ``factor`` times their distance. Factor one is exact; smaller
factors prune more and may miss some.

A query first goes to the shards of its own pivot, and with the score of its
k-th neighbour found there to those others whose bound reaches it. Trees and
queries meet sorted in one partition, the tree before its queries, which are
walked through it a batch at a time: a task holds one tree and one batch. Only
a shard with more than ``BLOCK_ROWS`` queries is met in several tasks.

Distances only prune, with a margin for their rounding. Scores are sums in one
fixed order, whatever the batch, and ties of score go to the smaller id, also
at the last place kept. Of equal vectors of a shard only the k + 1 smallest ids
are in its tree, as no query can list more.

Cases: null, empty or zero vectors and vectors with null or non-finite
components take no part, nor do rows without id; vectors of another length than
the query's are not its candidates; of rows that repeat an id a query takes the
smallest vector, and a candidate its best score; with fewer candidates than
asked for all are returned; an empty table gives an empty result. Extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossaflow.llm.common import lean, materialize

K = 20
#: Share of the distances that bounds count with; see README for the recall.
FACTOR = 1.0
SHARD_ROWS = 16_384
#: Pivots at most, of each length of vectors.
PIVOTS = 1_024
#: How many times as many ids as pivots are looked at.
PIVOT_SLACK = 4
#: Queries of one shard in one task.
BLOCK_ROWS = 1 << 20
LEAF = 1024
#: Relative error that a bound may have.
MARGIN = 1e-13


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows, added in the order of the components."""
    total = np.zeros(len(a))
    for d in range(a.shape[1]):
        total += a[:, d] * b[:, d]
    return total


@dataclass
class Tree:
    """A vantage-point tree as arrays, so that it can be written as a row.

    Node i splits by point ``vantage[i]``; its two children are further nodes
    or, where negative, the leaves -1 - c. ``reach`` has each child's smallest
    and largest distance, ``leaves`` its leaf's range in ``order``.
    """

    ids: np.ndarray
    x: np.ndarray
    vantage: np.ndarray
    children: np.ndarray
    reach: np.ndarray
    leaves: np.ndarray
    order: np.ndarray

    @classmethod
    def build(cls, ids: np.ndarray, x: np.ndarray, leaf: int | None = None, seed: int = 7) -> Tree:
        leaf = leaf or LEAF
        random = np.random.Generator(np.random.PCG64(seed))
        points = lifted(x)
        vantage, children, reach, leaves, order = [], [], [], [], []

        def grow(at: np.ndarray) -> int:
            if len(at) <= leaf:
                leaves.append((sum(map(len, order)), len(at)))
                order.append(at)
                return -len(leaves)
            node = len(vantage)
            # Of a few points the one whose distances spread most.
            tries = at[random.integers(0, len(at), 4)]
            probe = points[at[random.integers(0, len(at), 64)]]
            spread = [np.linalg.norm(probe - points[t], axis=1).std() for t in tries]
            vantage.append(int(tries[int(np.argmax(spread))]))
            far = np.linalg.norm(points[at] - points[vantage[node]], axis=1)
            ranked = np.argsort(far, kind="stable")
            halves = np.split(ranked, [len(at) // 2])
            children.append([0, 0])
            reach.append([float(v) for h in halves for v in (far[h].min(), far[h].max())])
            children[node] = [grow(at[h]) for h in halves]
            return node

        if len(ids):
            grow(np.arange(len(ids)))
        flat = np.concatenate(order) if order else np.empty(0, np.int64)
        return cls(ids, x, np.array(vantage, np.int64), np.array(children, np.int64).reshape(-1, 2), np.array(reach).reshape(-1, 4), np.array(leaves, np.int64).reshape(-1, 2), flat)

    def search(self, query_ids: np.ndarray, q: np.ndarray, k: int, factor: float = 1.0, least: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place of the query, id, score) of each query's ``k`` best, but
        itself, among those of score ``least`` or more."""
        self.q, self.query_ids, self.k, self.factor = q, query_ids, k, factor
        self.points, self.norms = lifted(self.x), np.linalg.norm(q, axis=1)
        self.bound = float(np.sqrt((self.x**2).sum(1).max(initial=0.0)))
        self.floor = np.full(len(q), -np.inf) if least is None else least.copy()
        self.held = [(np.empty(0, np.int64), np.empty(0))] * len(q)
        if len(self.ids):
            self._visit(0 if len(self.vantage) else -1, np.arange(len(q)))
        sizes = [len(i) for i, _ in self.held]
        at = np.repeat(np.arange(len(q)), sizes)
        if not len(at):
            return at, np.empty(0, self.ids.dtype), np.empty(0)
        return at, np.concatenate([i for i, _ in self.held]), np.concatenate([s for _, s in self.held])

    def _open(self, at: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Whether a branch at ``least`` from each query can hold a score of
        its floor or more; the margin covers rounding."""
        scale = self.norms[at] ** 2 + self.bound**2
        square = scale - 2 * self.floor[at]
        return least**2 <= self.factor**2 * np.maximum(square, 0) + MARGIN * self.q.shape[1] * scale

    def _visit(self, node: int, at: np.ndarray) -> None:
        if not len(at):
            return
        if node < 0:
            return self._compare(-1 - node, at)
        vantage = self.points[self.vantage[node]]
        d = np.sqrt(((self.q[at] - vantage[:-1]) ** 2).sum(1) + vantage[-1] ** 2)
        low0, high0, low1, high1 = self.reach[node]
        least = [np.maximum(0, np.maximum(d - high, low - d)) for low, high in ((low0, high0), (low1, high1))]
        first = least[0] <= least[1]
        for part, a, b in ((first, 0, 1), (~first, 1, 0)):
            for child in (a, b):
                own = part & self._open(at, least[child])
                self._visit(int(self.children[node][child]), at[own])

    def _compare(self, leaf: int, at: np.ndarray) -> None:
        begin, size = self.leaves[leaf]
        rows = self.order[begin : begin + size]
        for block in range(0, len(at), 4096):
            some = at[block : block + 4096]
            near = self.q[some] @ self.x[rows].T
            # What two ways of adding up the same products can differ by.
            slack = MARGIN * self.q.shape[1] * self.norms[some] * self.bound
            floor = self.floor[some]
            if near.shape[1] > self.k + 1:  # the query itself may be among them
                floor = np.maximum(floor, np.partition(near, -self.k - 1, axis=1)[:, -self.k - 1])
            i, j = np.nonzero(near >= (floor - 2 * slack)[:, None])
            own = self.ids[rows[j]] != self.query_ids[some[i]]
            i, j = i[own], j[own]
            exact = scores(self.q[some[i]], self.x[rows[j]])
            kept = exact >= self.floor[some[i]]
            i, ids, exact = i[kept], self.ids[rows[j[kept]]], exact[kept]
            starts = np.searchsorted(i, np.arange(len(some) + 1))
            for n in np.flatnonzero(np.diff(starts)):
                query, part = some[n], slice(starts[n], starts[n + 1])
                held, old = self.held[query]
                self.held[query] = top(np.concatenate([held, ids[part]]), np.concatenate([old, exact[part]]), self.k)
                if len(self.held[query][0]) == self.k:
                    self.floor[query] = max(self.floor[query], self.held[query][1][-1])


def top(ids: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best ids, each once with its best score."""
    order = np.lexsort((ids, -score))
    ids, score = ids[order], score[order]
    _, first = np.unique(ids, return_index=True)
    first.sort()
    return ids[first[:k]], score[first[:k]]


def lifted(x: np.ndarray) -> np.ndarray:
    squares = (x**2).sum(1)
    return np.hstack([x, np.sqrt(squares.max(initial=0.0) - squares)[:, None]])


def thinned(ids: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """At most ``k`` + 1 ids, the smallest, of each vector."""
    order = np.lexsort((ids, *x.T[::-1]))
    ids, x = ids[order], x[order]
    new = np.append(True, (x[1:] != x[:-1]).any(1))
    group = np.cumsum(new) - 1
    once = np.append(True, new[1:] | (ids[1:] != ids[:-1]))
    ids, x, group = ids[once], x[once], group[once]
    rank = np.arange(len(ids)) - np.searchsorted(group, group)
    return ids[rank <= k], x[rank <= k]


def _matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(whole.flatten(), np.float64).reshape(-1, dim)


_PARTS = ("vantage", "children", "reach", "leaves", "order")
_TREE = [T.StructField(p, T.ArrayType(T.DoubleType() if p == "reach" else T.LongType())) for p in _PARTS]


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v, dim) of the rows that take part."""
    v = F.col("v")
    of = vectors.schema[vector_col].dataType
    single = isinstance(of, T.ArrayType) and isinstance(of.elementType, T.FloatType)
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<float>" if single else "array<double>").alias("v"))
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & fine & F.exists(v, lambda x: x != 0)).withColumn("dim", F.size(v))


def pivots_of(rows: DataFrame, sizes: dict[int, int], wanted: int) -> dict[int, np.ndarray]:
    """Up to ``wanted`` vectors of each length, those of smallest id hash.

    Only ids whose hash is below a bound are looked at, a few times as many as
    are wanted whatever the table's size; one vector of each id.
    """
    span = 1 << 62
    bound = [x for dim, n in sizes.items() for x in (F.lit(dim), F.lit(min(span, span * (PIVOT_SLACK * wanted + 32) // n)))]
    if not bound:
        return {}
    h = F.call_function("shiftrightunsigned", F.xxhash64("id"), F.lit(2))
    few = rows.withColumn("h", h).where(F.col("h") <= F.try_element_at(F.create_map(*bound), F.col("dim"))).groupBy("dim", "h", "id").agg(F.min("v").alias("v"))
    found: dict[int, list] = {}
    for row in few.toLocalIterator():
        found.setdefault(row["dim"], []).append((row["h"], row["id"], row["v"]))
    for dim in sizes.keys() - found.keys():  # rows of few ids may all lie beyond
        row = rows.where(F.col("dim") == dim).withColumn("h", h).orderBy("h", "id", "v").first()
        found[dim] = [(row["h"], row["id"], row["v"])]
    return {dim: np.unique(np.array([v for _, _, v in sorted(held)[:wanted]], np.float64), axis=0) for dim, held in found.items()}


def place(rows: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """``rows`` with pivot, the one of largest inner product, and radius, the
    distance from it."""
    shared = rows.sparkSession.sparkContext.broadcast(pivots)  # PIVOTS of each length at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.asarray(batch.column(2))
            pivot, radius = np.zeros(len(dims), np.int32), np.zeros(len(dims))
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                x, p = _matrix(batch.column(1).take(pa.array(at)), int(dim)), shared.value[int(dim)]
                pivot[at] = np.argmax(x @ p.T, axis=1)
                radius[at] = np.linalg.norm(x - p[pivot[at]], axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pivot), pa.array(radius)], [*batch.schema.names, "pivot", "radius"])

    schema = T.StructType([*rows.schema.fields, T.StructField("pivot", T.IntegerType()), T.StructField("radius", T.DoubleType())])
    return rows.mapInArrow(lean(run), schema)


def trees(placed: DataFrame, k: int) -> DataFrame:
    """One row (dim, shard, id list, points, tree) of each shard."""
    id_type = placed.schema["id"].dataType

    def build(keys: tuple, rows: pa.Table) -> pa.Table:
        dim = keys[0].as_py()
        ids, x = thinned(np.asarray(rows["id"]), _matrix(rows["v"], dim), k)
        tree = Tree.build(ids, x)
        parts = [pa.array([getattr(tree, p).ravel()], pa.list_(pa.float64() if p == "reach" else pa.int64())) for p in _PARTS]
        return pa.Table.from_arrays([pa.array([keys[0].as_py()], pa.int32()), pa.array([keys[1].as_py()], pa.int32()), pa.array([ids]), pa.array([x.ravel()]), *parts], ["dim", "shard", "ids", "points", *_PARTS])

    schema = T.StructType([T.StructField("dim", T.IntegerType()), T.StructField("shard", T.IntegerType()), T.StructField("ids", T.ArrayType(id_type)), T.StructField("points", T.ArrayType(T.DoubleType())), *_TREE])
    return placed.select("dim", "shard", "id", "v").groupBy("dim", "shard").applyInArrow(build, schema)


def send(asked: DataFrame, pivots: dict[int, np.ndarray], shards: dict[int, dict[int, tuple[float, int, int]]], factor: float, *, home: bool) -> DataFrame:
    """``asked`` (id, v, dim, least, pivot) once for each shard it is to visit: those
    of its own pivot (``home``), or the others that can reach ``least``.
    ``shards`` has each pivot's radius, first shard and number of shards."""
    shared = asked.sparkSession.sparkContext.broadcast((pivots, shards))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, regions = shared.value
        for batch in batches:
            dims, least = np.asarray(batch.column(2)), np.asarray(batch.column(3))
            for dim in np.unique(dims):
                if not (known := regions.get(int(dim))):
                    continue
                at = np.flatnonzero(dims == dim)
                names = np.array(sorted(known))
                radius, first, count = map(np.array, zip(*(known[p] for p in names), strict=True))
                q = _matrix(batch.column(1).take(pa.array(at)), int(dim))
                norm = np.linalg.norm(q, axis=1)[:, None]
                p = vectors[int(dim)][names]
                product = q @ p.T
                own = names == np.asarray(batch.column(4))[at][:, None]
                slack = MARGIN * int(dim) * norm * (np.linalg.norm(p, axis=1) + radius)
                go = own if home else ~own & (product + factor * norm * radius + slack >= least[at][:, None])
                i, j = np.nonzero(go)
                i, shard = np.repeat(i, count[j]), np.concatenate([np.arange(f, f + c) for f, c in zip(first[j], count[j], strict=True)] or [np.empty(0, np.int64)])
                sent = batch.take(pa.array(at[i]))
                yield pa.RecordBatch.from_arrays([*sent.columns, pa.array(shard.astype(np.int32))], [*sent.schema.names, "shard"])

    return asked.mapInArrow(lean(run), T.StructType([*asked.schema.fields, T.StructField("shard", T.IntegerType())]))


def visit(sent: DataFrame, planted: DataFrame, k: int, factor: float, block_rows: int) -> DataFrame:
    """(query_id, id, score): what the queries in ``sent`` find in the trees.

    Trees and queries are one relation, dealt by shard and sorted so that a
    tree comes before its queries.
    """
    counts = sent.groupBy("dim", "shard").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks"))
    blocks = planted.join(counts, ["dim", "shard"]).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    query = sent.join(F.broadcast(counts.where("blocks > 1")), ["dim", "shard"], "left").withColumn("block", F.pmod(F.xxhash64("id"), F.coalesce("blocks", F.lit(1))).cast("int"))
    key = ["dim", "shard", "block"]
    names = ["id", "v", "least", "ids", "points", *_PARTS]
    none = lambda df, c: F.lit(None).cast(df.schema[c].dataType).alias(c)
    one = blocks.select(*key, F.lit(0).alias("kind"), *(F.col(c) if c in blocks.columns else none(sent, c) for c in names))
    two = query.select(*key, F.lit(1).alias("kind"), *(F.col(c) if c in query.columns else none(planted, c) for c in names))
    both = one.unionByName(two).repartition(*key).sortWithinPartitions(*key, "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, held = None, None
        for batch in batches:
            place = np.stack([np.asarray(batch.column(c)) for c in range(4)], axis=1)
            cuts = [0, *(np.flatnonzero((place[1:] != place[:-1]).any(1) | (place[1:, 3] == 0)) + 1), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                part, dim = batch.slice(a, b - a), int(place[a, 0])
                if place[a, 3] == 0:
                    ids, x = np.asarray(part.column(7).flatten()), _matrix(part.column(8), dim)
                    flat = {p: np.asarray(part.column(9 + n).flatten()) for n, p in enumerate(_PARTS)}
                    tree, held = Tree(ids, x, flat["vantage"], flat["children"].reshape(-1, 2), flat["reach"].reshape(-1, 4), flat["leaves"].reshape(-1, 2), flat["order"]), tuple(place[a, :3])
                elif held == tuple(place[a, :3]):
                    asked = np.asarray(part.column(4))
                    at, found, score = tree.search(asked, _matrix(part.column(5), dim), k, factor, np.asarray(part.column(6)))
                    yield pa.RecordBatch.from_arrays([part.column(4).take(pa.array(at)), pa.array(found, part.column(4).type), pa.array(score)], ["query_id", "id", "score"])

    id_type = sent.schema["id"].dataType
    return both.mapInArrow(lean(run), T.StructType([T.StructField("query_id", id_type), T.StructField("id", id_type), T.StructField("score", T.DoubleType())]))


def neighbours(vectors: DataFrame, is_query: Column, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, factor: float = FACTOR, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` nearest of each query row.

    ``is_query`` is a condition on the id column; ids are whole numbers.
    """
    rows = usable(vectors, id_col, vector_col)
    sizes = {r["dim"]: r["count"] for r in rows.groupBy("dim").count().toLocalIterator()}
    wanted = min(PIVOTS, max([1, *(-(-n // shard_rows) for n in sizes.values())]))
    pivots = pivots_of(rows, sizes, wanted)
    placed = materialize(place(rows, pivots), "placed")

    # One row for each pivot, however many vectors there are.
    shards: dict[int, dict[int, tuple[float, int, int]]] = {}
    for r in placed.groupBy("dim", "pivot").agg(F.count("*").alias("n"), F.max("radius").alias("radius")).orderBy("dim", "pivot").collect():
        known = shards.setdefault(r["dim"], {})
        known[r["pivot"]] = (r["radius"], sum(c for _, _, c in known.values()), -(-r["n"] // shard_rows))
    table = [(dim, pivot, first, count) for dim, known in shards.items() for pivot, (_, first, count) in known.items()]
    spans = placed.sparkSession.createDataFrame(table, "dim int, pivot int, first int, parts int")
    dealt = placed.join(F.broadcast(spans), ["dim", "pivot"]).withColumn("shard", (F.col("first") + F.pmod(F.xxhash64("id"), "parts")).cast("int"))
    planted = materialize(trees(dealt, k), "trees")

    # The pivot of a query is worked out once, with the others.
    asked = placed.withColumnRenamed("id", id_col).where(is_query).withColumnRenamed(id_col, "id")
    asked = asked.groupBy("id").agg(F.min(F.struct("v", "pivot")).alias("q")).select("id", "q.v", F.size("q.v").alias("dim"), F.lit(float("-inf")).alias("least"), "q.pivot")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("id"))

    def ranked(found: DataFrame) -> DataFrame:
        once = found.groupBy("query_id", "id").agg(F.max("score").alias("score"))
        return once.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    first = materialize(ranked(visit(send(asked, pivots, shards, factor, home=True), planted, k, factor, block_rows)), "found")
    last = first.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("kth"))
    others = asked.join(last, "id", "left").select("id", "v", "dim", F.coalesce("kth", "least").alias("least"), "pivot")
    more = visit(send(others, pivots, shards, factor, home=False), planted, k, factor, block_rows)
    return ranked(first.drop("rank").unionByName(more)).select("query_id", "rank", F.col("id").alias(id_col), "score")
