"""Near-duplicate documents by a join of MinHash signature coordinates.

1. Each text becomes a set of shingle hashes and a MinHash signature. Equal
   word sequences fall into one class; only classes are compared.
2. The first ``POSTED`` coordinates are posted under (coordinate, value). Two
   sets at the threshold agree on at least ``agreeing`` many of them but for a
   chance under 5e-6, so each class needs postings only under the prefix of its
   rarest values: skipping the others loses no such pair, and common values
   (a passage that many documents share) stay out of the lists.
3. Each list is first merged with one pivot only, the member whose values
   collide most. Confirmed links join classes to components, and from then on
   only members of different components meet: in short lists pair by pair, in
   long ones block by block, each block pair handing on a spanning forest.
4. Links are confirmed on the full sets, by integers.

No pairs are made within a component, so a group of thousands of copies costs
a list, not its square. Every list is either one aggregate row or cut into
blocks of a fixed number of shingles.

Cases: a null text counts as empty; empty texts have no shingles and are
linked with nothing; a text of fewer words than a shingle is one shingle; very
long texts are read whole. Rows with a null id have no component, are linked
with nothing and are kept. Where an id is repeated each row is judged by its
own text: it takes the component of that text, whose name is its smallest id.
Ties at the threshold are links. An empty table gives an empty result. Extra
columns of any name are ignored by ``near_duplicates`` and kept by
``keep_one``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossaflow.llm.common import keep_ids, lean, materialize, without_rows

WORDS = 5
PERCENT = 85
COORDINATES = 64
POSTED = 32
#: Chance of a pair at the threshold to have too few agreeing coordinates: of
#: those posted to meet, or of all to be confirmed.
MISSED = 5e-6
#: Lists up to this length are joined pair by pair.
SHORT = 64
#: Shingles and members of one block of a long list, in expectation.
BLOCK_SHINGLES, BLOCK_MEMBERS = 500_000, 1_000

_RANDOM = np.random.Generator(np.random.PCG64(20240229))
_A = _RANDOM.integers(1, 1 << 62, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RANDOM.integers(0, 1 << 62, COORDINATES, dtype=np.uint64)
_P = np.uint64(0x9E3779B97F4A7C15)


def agreeing(coordinates: int, percent: int) -> int:
    """The most agreeing ones of ``coordinates`` that can be asked for."""
    p, below = percent / 100, 0.0
    for k in range(coordinates + 1):
        below += comb(coordinates, k) * p**k * (1 - p) ** (coordinates - k)
        if below >= MISSED:
            return k
    return coordinates


def split_words(text: str | None) -> list[bytes]:
    """ASCII-lower-cased words between ASCII white space."""
    return (text or "").encode("utf-8", "replace").lower().split()


def shingle_hashes(words: list[bytes], width: int = WORDS) -> np.ndarray:
    """Distinct 64-bit hashes of the ``width``-word shingles, ascending."""
    import xxhash

    if not words:
        return np.empty(0, np.uint64)
    if len(words) < width:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words))], np.uint64)
    each = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(words) - width + 1
    mixed = each[:n].copy()
    for k in range(1, width):
        mixed = (mixed ^ (mixed >> np.uint64(29))) * _P + each[k : k + n]
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return np.unique(mixed ^ (mixed >> np.uint64(32)))


def signature(hashes: np.ndarray) -> np.ndarray:
    """The smallest 32-bit value of each coordinate, as signed integers."""
    least = np.full(COORDINATES, 0xFFFFFFFF, np.uint64)
    for i in range(0, len(hashes), 8192):
        values = hashes[i : i + 8192, None] * _A + _B
        least = np.minimum(least, (values >> np.uint64(32)).min(0))
    return least.astype(np.uint32).view(np.int32)


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_hash, n_shingles, key, signature); key names the word sequence
    and is null for texts without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            sizes, keys, rows = [], [], []
            for text in batch.column(2):
                words = split_words(text.as_py())
                hashes = shingle_hashes(words)
                sizes.append(len(hashes))
                keys.append(xxhash.xxh3_128_digest(b" ".join(words)) if words else None)
                rows.append(signature(hashes) if words else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(rows, pa.list_(pa.int32()))], ["id", "text_hash", "n_shingles", "key", "signature"])

    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("text_hash", T.LongType()), T.StructField("n_shingles", T.LongType()), T.StructField("key", T.BinaryType()), T.StructField("signature", T.ArrayType(T.IntegerType()))])
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text")).mapInArrow(lean(run), schema)


def shingle_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(node, hashes): the full sets, under the key of their word sequence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            keys, sets = [], []
            for text in batch.column(1):
                if words := split_words(text.as_py()):
                    keys.append(xxhash.xxh3_128_digest(b" ".join(words)))
                    sets.append(shingle_hashes(words).view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(sets, pa.list_(pa.int64()))], ["node", "hashes"])

    return docs.select(id_col, text_col).mapInArrow(lean(run), "node binary, hashes array<bigint>")


def post(classes: DataFrame, percent: int) -> DataFrame:
    """(node, n, mass, token): each class under its rarest shared values.

    ``mass`` sums how often the class's values occur: the centre of a group of
    near copies shares more values than any other member.
    """
    matches = max(agreeing(POSTED, percent), 1)
    tokens = classes.select("node", "n", F.posexplode(F.slice("signature", 1, POSTED))).select("node", "n", (F.shiftleft(F.col("pos").cast("long"), 32) + F.col("col") + F.lit(1 << 31)).alias("token"))
    counts = tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    per_node = tokens.join(counts, "token").groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("shared"))
    # Values that occur once come first in the prefix and need no posting.
    kept = per_node.where(F.size("shared") >= matches).selectExpr("node", "n", "aggregate(shared, 0L, (s, x) -> s + x.df) as mass", f"slice(shared, 1, size(shared) - {matches - 1}) as prefix")
    return kept.select("node", "n", "mass", F.explode("prefix").alias("p")).select("node", "n", "mass", "p.token")


def _near_sizes(a: str, b: str, percent: int):
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def confirm(pairs: DataFrame, sets: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Those (a, b) of ``pairs`` whose full sets reach the threshold."""
    brief = classes.select("node", "signature")
    agree = F.size(F.filter(F.zip_with("sa", "sb", lambda x, y: x == y), lambda x: x))
    likely = (
        pairs.join(brief.select(F.col("node").alias("a"), F.col("signature").alias("sa")), "a")
        .join(brief.select(F.col("node").alias("b"), F.col("signature").alias("sb")), "b")
        .where(agree >= agreeing(COORDINATES, percent))
        .select("a", "b")
    )
    both = likely.join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("ha")), "a").join(sets.select(F.col("node").alias("b"), F.col("hashes").alias("hb")), "b")
    common = both.select("a", "b", F.size(F.array_intersect("ha", "hb")).cast("long").alias("common"), (F.size("ha") + F.size("hb")).cast("long").alias("total"))
    return common.where(F.col("common") * 100 >= (F.col("total") - F.col("common")) * percent).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for nodes with links.

    Alternates large-star and small-star steps until nothing changes; each
    step is one aggregate and one join, and no neighbourhood is collected.
    """
    edges = materialize(links.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).where("u <> v").distinct(), "edges")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("v", "m").alias("m"))
        # Large star: every larger neighbour moves to the smallest one.
        large = both.where("u > v").join(least, "v").select(F.col("u").alias("v"), F.col("m").alias("u")).where("u <> v").distinct()
        # Small star: so do the node and its smaller neighbours.
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(low, "v").select(F.col("u").alias("v"), F.col("m").alias("u")).unionByName(low.select("v", F.col("m").alias("u"))).where("u <> v").distinct()
        edges = materialize(small, "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("v").alias("node"), F.col("u").alias("component")).unionByName(edges.select(F.col("u").alias("node"), F.col("u").alias("component"))).distinct()
        state = now


def _forest(percent: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Links between components among one block pair's sets, as a forest."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        nodes, lookup = rows["node"].tolist(), {}
        comps = np.array([lookup.setdefault(c, len(lookup)) for c in rows["component"]])
        sets = [np.asarray(h, np.int64) for h in rows["hashes"]]
        sizes = np.array([len(h) for h in sets])
        values, local = np.unique(np.concatenate(sets), return_inverse=True)
        # Hashes of a single set cannot be common to two.
        shared = np.bincount(local, minlength=len(values)) > 1
        places = np.cumsum(shared) - 1
        width = -(-int(shared.sum()) // 64) or 1
        bits = np.zeros((len(sets), width), np.uint64)
        owner = np.repeat(np.arange(len(sets)), sizes)
        on = shared[local]
        at = places[local[on]]
        np.bitwise_or.at(bits, (owner[on], at // 64), np.uint64(1) << (at % 64).astype(np.uint64))
        root = np.arange(len(lookup))
        out: list[tuple[bytes, bytes]] = []
        for i in range(len(sets) - 1):
            # One pass per row: those after it, of other components, of like size.
            rest = np.flatnonzero((root[comps[i + 1 :]] != root[comps[i]]) & (np.minimum(sizes[i + 1 :], sizes[i]) * 100 >= np.maximum(sizes[i + 1 :], sizes[i]) * percent)) + i + 1
            if not len(rest):
                continue
            common = np.bitwise_count(bits[rest] & bits[i]).sum(1, dtype=np.int64)
            for j in rest[common * 100 >= (sizes[rest] + sizes[i] - common) * percent]:
                if (r := root[comps[j]]) != root[comps[i]]:
                    root[root == r] = root[comps[i]]
                    out.append((nodes[i], nodes[j]))
        return pd.DataFrame(out, columns=["a", "b"])

    return run


def link_blocks(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links in long lists: (token, component, node, n) met block by block."""
    blocks = members.groupBy("token").agg(F.ceil(F.greatest(F.sum("n") / BLOCK_SHINGLES, F.count("*") / BLOCK_MEMBERS)).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = members.join(blocks, "token").withColumn("own", own).select("token", "component", "node", "own", F.explode(F.expr("sequence(0, blocks - 1)")).alias("other"))
    dealt = dealt.select("token", "component", "node", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    return dealt.join(sets, "node").groupBy("token", "low", "high").applyInPandas(_forest(percent), "a binary, b binary")


def grouped_rows(docs: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    """(id, text_hash, n_shingles, component, component_id) of every row; the
    last two are null where the row is alone in its component."""
    each = materialize(signatures(docs, id_col, text_col), "signatures")
    named = each.where(F.col("key").isNotNull() & F.col("id").isNotNull())
    classes = materialize(
        named.groupBy(F.col("key").alias("node")).agg(F.min(F.struct("id", "n_shingles", "signature")).alias("x"), F.count("*").alias("copies")).select("node", "x.id", F.col("x.n_shingles").alias("n"), "x.signature", "copies"),
        "classes",
    )
    posted = materialize(post(classes, percent), "postings")
    wanted = materialize(classes.join(posted.select("node").distinct(), "node", "left_semi").select(F.col("id").alias(id_col)).distinct(), "compared")
    sets = materialize(shingle_sets(keep_ids(docs, wanted, id_col), id_col, text_col).dropDuplicates(["node"]), "shingle-sets")

    pivots = posted.groupBy("token").agg(F.max(F.struct("mass", "node", "n")).alias("pivot"), F.count("*").alias("size")).where("size > 1")
    spokes = posted.join(pivots, "token").where(F.col("node") != F.col("pivot.node")).where(_near_sizes("n", "pivot.n", percent))
    first = spokes.select(F.least("node", "pivot.node").alias("a"), F.greatest("node", "pivot.node").alias("b")).distinct()
    links = materialize(confirm(first, sets, classes, percent), "links")

    grouped = components(links)
    placed = materialize(posted.drop("mass").join(grouped, "node", "left").withColumn("component", F.coalesce("component", "node")), "placed")
    lists = placed.groupBy("token").agg(F.count("*").alias("size"), F.min("component").alias("c0"), F.max("component").alias("c1")).where("c0 <> c1").select("token", "size")
    live = placed.join(lists, "token")
    short, long = live.where(F.col("size") <= SHORT).drop("size"), live.where(F.col("size") > SHORT).drop("size")
    other = short.select("token", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("component").alias("cb"))
    pairs = short.withColumnRenamed("node", "a").join(other, "token").where((F.col("a") < F.col("b")) & (F.col("component") != F.col("cb")) & _near_sizes("n", "nb", percent)).select("a", "b").distinct()
    more = materialize(confirm(pairs, sets, classes, percent).unionByName(link_blocks(long, sets, percent)), "links")

    grouped = components(links.unionByName(more))
    smallest = grouped.join(classes.select("node", "id"), "node")
    least = smallest.groupBy("component").agg(F.min("id").alias("component_id"))
    linked = grouped.join(least, "component").select("node", "component", "component_id")
    # Only copies and linked classes have a component other than themselves.
    moved = classes.join(linked, "node", "left").where("copies > 1 or component_id is not null")
    # Written, so that both sides of the join below are plain shuffles and a
    # class of very many copies can be split.
    moved = materialize(moved.select(F.col("node").alias("key"), F.coalesce("component", "node").alias("component"), F.coalesce("component_id", "id").alias("component_id")), "moved")
    return each.drop("signature").join(moved, "key", "left").drop("key")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, percent: int = PERCENT) -> DataFrame:
    """(id, n_shingles, component_id, kept) of every document; those whose
    similarity is ``percent`` or more are linked."""
    out = grouped_rows(docs, id_col, text_col, percent)
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return out.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each group, all columns as they were.

    The row of smallest id stays; where that id has several texts in the group,
    the one of smallest hash, and of rows of equal id and text any one."""
    rows = grouped_rows(docs, id_col, text_col, percent).where(F.col("component").isNotNull() & F.col("id").isNotNull())
    rows = materialize(rows.groupBy("component", "component_id", "id", "text_hash").agg(F.count("*").alias("n")), "grouped")
    first = materialize(rows.where("id = component_id").groupBy("component").agg(F.min("text_hash").alias("first")), "first")
    placed = rows.join(first, "component").withColumn("stays", (F.col("id") == F.col("component_id")) & (F.col("text_hash") == F.col("first")))
    gone = materialize(placed.where("not stays or n > 1").select("id", "text_hash", "stays"), "removed")
    out = without_rows(docs, gone.select("id", "text_hash"), id_col, text_col)
    # Only rows that stay and are repeated as a whole are looked at once more.
    twice = gone.where("stays")
    if twice.isEmpty():
        return out
    whole = docs.select(F.struct("*").alias("doc"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"))
    once = whole.join(twice.select("id", "text_hash"), ["id", "text_hash"], "left_semi").dropDuplicates(["id", "text_hash"])
    return out.unionByName(once.select(*(F.col("doc").getField(c).alias(c) for c in docs.columns)))
