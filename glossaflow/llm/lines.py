r"""Line dedup by a tree of log templates.

Lines fall into the leaves of a fixed-depth tree: the number of tokens, then
the ``DEPTH`` leading tokens, where a token with a digit is a variable field
``<*>``. In a leaf the documents of each token at its place are counted. A
line's template keeps its commonest tokens, at least ``SIMILAR`` per cent of
all (those as common as the rarest kept stay, too); the others become ``<*>``.
What varies in a family of lines is rarer than what does not, so its lines
share one template, whatever else is in the leaf and however large it is. A
template of at least ``MIN_DOCS`` documents is boilerplate. Lines of
``LONG_TOKENS`` tokens or more are so from ``LONG_DOCS`` documents of different
text on where they agree in ``LONG_SIMILAR`` per cent of their tokens: a few
copies of a whole document are no sign of a passage, and are left whole for the
dedup of documents. So are the long lines that a document shares with one that
keeps them if the lines alone make both similar by ``copies`` per cent of their
shingles of ``WORDS`` words (sure ones only, see :func:`near_copy`): dedup of
documents at that threshold takes one of the two. Below it nothing else would
take the lines, so they go. Order plays no part, and lines meet in aggregates
of their template only: no pairs are made.

Boilerplate lines are dropped from every document but the one with the
smallest id (and, by the second rule, its copies), so that what a group of
documents says is said once.

A line is a row of hashes until its leaf is known to recur; the words of such
leaves are then read once more, each distinct line once. A bitmap of
``BITMAP_BITS`` bits tells the readers which leaves to look for; its size is
fixed, and what it lets through in vain a join takes out. Nothing else is
broadcast. Counts are pre-aggregated, so a passage in a third of all documents
is one row of each aggregate.

Cases: a null text stays null, an empty one empty; blank lines and lines of
fewer than ``MIN_TOKENS`` tokens are never dropped; tokens with a digit are
never constant; rows with a null id count for no document and are never the
one that keeps a line; rows that repeat an id are told apart by their text and
count as one document, equal rows are treated alike, and of a line that stands
twice in the document that keeps it both stay. Equally common tokens stay or go
together, so there are no ties to break. Very long lines are compared whole.
Leaves, lines, tokens and templates are known by 64-bit hashes. An empty table
gives an empty result. Extra columns of any name are kept; ``n_lines`` and
``n_dropped`` replace columns of that name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossaflow.llm.common import lean, materialize

DEPTH = 3
MIN_DOCS = 5
MIN_TOKENS = 3
#: Per cent of a line's tokens that its template keeps.
SIMILAR = 80
#: Lines of so many tokens recur from so many documents on, if that per cent
#: of their tokens is kept.
LONG_TOKENS, LONG_DOCS, LONG_SIMILAR = 50, 2, 95
#: Similarity in per cent from which two documents are left to the dedup of
#: documents, and words of the shingles that this is measured in.
COPIES, WORDS = 80, 5
BITMAP_BITS = 1 << 25

_DIGIT = re.compile(rb"[0-9]")


def tokens_of(line: bytes) -> list[bytes]:
    """White-space tokens, those with a digit as ``<*>``."""
    tokens = line.split()
    if _DIGIT.search(line):
        tokens = [b"<*>" if _DIGIT.search(t) else t for t in tokens]
    return tokens


def _cut(text: str | None, depth: int, min_tokens: int) -> Iterator[tuple[int, int, int, bytes]]:
    """(place, tokens, leaf, line) of the lines that are long enough; at the
    end the tokens of all lines, under no place."""
    import xxhash

    total = 0

    for pos, line in enumerate((text or "").encode("utf-8", "replace").split(b"\n")):
        tokens = tokens_of(line)
        total += len(tokens)
        if len(tokens) >= min_tokens:
            yield pos, len(tokens), xxhash.xxh3_64_intdigest(b"%d %s" % (len(tokens), b" ".join(tokens[:depth]))), b" ".join(tokens)
    yield -1, total, 0, b""


def _hashes(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def line_hashes(docs: DataFrame, id_col: str, text_col: str, depth: int, min_tokens: int) -> DataFrame:
    """(id, text_hash, pos, n, leaf, line_hash, total) of every line long
    enough; ``total`` is the tokens of its document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            source, places, sizes, leaves, lines, totals = [], [], [], [], [], []
            for i, text in enumerate(batch.column(2)):
                for pos, n, leaf, line in _cut(text.as_py(), depth, min_tokens):
                    if pos < 0:
                        totals += [n] * (len(places) - len(totals))
                        continue
                    source.append(i)
                    places.append(pos)
                    sizes.append(n)
                    leaves.append(leaf)
                    lines.append(xxhash.xxh3_64_intdigest(line))
            at = pa.array(source, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(places, pa.int32()), pa.array(sizes, pa.int32()), _hashes(leaves), _hashes(lines), pa.array(totals, pa.int32())],
                ["id", "text_hash", "pos", "n", "leaf", "line_hash", "total"],
            )

    cut = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    schema = T.StructType(
        [T.StructField("id", docs.schema[id_col].dataType), T.StructField("text_hash", T.LongType()), T.StructField("pos", T.IntegerType())]
        + [T.StructField("n", T.IntegerType()), T.StructField("leaf", T.LongType()), T.StructField("line_hash", T.LongType()), T.StructField("total", T.IntegerType())]
    )
    return cut.mapInArrow(lean(run), schema)


def _bit(leaf: Column) -> Column:
    return F.pmod(leaf, F.lit(BITMAP_BITS)) + 1


def line_words(docs: DataFrame, leaves: DataFrame, text_col: str, depth: int, min_tokens: int) -> DataFrame:
    """(leaf, line_hash, line) of the distinct lines of ``leaves``, and of
    others whose leaf shares a bit with one of them."""
    width = 32_768  # the bits of one row of Spark's bitmap functions
    made = leaves.select(_bit(F.col("leaf")).alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    bitmap = np.zeros(BITMAP_BITS // 8, np.uint8)
    for row in made.toLocalIterator():  # at most BITMAP_BITS / width rows
        start = (row["bucket"] - 1) * width // 8
        bitmap[start : start + width // 8] = np.frombuffer(row["bits"], np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        bits = shared.value
        for batch in batches:
            found: dict[bytes, int] = {}
            for text in batch.column(0):
                for pos, _, leaf, line in _cut(text.as_py(), depth, min_tokens):
                    bit = leaf % BITMAP_BITS
                    if pos >= 0 and bits[bit >> 3] >> (bit & 7) & 1:
                        found[line] = leaf
            hashes = [xxhash.xxh3_64_intdigest(line) for line in found]
            yield pa.RecordBatch.from_arrays([_hashes(list(found.values())), _hashes(hashes), pa.array(list(found), pa.binary()).cast(pa.string())], ["leaf", "line_hash", "line"])

    return docs.select(text_col).mapInArrow(lean(run), "leaf long, line_hash long, line string")


def _nth(counts: Column, n: Column, percent: int) -> Column:
    """How common the rarest token is that a template has to keep, or null."""
    return F.get(counts, F.floor((n * percent + 99) / 100).cast("int") - 1)


def templates(occurring: DataFrame, words: DataFrame, min_docs: int, similar: int, long: tuple[int, int, int]) -> DataFrame:
    """(line_hash, strict, first, equal): the distinct lines of ``occurring``
    that are boilerplate, with the (id, text_hash, total) that comes first in
    their template, whether it is one of long lines, and whether that document
    holds the very line."""
    held = materialize(occurring.where(F.col("id").isNotNull()).select("leaf", "line_hash", "id", "text_hash", "total").distinct(), "held")
    key = F.transform("words", lambda w, i: F.when(w != "<*>", F.xxhash64("leaf", i, w)))
    distinct = words.join(held.select("line_hash").distinct(), "line_hash", "left_semi").dropDuplicates(["line_hash"])
    keyed = distinct.withColumn("words", F.split("line", " ")).select("line_hash", F.size("words").alias("n"), F.array_compact(key).alias("keys"))
    keyed = materialize(keyed, "keyed")

    # A document with one line of a leaf counts for all its tokens as it is;
    # only where it has several may a token be seen twice.
    each = materialize(held.groupBy("leaf", "id").agg(F.count("*").alias("c"), F.min("line_hash").alias("line_hash")), "each")
    single = each.where("c = 1").groupBy("line_hash").agg(F.count("*").alias("docs"))
    one = single.join(keyed, "line_hash").select(F.explode("keys").alias("key"), "docs").groupBy("key").agg(F.sum("docs").alias("seen"))
    several = held.join(each.where("c > 1").select("leaf", "id"), ["leaf", "id"], "left_semi")
    many = several.join(keyed, "line_hash").select(F.explode("keys").alias("key"), "id").distinct().groupBy("key").agg(F.count("*").alias("seen"))
    seen = one.unionByName(many).groupBy("key").agg(F.sum("seen").alias("seen")).where(F.col("seen") >= min(min_docs, long[1]))
    # Written, so that the join below can split what very many lines share.
    seen = materialize(seen, "seen")

    places = keyed.select("line_hash", "n", F.explode("keys").alias("key")).join(seen, "key")
    places = places.groupBy("line_hash", "n").agg(F.sort_array(F.collect_list(F.struct("seen", "key")), asc=False).alias("places"))
    places = places.where(F.size("places") >= F.floor((F.col("n") * min(similar, long[2]) + 99) / 100))
    counts = F.col("places.seen")
    least = F.array(_nth(counts, F.col("n"), similar), F.when(F.col("n") >= long[0], _nth(counts, F.col("n"), long[2])))
    shaped = places.select("line_hash", "places", F.posexplode(least).alias("strict", "least")).where("least is not null")
    kept = F.transform(F.filter("places", lambda p: p["seen"] >= F.col("least")), lambda p: p["key"])
    shaped = materialize(shaped.select("line_hash", "strict", F.xxhash64("strict", kept).alias("template")), "templates")

    # Lines of one strict template have the other kind's template in common,
    # too: they all go to that if it recurs, and else to the strict one.
    met = held.select("line_hash", "id", "text_hash", "total").join(shaped, "line_hash")
    who = F.when(F.col("strict") == 0, F.xxhash64("id")).otherwise(F.col("text_hash"))
    counted = met.groupBy("template", "strict").agg(F.countDistinct(who).alias("docs"), F.min(F.struct("id", "text_hash", "total")).alias("first"))
    recurring = materialize(counted.where(F.col("docs") >= F.when(F.col("strict") == 0, min_docs).otherwise(long[1])).select("template", "first"), "recurring")
    drawn = shaped.join(recurring, "template").groupBy("line_hash").agg(F.min(F.struct("strict", "first")).alias("x"))
    own = held.groupBy("line_hash").agg(F.min(F.struct("id", "text_hash", "total")).alias("own"))
    return materialize(drawn.join(own, "line_hash").select("line_hash", "x.strict", "x.first", (F.col("x.first") == F.col("own")).alias("equal")), "boilerplate")


def sure_shingles(n: Column, equal: Column, long: tuple[int, int, int]) -> Column:
    """Shingles that a long line of ``n`` tokens has in common with one of its
    template: all within it if they are equal; else each token that may differ
    costs as many as a shingle has words."""
    apart = F.floor((n * (100 - long[2]) + 99) / 100) * WORDS
    return F.greatest(n - (WORDS - 1) - F.when(equal, 0).otherwise(apart), F.lit(0)).cast("long")


def near_copy(shared: Column, total: Column, other: Column, percent: int) -> Column:
    """Whether ``shared`` shingles make texts of so many tokens similar."""
    return shared * 100 >= (total.cast("long") + other - 2 * (WORDS - 1) - shared) * percent


def drops_of(docs: DataFrame, id_col: str, text_col: str, *, depth: int, min_docs: int, min_tokens: int, similar: int, long: tuple[int, int, int], copies: int) -> DataFrame:
    """(id, text_hash, drops): the places of the lines that each text loses."""
    lines = materialize(line_hashes(docs, id_col, text_col, depth, min_tokens), "lines")
    reached = lines.where(F.col("id").isNotNull()).select("leaf", "n", "id").distinct().groupBy("leaf", "n").agg(F.count("*").alias("docs"))
    leaves = materialize(reached.where(F.col("docs") >= F.when(F.col("n") >= long[0], min(min_docs, long[1])).otherwise(min_docs)).select("leaf"), "leaves")
    # Joins by shuffle whatever the size: what is broadcast would grow.
    occurring = materialize(lines.join(leaves.hint("merge"), "leaf"), "occurring")
    drawn = templates(occurring, line_words(docs, leaves, text_col, depth, min_tokens), min_docs, similar, long)
    stays = F.col("id").eqNullSafe(F.col("first.id")) | ((F.col("strict") == 1) & (F.col("text_hash") == F.col("first.text_hash")))
    gone = occurring.join(drawn.hint("merge"), "line_hash").where(~stays)
    # By the document that keeps the lines; by none for those of many.
    with_ = F.when(F.col("strict") == 1, F.col("first"))
    each = gone.groupBy("id", "text_hash", with_.alias("with")).agg(F.sum(sure_shingles(F.col("n"), F.col("equal"), long)).alias("shared"), F.max("total").alias("total"), F.collect_set("pos").alias("places"))
    copy = F.coalesce(near_copy(F.col("shared"), F.col("total"), F.col("with.total"), copies), F.lit(False))
    drops = each.where(~copy).groupBy("id", "text_hash").agg(F.flatten(F.collect_list("places")).alias("drops"))
    return materialize(drops, "drops")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, depth: int = DEPTH, min_docs: int = MIN_DOCS, min_tokens: int = MIN_TOKENS, similar: int = SIMILAR, long: tuple[int, int, int] = (LONG_TOKENS, LONG_DOCS, LONG_SIMILAR), copies: int = COPIES) -> DataFrame:
    """``docs`` with boilerplate lines out of ``text_col``, plus the columns
    ``n_lines`` and ``n_dropped`` (which replace any of that name).
    ``long`` has the tokens, documents and per cent of long lines, ``copies``
    the threshold of the dedup of documents that follows (over 100: none)."""
    drops = drops_of(docs, id_col, text_col, depth=depth, min_docs=min_docs, min_tokens=min_tokens, similar=similar, long=long, copies=copies)
    # The document is one struct, so that none of its names meets one of ours.
    whole = docs.select(F.struct("*").alias("doc"), F.col(text_col).alias("text"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"))
    key = whole["id"].eqNullSafe(drops["id"]) & (whole["text_hash"] == drops["text_hash"])
    joined = whole.join(drops.hint("shuffle_hash"), key, "left").select("doc", "text", "drops")
    lines = F.split("text", "\n")
    left = F.array_join(F.filter(lines, lambda _, i: ~F.array_contains("drops", i)), "\n")
    made = {
        text_col: F.when(F.col("drops").isNull(), F.col("text")).otherwise(left),
        "n_lines": F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long"),
        "n_dropped": F.coalesce(F.size("drops"), F.lit(0)).cast("long"),
    }
    kept = [made.pop(c).alias(c) if c in made else F.col("doc").getField(c).alias(c) for c in docs.columns]
    return joined.select(*kept, *(c.alias(name) for name, c in made.items()))
