"""Alignment of two tokenizers' tokens over the same bytes.

A text behind one space is encoded by a byte-level tokenizer (A) and by a
sentencepiece model (B, which adds the space itself). Per batch of documents,
``pandas.merge_asof`` keyed by document finds for each token's start the other
side's token that covers it; both directions together are all overlaps, once
the pairs that start together are counted once. Offsets where both sides end
cut the tokens into groups.

A pair of ids counts the documents that hold it linked. Counting starts in the
tasks (a document's distinct pairs, then those of many documents), so a common
pair is few rows by its shuffle. Counts come back in two tiers: pairs of most
documents, ``FREQUENT`` at most, are looked up where the links are; the rest,
none of them common, meet their counts by a join, and only sums per document go
back to its row. Texts are encoded once; links are kept as packed pairs.

Cases: a null or empty text has no tokens, nor has one whose bytes on a side
differ from space and text (a model may rewrite characters, and U+2581 in a
text reads as a space): all counts are zero and the digest is empty; rows that
repeat an id are documents of their own; blank and very long texts are aligned
whole; an empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossaflow.llm.bpe import default_pattern, encode_text, safe_chunks
from glossaflow.llm.common import checked_broadcast, lean, materialize
from glossaflow.llm.token_counts import _UNSTABLE, default_path

#: Characters aligned at once (one document at least).
BATCH_CHARS = 1 << 19
#: Pairs of most documents that are looked up without a shuffle.
FREQUENT = 1 << 18
#: Keys counted together in a task before they are handed on.
COUNT_KEYS = 1 << 21

COUNTS = ("n_a", "n_b", "n_groups", "n_links")


# --- tokenizers --------------------------------------------------------------


def byte_alphabet() -> dict[str, int]:
    """The byte that each letter of byte-level vocabularies stands for:
    printable Latin-1 itself, the other bytes in order from U+0100 on."""
    # The printable ranges.
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(rest)}


class Side:
    """A tokenizer as ``encode`` (texts to ids) with the bytes of each id."""

    def __init__(self, encode, pieces: list[bytes]):
        self.encode, self.pieces = encode, pieces
        self.sizes = np.array([len(p) for p in pieces], np.int64)
        self.names = {end: np.array([f"{i}{end}" for i in range(len(pieces))], object) for end in (",", "|", ";", "")}

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of space and text; none where their bytes say another thing."""
        out = []
        for text, ids in zip(texts, self.encode(texts), strict=True):
            same = b"".join(map(self.pieces.__getitem__, ids)) == b" " + text.encode()
            out.append(np.array(ids if same else [], np.int64))
        return out


def ranked(path: str, pieces: list[bytes]):
    """The file's vocabulary as ranks for a faster encoder, or none where its
    ids are not in order of its merges or its pattern is another."""
    import tiktoken

    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    letters, merges = byte_alphabet(), told["model"].get("merges", [])
    joined = [bytes(letters.get(c, 0) for c in (m if isinstance(m, str) else " ".join(m)).replace(" ", "")) for m in merges]
    first = next((i for i, p in enumerate(pieces) if len(p) > 1), len(pieces))
    split = told.get("pre_tokenizer") or {}
    if told.get("normalizer") or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or split.get("use_regex") is False or joined != pieces[first : first + len(joined)]:
        return None
    return tiktoken.Encoding("local", pat_str=default_pattern(), mergeable_ranks={p: i for i, p in enumerate(pieces[: first + len(joined)])}, special_tokens={})


@cache
def byte_side(path: str) -> Side:
    """A tokenizer whose special tokens are plain text within texts."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks are the parallelism
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    tokenizer.encode_special_tokens = True
    alphabet, vocabulary = byte_alphabet(), tokenizer.get_vocab()
    pieces = [b""] * (max(vocabulary.values()) + 1)
    for piece, i in vocabulary.items():
        pieces[i] = bytes(alphabet[c] for c in piece) if all(c in alphabet for c in piece) else piece.encode()

    ranks = ranked(path, pieces)

    def encode(texts: list[str]) -> list[list[int]]:
        # Of characters whose class differs between Unicode versions the
        # library decides; for the others the ranks give the same ids sooner.
        plain = [ranks is not None and (t.isascii() or not _UNSTABLE.search(t)) for t in texts]
        apart = [t for t, p in zip(texts, plain, strict=True) if not p]
        chunks = [list(safe_chunks(f" {t}", 1 << 18)) for t in apart]
        rest = iter(tokenizer.encode_batch_fast([c for cs in chunks for c in cs], add_special_tokens=False))
        slow = iter([[i for _ in cs for i in next(rest).ids] for cs in chunks])
        return [encode_text(ranks, f" {t}") if p else next(slow) for t, p in zip(texts, plain, strict=True)]

    return Side(encode, pieces)


@cache
def piece_side(path: str) -> Side:
    """A sentencepiece model; pieces of one byte stand for it."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode() for i in range(model.vocab_size())]
    return Side(lambda texts: model.encode(texts, num_threads=1), pieces)


# --- one batch ---------------------------------------------------------------


def tokens_of(ids: list[np.ndarray], sizes: np.ndarray, side: str) -> pd.DataFrame:
    """One row for each token: its document, start, and ``side``'s place, id and
    end. Offsets run on over the batch's documents, so starts are sorted."""
    flat = np.concatenate(ids) if ids else np.empty(0, np.int64)
    end = np.cumsum(sizes[flat])
    return pd.DataFrame({"doc": np.repeat(np.arange(len(ids)), [len(x) for x in ids]), "start": end - sizes[flat], f"{side}_start": end - sizes[flat], f"{side}_at": np.arange(len(flat)), f"{side}_id": flat, f"{side}_end": end})


def links_of(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
    """Every pair of an A and a B token whose bytes overlap."""
    forth = pd.merge_asof(a, b, on="start", by="doc")
    back = pd.merge_asof(b, a, on="start", by="doc")
    return pd.concat([forth, back[back["a_start"] < back["b_start"]]], ignore_index=True)


def group_texts(a: pd.DataFrame, b: pd.DataFrame, links: pd.DataFrame, one: Side, two: Side, docs: int) -> tuple[np.ndarray, list[str]]:
    """(n_groups, text) of each document: ids as ``a1,a2|b1;a3|b2,b3``."""
    cut = links[links["a_end"] == links["b_end"]]
    last_a, last_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    last_a[cut["a_at"]], last_b[cut["b_at"]] = True, True
    n_groups = np.bincount(cut["doc"], minlength=docs)
    place = lambda last: np.append(0, np.flatnonzero(last) + 1)
    edge_a, edge_b = place(last_a), place(last_b)  # where each group begins on a side
    group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    pieces = np.empty(len(a) + len(b), object)
    ids, more = a["a_id"].to_numpy(), b["b_id"].to_numpy()
    pieces[np.arange(len(a)) + edge_b[group_a]] = np.where(last_a, one.names["|"][ids], one.names[","][ids])
    doc_b = b["doc"].to_numpy()
    final = np.append(doc_b[1:] != doc_b[:-1], True)[: len(b)]
    pieces[np.arange(len(b)) + edge_a[1:][group_b]] = np.where(final, two.names[""][more], np.where(last_b, two.names[";"][more], two.names[","][more]))
    sizes = np.bincount(a["doc"], minlength=docs) + np.bincount(doc_b, minlength=docs)
    return n_groups, ["".join(p) for p in np.split(pieces, np.cumsum(sizes)[:-1])]


def packed(counts: np.ndarray) -> bytes:
    """Counts as bytes where they fit, else as 32-bit numbers."""
    return counts.astype(np.uint8 if counts.max(initial=0) < 256 else np.uint32).tobytes()


def unpacked(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, np.uint8 if len(data) == n else np.uint32).astype(np.int64)


def align_batch(texts: list[str], one: Side, two: Side) -> dict[str, list]:
    """Counts, digest and packed pairs (key, times) of each text."""
    ids_a, ids_b = one.ids(texts), two.ids(texts)
    for n, (x, y) in enumerate(zip(ids_a, ids_b, strict=True)):
        if not texts[n] or not len(x) or not len(y):
            ids_a[n] = ids_b[n] = np.empty(0, np.int64)
    a, b = tokens_of(ids_a, one.sizes, "a"), tokens_of(ids_b, two.sizes, "b")
    links = links_of(a, b)
    n_groups, groups = group_texts(a, b, links, one, two, len(texts))
    # One number for document and pair; a document's pairs in order.
    wide = len(two.pieces)
    span = len(one.pieces) * wide
    keys, times = np.unique(links["doc"].to_numpy() * span + links["a_id"].to_numpy() * wide + links["b_id"].to_numpy(), return_counts=True)
    edges = np.searchsorted(keys, np.arange(len(texts) + 1) * span)
    kind = np.uint32 if span < 2**32 else np.uint64
    return {
        "n_a": [len(x) for x in ids_a], "n_b": [len(x) for x in ids_b], "n_groups": n_groups.tolist(), "n_links": np.bincount(links["doc"], minlength=len(texts)).tolist(),
        "groups_sha256": [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups],
        "pairs": [(keys[s:e] % span).astype(kind).tobytes() for s, e in zip(edges[:-1], edges[1:], strict=True)],
        "times": [packed(times[s:e]) for s, e in zip(edges[:-1], edges[1:], strict=True)],
    }


# --- tables ------------------------------------------------------------------


def aligned(docs: DataFrame, id_col: str, text_col: str, path_a: str, path_b: str) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times)."""
    fields = [*((c, pa.int64()) for c in COUNTS), ("groups_sha256", pa.string()), ("pairs", pa.binary()), ("times", pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = byte_side(path_a), piece_side(path_b)
        for batch in batches:
            start, chars, texts = 0, 0, []
            for n, text in enumerate(batch.column(1)):
                texts.append(text.as_py() or "")
                chars += len(texts[-1])
                if chars >= BATCH_CHARS or n == batch.num_rows - 1:
                    found = align_batch(texts, one, two)
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(texts)), *(pa.array(found[c], t) for c, t in fields)], [id_col, *(c for c, _ in fields)])
                    start, chars, texts = n + 1, 0, []

    kinds = {pa.int64(): T.LongType(), pa.string(): T.StringType(), pa.binary(): T.BinaryType()}
    schema = T.StructType([docs.schema[id_col], *(T.StructField(c, kinds[t]) for c, t in fields)])
    return docs.select(id_col, text_col).mapInArrow(lean(run), schema)


def pair_counts(links: DataFrame, wide: int, key_bytes: int) -> DataFrame:
    """(pair, docs, top): the documents that hold each pair, and whether these
    are the most for its A id."""
    kind = np.uint32 if key_bytes == 4 else np.uint64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def counted() -> pa.RecordBatch:
            keys, docs = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(docs.astype(np.int64))], ["pair", "docs"])

        for batch in batches:
            for pairs in batch.column(0):
                held.append(np.frombuffer(pairs.as_buffer(), kind))
                size += len(held[-1])
                if size >= COUNT_KEYS:
                    yield counted()
                    held, size = [], 0
        if size:
            yield counted()

    counts = materialize(links.select("pairs").mapInArrow(lean(run), "pair long, docs long").groupBy("pair").agg(F.sum("docs").alias("docs")), "pairs")
    a = F.expr(f"pair div {int(wide)}")
    # A row for each id of A.
    most = counts.groupBy(a.alias("a")).agg(F.max("docs").alias("most"))
    return materialize(counts.join(F.broadcast(most), a == F.col("a")).select("pair", "docs", (F.col("docs") == F.col("most")).alias("top")), "counts")


def frequent_pairs(counts: DataFrame, limit: int = FREQUENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted pairs of most documents with docs and top: as many classes of
    like counts, from the highest, as hold ``limit`` pairs at most."""
    step = F.floor(F.log2("docs") * 8)
    least, total = None, 0
    # Classes are eighths of a power of two: a few hundred rows.
    for r in counts.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():
        total += r["count"]
        if total > limit:
            break
        least = r["step"]
    found = counts.where(step >= least if least is not None else F.lit(False)).toArrow()
    order = np.argsort(np.asarray(found["pair"]))
    return tuple(np.asarray(found[c])[order] for c in ("pair", "docs", "top"))


def looked_up(links: DataFrame, tier: tuple[np.ndarray, np.ndarray, np.ndarray], key_bytes: int) -> DataFrame:
    """(row, n_best, count_sum, rest): sums over the links of frequent pairs,
    and the other pairs with how often they are linked."""
    shared = links.sparkSession.sparkContext.broadcast(tier)  # FREQUENT pairs at most
    kind = np.uint32 if key_bytes == 4 else np.uint64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, docs, top = shared.value
        for batch in batches:
            best, sums, edges, pairs, many = [], [], [0], [], []
            for p, t in zip(batch.column(1), batch.column(2), strict=True):
                keys = np.frombuffer(p.as_buffer(), kind).astype(np.int64)
                times = unpacked(t.as_py(), len(keys))
                at = np.searchsorted(known, keys)
                at[at == len(known)] = 0
                hit = known[at] == keys if len(known) else np.zeros(len(keys), bool)
                at, n = at[hit], times[hit]
                best.append(int(n[top[at]].sum()))
                sums.append(int((n * docs[at]).sum()))
                pairs.append(keys[~hit])
                many.append(times[~hit])
                edges.append(edges[-1] + len(pairs[-1]))
            rest = pa.StructArray.from_arrays([pa.array(np.concatenate(pairs or [np.empty(0, np.int64)])), pa.array(np.concatenate(many or [np.empty(0, np.int64)]))], ["pair", "times"])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(best, pa.int64()), pa.array(sums, pa.int64()), pa.ListArray.from_arrays(pa.array(edges, pa.int32()), rest)], ["row", "n_best", "count_sum", "rest"])

    return links.select("row", "pairs", "times").mapInArrow(lean(run), "row long, n_best long, count_sum long, rest array<struct<pair: long, times: long>>")


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, path_a: str | None = None, path_b: str | None = None, frequent: int = FREQUENT) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)."""
    path_a, path_b = path_a or default_path(), path_b or default_path("piece_bpe_32k.model")
    wide = len(piece_side(path_b).pieces)
    key_bytes = 4 if len(byte_side(path_a).pieces) * wide < 2**32 else 8
    links = materialize(aligned(docs, id_col, text_col, path_a, path_b).withColumn("row", F.monotonically_increasing_id()), "links")
    counts = pair_counts(links, wide, key_bytes)
    first = materialize(looked_up(links, frequent_pairs(counts, frequent), key_bytes), "looked_up")
    rest = first.select("row", F.inline("rest")).join(checked_broadcast(counts), "pair")
    second = rest.select("row", F.when(F.col("top"), F.col("times")).otherwise(0).alias("n_best"), (F.col("times") * F.col("docs")).alias("count_sum"))
    parts = first.select("row", "n_best", "count_sum").unionByName(second).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return links.select(id_col, "row", *COUNTS, "groups_sha256").join(parts, "row").select(id_col, *COUNTS, "n_best", "count_sum", "groups_sha256")
