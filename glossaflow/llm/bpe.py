"""Byte-level BPE with a local rank file: encoding, decoding, safe splitting.

Cases: a null text counts as empty (no ids); an empty text has no ids and
decodes to no bytes; repeated rows are encoded each on its own; very long
texts are cut at boundaries that every match respects, and white-space runs
too long for the library's backtracking are encoded as the single matches
they are; an empty table gives an empty result. Extra columns are ignored;
outputs carry the id column only.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossaflow.llm.common import WHITE, lean

CHUNK = 65_536
LONG_RUN = 4_096

#: A cut before white space that follows something else splits no match: no
#: alternative of the pattern has white space after its first character except
#: those that match white space alone.
_CUT = re.compile(f"(?<=[^{WHITE}])[{WHITE}]")
_RUN = re.compile(f"[{WHITE}]{{{LONG_RUN},}}")


def safe_chunks(text: str, limit: int = CHUNK) -> Iterator[str]:
    """Pieces of ``text`` of about ``limit`` characters that split no match."""
    start = 0
    while len(text) - start > limit:
        cut = _CUT.search(text, start + limit)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:] if start else text


def default_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


@cache
def load_encoding(path: str, pattern: str):
    """The library's encoding of a rank file; one per worker process."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def encode_text(encoding, text: str) -> list[int]:
    """Ids of one text, equal to ``encode_ordinary`` where that can run."""
    ids: list[int] = []
    for chunk in safe_chunks(text):
        at = 0
        if len(chunk) >= LONG_RUN:
            for run in _RUN.finditer(chunk):
                # Before something else the last character is matched apart.
                end = run.end() - (run.end() < len(chunk))
                ids += encoding.encode_ordinary(chunk[at : run.start()])
                ids += encoding._encode_single_piece(chunk[run.start() : end])
                at = end
        ids += encoding.encode_ordinary(chunk[at:] if at else chunk)
    return ids


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """(id, n_tokens, ids): ids packed as little-endian unsigned 32-bit integers.

    A pure map over Arrow batches: no shuffle, no order needed.
    """
    path, pattern = path or default_path(), pattern or default_pattern()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        encoding = load_encoding(path, pattern)
        for batch in batches:
            packed, counts = [], []
            for text in batch.column(1):
                ids = encode_text(encoding, text.as_py() or "")
                counts.append(len(ids))
                packed.append(np.array(ids, "<u4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(packed, pa.binary())], [id_col, "n_tokens", "ids"])

    schema = T.StructType([docs.schema[id_col], T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])
    return docs.select(id_col, text_col).mapInArrow(lean(run), schema)


def decode(encoded: DataFrame, id_col: str = "doc_id", *, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """(id, n_tokens, ids, decoded): the raw bytes of packed ``ids``.

    Bytes, not text: ids cut anywhere may end inside a character.
    """
    path, pattern = path or default_path(), pattern or default_pattern()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        encoding = load_encoding(path, pattern)
        for batch in batches:
            out = [encoding.decode_bytes(np.frombuffer(ids.as_py() or b"", "<u4").tolist()) for ids in batch.column(2)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], [*batch.schema.names, "decoded"])

    columns = [id_col, "n_tokens", "ids"]
    schema = T.StructType([*(encoded.schema[c] for c in columns), T.StructField("decoded", T.BinaryType())])
    return encoded.select(columns).mapInArrow(lean(run), schema)


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """(id, n_tokens, ids, decoded): :func:`encode` and :func:`decode` in one
    pass, so that a task holds one worker and one copy of the ranks."""
    path, pattern = path or default_path(), pattern or default_pattern()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        encoding = load_encoding(path, pattern)
        for batch in batches:
            packed, decoded, counts = [], [], []
            for text in batch.column(1):
                ids = np.array(encode_text(encoding, text.as_py() or ""), "<u4")
                counts.append(len(ids))
                packed.append(ids.tobytes())
                decoded.append(encoding.decode_bytes(np.frombuffer(packed[-1], "<u4").tolist()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(packed, pa.binary()), pa.array(decoded, pa.binary())], [id_col, "n_tokens", "ids", "decoded"])

    schema = T.StructType([docs.schema[id_col], T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.BinaryType())])
    return docs.select(id_col, text_col).mapInArrow(lean(run), schema)


def digests(decoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of :func:`decode`'s rows."""
    return decoded.select(id_col, "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
