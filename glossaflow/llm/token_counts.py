"""Token counts by a two-tier lookup on the map side.

Tier one is a compact table of frequent pre-tokens and their lengths in
tokens, broadcast once. It is made of the tokenizer's own vocabulary, which is
the list of the most frequent byte strings of its training corpus and bounds
the table by its size; callers may hand in more pre-tokens. Tier two is a
cache in each worker for what the table lacks: the distinct misses of a batch
are encoded by the library once and kept, up to ``CACHE_SIZE`` entries.
Pre-tokens are never shuffled.

Cases: a null text counts as empty (no tokens); special strings inside a text
are special tokens, as is the library's default; texts with characters whose
class differs between Unicode versions go to the library whole; very long
texts are taken in pieces that split no pre-token. Repeated rows are counted
each on its own. An empty table gives an empty result. Extra columns are
ignored.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from glossaflow.llm.bpe import default_pattern, safe_chunks
from glossaflow.llm.common import WHITE, lean

CACHE_SIZE = 500_000
TOKEN_LIMIT = 1024

#: Blocks whose letters, digits and spaces are the same in every Unicode
#: version since 9; a test compares them with the library's.
STABLE = r"\x00-\u024f\u0391-\u03a1\u03a3-\u03ce\u0400-\u0481\u048a-\u0513\u05d0-\u05ea\u0621-\u064a\u0660-\u0669\u2010-\u2029\u20a0-\u20b9\u3000-\u3003\u3041-\u3096\u30a1-\u30fc\u4e00-\u9fcc\uac00-\ud7a3"
_UNSTABLE = re.compile(f"[^{STABLE}]")
_ODD = re.compile(f" (?:[{WHITE}]|$)")


def default_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@cache
def load_tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks are the parallelism
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def pretokenizer(pattern: str):
    import regex

    return regex.compile(pattern.replace(r"\s", f"[{WHITE}]").replace(r"[^[" + WHITE + "]", f"[^{WHITE}").replace(r"\S", f"[^{WHITE}]"))


def frequent_lengths(path: str, more: Iterable[str] = ()) -> dict[str, int]:
    """Tier one: each vocabulary entry that is one pre-token, with its length."""
    tokenizer = load_tokenizer(path)
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    vocabulary = [tokenizer.decoder.decode([w]) for w in tokenizer.get_vocab() if w not in special]
    words = [w for w in {*vocabulary, *more} if w and "\ufffd" not in w and not _UNSTABLE.search(w)]
    whole = re.compile("|".join(map(re.escape, special)) or r"(?!)")
    pieces = pretokenizer(default_pattern())
    words = [w for w in words if not whole.search(w) and pieces.findall(w) == [w]]
    return dict(zip(words, (len(e.ids) for e in tokenizer.encode_batch_fast(words, add_special_tokens=False)), strict=True))


class Counter:
    """Counts for one worker: the broadcast table under bounded caches.

    Besides pre-tokens, the cache holds what stands between two single spaces
    (most often a word with its punctuation), so that a text seen before in
    its words costs a split and look-ups only.
    """

    def __init__(self, path: str, pattern: str, table: dict[str, int]):
        self.tokenizer = load_tokenizer(path)
        self.pieces = pretokenizer(pattern)
        self.table, self.known, self.spaced = table, dict(table), {}
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None

    def _learn(self, lists: list[list[str]]) -> None:
        """Make every pre-token of ``lists`` known."""
        if len(self.known) > CACHE_SIZE + len(self.table):
            self.known = dict(self.table)
        if missing := list({w for words in lists for w in words}.difference(self.known)):
            self.known.update(zip(missing, (len(e.ids) for e in self.tokenizer.encode_batch_fast(missing, add_special_tokens=False)), strict=True))

    def count(self, text: str) -> int:
        if not text.isascii() and _UNSTABLE.search(text):
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        total, at = 0, 0
        for special in self.special.finditer(text) if self.special else ():
            total += 1 + self._plain(text[at : special.start()])
            at = special.end()
        return total + self._plain(text[at:] if at else text)

    def _plain(self, text: str) -> int:
        total = 0
        for chunk in safe_chunks(text, 1 << 20):
            if _ODD.search(chunk):
                first, rest = chunk, []
            else:
                # A space before something else always starts a pre-token.
                first, *rest = chunk.split(" ")
                total += self._spaced(rest)
            words = self.pieces.findall(first)
            self._learn([words])
            total += sum(map(self.known.__getitem__, words))
        return total

    def _spaced(self, words: list[str]) -> int:
        if missing := list(set(words).difference(self.spaced)):
            if len(self.spaced) + len(missing) > CACHE_SIZE:
                self.spaced = {}
                missing = list(set(words))
            lists = [self.pieces.findall(" " + w) for w in missing]
            self._learn(lists)
            known = self.known.__getitem__
            self.spaced.update((w, sum(map(known, pieces))) for w, pieces in zip(missing, lists, strict=True))
        return sum(map(self.spaced.__getitem__, words))


_LAST: dict[str, tuple] = {}


def _counter(path: str, pattern: str, name: str, table) -> Counter:
    """The worker's counter; one is kept, for the call that came last."""
    if _LAST.get("name") != name:
        _LAST.clear()
        _LAST.update(name=name, counter=Counter(path, pattern, table.value))
    return _LAST["counter"]


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, path: str | None = None, pattern: str | None = None, limit: int = TOKEN_LIMIT, frequent: Iterable[str] = ()) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every text; a pure map."""
    path, pattern = path or default_path(), pattern or default_pattern()
    table = docs.sparkSession.sparkContext.broadcast(frequent_lengths(path, frequent))
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path, pattern, name, table)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            tokens = [counter.count(t) for t in texts]
            sizes = [len(t.encode()) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens], pa.bool_())],
                [id_col, "n_bytes", "n_tokens", "over_limit"],
            )

    schema = T.StructType([docs.schema[id_col], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])
    return docs.select(id_col, text_col).mapInArrow(lean(run), schema)
