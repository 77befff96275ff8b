"""Lexicons, word frequencies and conservative spelling correction.

Correction looks at distinct unknown tokens only. A token meets a word where
they are equal without the letters that they may differ in; where these could
be left out in too many ways, they share a segment that none of them can have
touched. What meets is compared in batches. Only what changed is joined back,
and only to the texts that hold it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from itertools import combinations
from math import comb

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossaflow.functions import similarity as sim
from glossaflow.functions import text as tx
from glossaflow.shared import materialize

THRESHOLD = 0.85
LENGTH_GAP = 2
#: Shortest English and Arabic tokens that are looked up, by profile.
LEAST = {"english": 3, "arabic": 2}
#: Words below this length meet by keys; longer ones by length.
LONG = 64
#: Letters that are left out of a word to make its keys, and ways to do it.
MOST_LESS, MOST_WAYS = 3, 1200
#: Pieces that are left of a word.
PIECES = MOST_LESS + 1
#: Lexicons up to this many words are broadcast, corrections up to so many
#: bytes.
BROADCAST_WORDS, BROADCAST_BYTES = 500_000, 32 << 20
#: Bits of one row of a bitmap, for each key in it, and of all its rows at most.
ROW_BITS, KEY_BITS, MOST_BITS = 1 << 15, 64, 1 << 29


def _each(texts: DataFrame, keys: Sequence[str], tokens: Column, name: str) -> DataFrame:
    """Keys and each token. Of a plain explode Spark would make a filter that
    cuts all texts a second time."""
    return texts.select(*keys, F.explode_outer(tokens).alias(name)).where(F.col(name).isNotNull())


def word_frequencies(texts: DataFrame, text: str = "text", *, lower: bool = True, least: int = 1) -> DataFrame:
    """(word, freq) of all texts; counted before the shuffle."""
    body = F.lower(text) if lower else F.col(text)
    return _each(texts, [], tx.words(body), "word").where(F.length("word") >= least).groupBy("word").agg(F.count("*").alias("freq"))


def counted_words(texts: DataFrame, text: str = "text") -> DataFrame:
    """(raw, n): words as they are written, and how often; counted in each batch
    first. White space is the same here as in ``tx.words``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter[str] = Counter()
            for body in batch.column(0):
                counts.update((body.as_py() or "").split())
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["raw", "n"])

    return texts.select(text).mapInArrow(run, "raw string, n bigint").groupBy("raw").agg(F.sum("n").alias("n"))


@F.pandas_udf(T.ArrayType(T.StringType()))
def _distinct(text: pd.Series) -> pd.Series:
    """A text's words, each once."""
    return text.map(lambda body: list(dict.fromkeys(body.split())))


def lexicon_of(entries: DataFrame, english: str = "english", arabic: str = "arabic", least: int = 1, counted: DataFrame | None = None) -> DataFrame:
    """(lang, word, freq) of both sides of entries: words with a letter of the
    side's script, English in lower case, Arabic folded.

    Words are counted as they are written and then lowered or folded, which is
    done once for each distinct one and not for each that occurs. ``counted``
    are the :func:`counted_words` of both sides in one column, where they are
    known.
    """
    sides = (("english", english, F.lower, tx.has_latin), ("arabic", arabic, tx.normalize_arabic, tx.has_arabic))
    both = []
    for lang, column, fold, of_script in sides:
        if counted is None or arabic != english:
            counted = counted_words(entries, column)
            # Both sides in one column are counted once.
            counted = materialize(counted, "counted") if arabic == english else counted
        # Asked of the count too: else it would be moved to where each word occurs.
        wanted = F.when(F.col("n") > 0, of_script(F.col("word")) & (F.length("word") >= least))
        both.append(counted.select(F.lit(lang).alias("lang"), fold(F.col("raw")).alias("word"), "n").where(wanted))
    return both[0].unionByName(both[1]).groupBy("lang", "word").agg(F.sum("n").alias("freq"))


def union_lexicons(lexicons: Sequence[DataFrame]) -> DataFrame:
    """(lang, word, freq) with the frequencies added up."""
    rows = reduce(lambda a, b: a.unionByName(b), lexicons)
    return rows.groupBy("lang", "word").agg(F.sum("freq").alias("freq"))


def _small(lexicon: DataFrame, words: int | None) -> DataFrame:
    return F.broadcast(lexicon) if words is not None and words <= BROADCAST_WORDS else lexicon


def known(tokens: DataFrame, lexicon: DataFrame, token: str = "token", *, normalized: bool = False, words: int | None = None) -> DataFrame:
    """``tokens`` with ``known``; Arabic is compared in its folded form."""
    key = tx.normalize_arabic if normalized else F.lower
    held = lexicon.select(key(F.col("word")).alias("_key")).distinct().withColumn("known", F.lit(True))
    return tokens.withColumn("_key", key(F.col(token))).join(_small(held, words), "_key", "left").withColumn("known", F.coalesce("known", F.lit(False))).drop("_key")


def edits_between(a: int, b: int, threshold: float) -> int:
    """The most letters that words of lengths ``a`` and ``b`` can have outside
    the matching blocks at a ratio of ``threshold``; below 0 if they cannot
    reach it. Both sides' letters count, so it is odd or even as ``a + b``."""
    most = int((1 - threshold) * (a + b) + 1e-9)
    most -= (most - a - b) % 2
    return most if most >= abs(a - b) else -1


def _segments(length: int, edits: int) -> list[tuple[int, int]]:
    """(start, size) of ``edits`` + 1 segments of a word, as even as can be."""
    n = edits + 1
    cuts = [length * i // n for i in range(n + 1)]
    return [(x, y - x) for x, y in zip(cuts, cuts[1:], strict=False)]


def _less(a: int, b: int, edits: int) -> tuple[int, int]:
    """Letters of ``edits`` that are those of a word of length ``a``, and of ``b``."""
    return (edits + a - b) // 2, (edits - a + b) // 2


def _by_deletion(a: int, b: int, edits: int) -> bool:
    x, y = _less(a, b, edits)
    return max(x, y) <= MOST_LESS and max(comb(a, x), comb(b, y)) <= MOST_WAYS


def deletion_sizes(threshold: float, gap: int, longest: int = LONG) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """(size, less): how many letters are left out of tokens and of words.

    Matching blocks are a common subsequence, so a pair that reaches
    ``threshold`` is the same text when each side is without its share of the
    letters that lie outside. Unlike a segment of two or three letters, that
    text is met by hardly any word that is not near.
    """
    ours, theirs = set(), set()
    for a in range(1, longest):
        for b in range(max(1, a - gap), min(a + gap, longest - 1) + 1):
            if (edits := edits_between(a, b, threshold)) >= 0 and _by_deletion(a, b, edits):
                x, y = _less(a, b, edits)
                ours.add((a, x))
                theirs.add((b, y))
    return sorted(ours), sorted(theirs)


def _cuts(sizes: Sequence[tuple[int, int]]) -> list[tuple[int, ...]]:
    """(size, edits, other, part, start, length, ...): the pieces that stay, for
    each way to leave the letters out."""
    rows = []
    for size, less in sizes:
        for out in combinations(range(1, size + 1), less):
            ends = [0, *out, size + 1]
            pieces = [(x + 1, y - x - 1) for x, y in zip(ends, ends[1:], strict=False) if y - x > 1]
            rows.append((size, 0, 0, -1, *(n for piece in (pieces + [(1, 0)] * PIECES)[:PIECES] for n in piece)))
    return rows


def segment_plan(threshold: float, gap: int, longest: int = LONG, wanted: Callable[[int, int, int], bool] = lambda a, b, edits: True) -> tuple[list[tuple[int, ...]], list[tuple[int, ...]]]:
    """(size, other, edits, part, head, start, length) of tokens and of words
    below ``longest``, of the pairs of lengths that are ``wanted``: a key is the first ``head`` letters and ``length`` more
    from ``start`` on.

    Where each side has one letter too many at most, keys are what is left
    without it. Else, with so many edits, one of as many segments and one more of the word stands
    whole in the token, and one of these is moved by no more places than it has
    segments before it, nor, against the ends, than it has behind it.
    """
    ours, theirs = [], set()
    for a in range(1, longest):
        for b in range(max(1, a - gap), min(a + gap, longest - 1) + 1):
            if (edits := edits_between(a, b, threshold)) < 0 or not wanted(a, b, edits):
                continue
            if edits <= 2 and abs(a - b) < 2:
                whole = lambda n, less: [(i, i + 2, n) for i in range(n)] if less else [(0, 1, n)]
                ours += [(a, b, edits, -1, *cut) for cut in whole(a, edits + a - b > 0)]
                theirs.update((b, b, edits, -1, *cut) for cut in whole(b, edits - a + b > 0))
                continue
            for part, (start, size) in enumerate(_segments(b, edits)):
                theirs.add((b, b, edits, part, 0, start + 1, size))
                for moved in range(-part, part + 1):
                    if abs(moved - (a - b)) <= edits - part and 0 <= start + moved and start + moved + size <= a:
                        ours.append((a, b, edits, part, 0, start + moved + 1, size))
    return ours, sorted(theirs)


def _plans(threshold: float, gap: int) -> tuple[list[tuple[int, ...]], list[tuple[int, ...]]]:
    """Rows of :func:`_cuts` for the keys of tokens and of words, whichever way
    they are made."""
    both = []
    for sizes, segments in zip(deletion_sizes(threshold, gap), segment_plan(threshold, gap, wanted=lambda *pair: not _by_deletion(*pair)), strict=True):
        rest = [(size, edits, other, part, 1, head, start, length, *(1, 0) * (PIECES - 2)) for size, other, edits, part, head, start, length in segments]
        both.append(_cuts(sizes) + rest)
    return both[0], both[1]


def _keyed(words: DataFrame, word: str, plan: list[tuple[int, ...]]) -> DataFrame:
    """``words`` with ``key`` for each row of the plan and ``less``, the letters
    that are left out, or -1 where the key is a segment. The plan is a table of
    fixed size."""
    pieces = [(f"start{i}", f"length{i}") for i in range(PIECES)]
    steps = words.sparkSession.createDataFrame(plan, ", ".join(f"{c} int" for c in ("size", "edits", "other", "part", *(c for piece in pieces for c in piece))))
    cut = words.withColumn("size", F.length(word)).join(F.broadcast(steps), "size")
    kept = F.concat(*(F.substring(word, F.col(start), F.col(length)) for start, length in pieces))
    less = F.when(F.col("other") == 0, F.col("size") - sum(F.col(length) for _, length in pieces)).otherwise(-1)
    return cut.select(*words.columns, F.xxhash64("other", "edits", "part", kept).alias("key"), less.alias("less"))


def may_meet(rows: DataFrame, key: Column, keys: DataFrame, count: int) -> DataFrame:
    """``rows`` without most of those whose 64-bit ``key`` is not among
    ``keys`` (key), some ``count``: they need not be dealt out to be dropped.

    A bitmap of the keys is broadcast: some 64 bits a key, 64 MB at most.
    """
    rows_log = min(MOST_BITS // ROW_BITS, max(2, KEY_BITS * count // ROW_BITS)).bit_length() - 1
    row, place = lambda k: F.shiftrightunsigned(k, 64 - rows_log), lambda k: k.bitwiseAND(ROW_BITS - 1)
    rowed = keys.select(row(F.col("key")).alias("_row"), place(F.col("key")).alias("place")).groupBy("_row").agg(F.bitmap_construct_agg("place").alias("bits"))
    # As whole numbers of eight bytes, the first the highest.
    longs = F.transform(F.sequence(F.lit(0), F.lit(ROW_BITS // 64 - 1)), lambda i: F.conv(F.hex(F.substring("bits", i * 8 + 1, F.lit(8))), 16, -10).cast("bigint"))
    met = rows.withColumn("_row", row(key)).join(F.broadcast(rowed.select("_row", longs.alias("_bits"))), "_row")
    held, bit = F.get("_bits", F.shiftright(place(key), 6).cast("int")), key.bitwiseAND(63).bitwiseXOR(56).cast("int")
    return met.where(F.getbit(held, bit) == 1).select(*rows.columns)


def candidates(tokens: DataFrame, lexicon: DataFrame, threshold: float = THRESHOLD, gap: int = LENGTH_GAP) -> DataFrame:
    """(token, word, freq) pairs of like length whose bounds reach
    ``threshold``; both sides distinct.

    Words meet by key and are looked at where they meet: as many letters have to
    be left out as may lie outside of matching blocks, so that words that are
    nearer do not meet in more ways, nor others at all; of segments, by edits,
    which are no more than those letters. Words of ``LONG`` letters and more
    meet by length.
    """
    ours, theirs = _plans(threshold, gap)
    a, b = F.col("token"), F.col("word")
    left, right = _keyed(tokens.select("token"), "token", ours), _keyed(lexicon.select("word", "freq"), "word", theirs)
    # As many bytes as the words' keys take: the plan knows how many each has.
    keys = Counter(row[0] for row in theirs)
    sizes = [(r["size"], r["count"] * keys[r["size"]]) for r in lexicon.groupBy(F.least(F.length("word"), F.lit(LONG)).alias("size")).count().collect()]
    if sum(n * (2 * size + 80) for size, n in sizes) <= BROADCAST_BYTES:
        right = F.broadcast(right)
    else:
        # A token has many keys, and hardly any is one of a word.
        left, right = may_meet(left, F.col("key"), right.select("key"), sum(n for _, n in sizes)), right.hint("shuffle_hash")
    both = F.length(a) + F.length(b)
    edits = F.floor((1 - threshold) * both + 1e-9)
    # Odd or even as both lengths together, as in edits_between.
    near = F.when(F.col("less") < 0, F.levenshtein("token", "word") <= edits).otherwise(F.col("less") + F.col("other_less") == edits - F.pmod(edits - both, F.lit(2)))
    met = left.join(right.withColumnRenamed("less", "other_less"), "key")
    short = met.where((F.abs(F.length(a) - F.length(b)) <= gap) & (sim.length_bound(a, b) >= threshold) & near).select("token", "word", "freq")
    around = F.explode(F.sequence(F.length("token") - gap, F.length("token") + gap))
    long = tokens.where(F.length("token") >= LONG - gap).select("token", around.alias("size")).join(lexicon.where(F.length("word") >= LONG - gap).select("word", "freq", F.length("word").alias("size")), "size")
    long = long.where((F.length("token") >= LONG) | (F.length("word") >= LONG)).where((sim.length_bound(a, b) >= threshold) & (sim.letter_bound(a, b) >= threshold)).select("token", "word", "freq")
    return short.unionByName(long).groupBy("token", "word").agg(F.first("freq").alias("freq"))


def nearest_words(tokens: DataFrame, lexicon: DataFrame, threshold: float = THRESHOLD, gap: int = LENGTH_GAP) -> DataFrame:
    """(token, word, similarity): the best word of each token, if any reaches
    ``threshold``; ties go to the more frequent, then the smaller word."""
    scored = candidates(tokens, lexicon, threshold, gap).withColumn("similarity", sim.many_ratios(F.col("token"), F.col("word"))).where(F.col("similarity") >= threshold)
    best = Window.partitionBy("token").orderBy(F.desc("similarity"), F.desc("freq"), "word")
    return scored.withColumn("_place", F.row_number().over(best)).where("_place = 1").select("token", "word", "similarity")


def nearest_by_edits(tokens: DataFrame, lexicon: DataFrame, edits: int = 1) -> DataFrame:
    """(token, word, edits): a native alternative by edit distance, which is
    not the same measure. Words within ``edits`` share a string when so many
    letters are left out of each."""
    # Keys are hashed: what meets is measured anyway. A word has a key for each
    # of its letters, which no estimate knows of: neither side is broadcast.
    keys = lambda c: F.array_distinct(F.transform(sim.without(F.col(c), F.lit(edits), edits), lambda k: F.xxhash64(k)))
    ours, theirs = tokens.select("token", F.explode(keys("token")).alias("key")), lexicon.select("word", "freq", F.explode(keys("word")).alias("key"))
    met = ours.hint("merge").join(theirs, "key").where((F.abs(F.length("token") - F.length("word")) <= edits) & (F.levenshtein("token", "word", edits) >= 0)).groupBy("token", "word").agg(F.first("freq").alias("freq"))
    near = met.withColumn("edits", F.levenshtein("token", "word")).where(F.col("edits") <= edits)
    best = Window.partitionBy("token").orderBy("edits", F.desc("freq"), "word")
    return near.withColumn("_place", F.row_number().over(best)).where("_place = 1").select("token", "word", F.col("edits").cast("int").alias("edits"))


def corrections(tokens: DataFrame, lexicon: DataFrame, lang: str = "english", profile: str = "v3", threshold: float = THRESHOLD, words: int | None = None) -> DataFrame:
    """(token, corrected) of those distinct ``tokens`` that are corrected.

    Known and short tokens stay as they are. A correction is the lexicon's
    word, lower-cased (English) or folded (Arabic). ``v3`` measures an Arabic
    token's length folded, ``v4`` as written.
    """
    fold = tx.normalize_arabic if lang == "arabic" else F.lower
    folded = tokens.select("token", fold(F.col("token")).alias("folded"))
    held = materialize(lexicon.select(fold(F.col("word")).alias("word"), "freq").groupBy("word").agg(F.sum("freq").alias("freq")), "lexicon")
    size = F.length("token") if lang == "english" or profile == "v4" else F.length("folded")
    open_ = materialize(folded.where(size >= LEAST[lang]).join(_small(held.select(F.col("word").alias("folded")), words), "folded", "left_anti"), "unknown")
    best = nearest_words(open_.select(F.col("folded").alias("token")).distinct(), held, threshold)
    return open_.join(best.select(F.col("token").alias("folded"), "word"), "folded").select("token", F.col("word").alias("corrected"))


def correct_tokens(tokens: DataFrame, lexicon: DataFrame, lang: str = "english", profile: str = "v3", threshold: float = THRESHOLD, words: int | None = None) -> DataFrame:
    """``tokens`` with ``corrected``: as :func:`corrections` has it, or as it is."""
    fixes = corrections(tokens.select("token").distinct(), lexicon, lang, profile, threshold, words)
    return tokens.join(fixes, "token", "left").withColumn("corrected", F.coalesce("corrected", "token"))


@F.pandas_udf(T.StringType())
def _put(text: pd.Series, tokens: pd.Series, words: pd.Series) -> pd.Series:
    """Tokens between single blanks, those of a row's own list changed. A
    row's changes may be thousands: Spark's maps are searched one by one. What
    parts tokens is the same white space here as in ``tx.words``."""

    def put(body: str, old, new) -> str:
        to = {} if old is None else dict(zip(old, new, strict=True))
        return " ".join(to.get(t, t) for t in body.split())

    return pd.Series([put(*row) for row in zip(text, tokens, words, strict=True)], dtype=object)


def correct_text(texts: DataFrame, lexicon: DataFrame, keys: Sequence[str], text: str = "text", lang: str | None = "english", profile: str = "v3", threshold: float = THRESHOLD, words: int | None = None, tokens: DataFrame | None = None) -> DataFrame:
    """``texts`` with ``text`` corrected token by token.

    ``lexicon`` is (lang, word, freq). ``lang`` None takes each token by its
    own script (as ``v4`` does). ``keys`` name a row. What changes is a small
    table; a row's own changes are put in where the row is. ``tokens`` (token)
    are the distinct ones of all texts, where they are known.
    """
    body = F.coalesce(text, F.lit(""))
    each = _each(texts, keys, _distinct(body), "token")
    distinct = materialize(each.select("token").distinct(), "tokens") if tokens is None else tokens
    script = F.when(tx.has_arabic(F.col("token")), "arabic").when(tx.has_latin(F.col("token")), "english")
    fixed = None
    for one in ("english", "arabic") if lang is None else (lang,):
        found = distinct if lang else distinct.where(script == one)
        done = corrections(found, lexicon.where(F.col("lang") == one).select("word", "freq"), one, profile, threshold, words)
        fixed = done if fixed is None else fixed.unionByName(done)
    fixed = materialize(fixed.where("token <> corrected"), "corrections")
    size, count = fixed.agg(F.coalesce(F.sum(F.length("token") * 2 + F.length("corrected") * 2 + 64), F.lit(0)), F.count("*")).first()
    if size <= BROADCAST_BYTES:
        side = F.broadcast(fixed)
    else:
        each, side = may_meet(each, F.xxhash64("token"), fixed.select(F.xxhash64("token").alias("key")), count), fixed.hint("shuffle_hash")
    mine = each.join(side, "token").groupBy(*keys).agg(F.collect_list(F.struct("token", "corrected")).alias("_fixes"))
    return texts.join(mine.hint("shuffle_hash"), list(keys), "left").withColumn(text, _put(body, F.col("_fixes.token"), F.col("_fixes.corrected"))).drop("_fixes")


def overlap(output: DataFrame, gold: DataFrame, term: str = "term", definition: str = "definition") -> DataFrame:
    """One row: gold rows, output rows, gold rows whose term occurs in the
    output, gold rows whose pair does, and both as shares of the gold."""
    lowered = lambda df: df.select(F.lower(term).alias("t"), F.col(definition).alias("d"))
    ours, theirs = lowered(output), lowered(gold)
    terms = ours.select("t").distinct().withColumn("shared", F.lit(1))
    pairs = ours.distinct().withColumn("exact", F.lit(1))
    marked = theirs.join(terms, "t", "left").join(pairs, ["t", "d"], "left")
    counted = marked.agg(F.count("*").alias("gold_rows"), F.count("shared").alias("shared_terms"), F.count("exact").alias("exact_pairs"))
    total = ours.agg(F.count("*").alias("output_rows"))
    share = lambda c: F.coalesce(F.try_divide(F.col(c), F.col("gold_rows")), F.lit(0.0))
    both = counted.withColumn("_one", F.lit(1)).join(total.withColumn("_one", F.lit(1)), "_one")
    return both.select("gold_rows", "output_rows", "shared_terms", "exact_pairs", share("shared_terms").alias("shared_share"), share("exact_pairs").alias("exact_share"))
