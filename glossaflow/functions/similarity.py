"""Ratcliff-Obershelp similarity as column expressions, and bounds above it.

The bounds are cheap, never below the ratio, and leave it few pairs to look at.
All is native but :func:`many_ratios`, which looks at a batch of pairs at once.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _longest(a: Column, b: Column) -> Column:
    """(n, -i): the longest common substring, the first in ``a`` of these; null
    if there is none."""
    starts = F.sequence(F.lit(1), F.length(a))
    ends = lambda i: F.sequence(F.lit(1), F.length(a) - i + 1)
    held = lambda i, n: F.when(F.instr(b, F.substring(a, i, n)) > 0, F.struct(n.alias("n"), (-i).alias("i")))
    return F.array_max(F.flatten(F.transform(starts, lambda i: F.transform(ends(i), lambda n: held(i, n)))))


def matched(a: Column, b: Column) -> Column:
    """Letters in matching blocks: the longest common substring, and the same
    to both sides of it. Open pieces are kept in a list; each step takes one,
    so two steps for each letter of the shorter text are enough. Meant for
    words: a step looks at all substrings of its piece."""
    piece = lambda x, y: F.struct(x.alias("a"), y.alias("b"))
    start = F.struct(F.filter(F.array(piece(a, b)), lambda p: (p["a"] != "") & (p["b"] != "")).alias("open"), F.lit(0).alias("n"))

    def cut(x: Column, y: Column, m: Column) -> Column:
        i, n = -m["i"], m["n"]
        j = F.instr(y, F.substring(x, i, n))
        rest = F.array(piece(F.substring(x, F.lit(1), i - 1), F.substring(y, F.lit(1), j - 1)), piece(F.substring(x, i + n, F.length(x)), F.substring(y, j + n, F.length(y))))
        return F.filter(rest, lambda p: (p["a"] != "") & (p["b"] != ""))

    def step(s: Column, _: Column) -> Column:
        # A list of one is how an expression is named within another.
        found = F.transform(F.slice(s["open"], 1, 1), lambda p: F.struct(p.alias("p"), _longest(p["a"], p["b"]).alias("m")))
        hits = F.filter(found, lambda f: f["m"].isNotNull())
        more = F.flatten(F.transform(hits, lambda f: cut(f["p"]["a"], f["p"]["b"], f["m"])))
        n = F.aggregate(hits, F.lit(0), lambda t, f: t + f["m"]["n"])
        rest = F.filter(s["open"], lambda _, k: k > 0)
        return F.when(F.size(s["open"]) == 0, s).otherwise(F.struct(F.concat(rest, more).alias("open"), (s["n"] + n).alias("n")))

    steps = F.sequence(F.lit(0), F.least(F.length(a), F.length(b)) * 2)
    return F.aggregate(steps, start, step, lambda s: s["n"])


def ratio(a: Column, b: Column) -> Column:
    """Similarity of ``a`` to ``b``; the order of the arguments matters."""
    return F.coalesce(2.0 * matched(a, b) / F.nullif(F.length(a) + F.length(b), F.lit(0)), F.lit(1.0))


#: Cells of the tables that a batch of pairs is worked out in: they should stay
#: in a core's cache.
CELLS = 1 << 16


def _codes(texts: np.ndarray, width: int) -> np.ndarray:
    """A column of code points for each text, padded with 0."""
    return np.ascontiguousarray(texts.astype(f"<U{width}").view(np.uint32).reshape(len(texts), width).T)


def _blocks(x: np.ndarray, y: np.ndarray, nx: np.ndarray, ny: np.ndarray) -> np.ndarray:
    """Letters in matching blocks of pairs of columns, as :func:`matched` has
    them.

    Pieces of all pairs are looked at together; those to both sides of what is
    found are the next step's.
    """
    total, pair = np.zeros(len(nx), np.int64), np.arange(len(nx))
    a0, a1, b0, b1 = np.zeros_like(nx), nx, np.zeros_like(ny), ny
    kind = np.int16 if len(y) < 1 << 15 else np.int32
    while len(pair):
        low, high = b0.min(), b1.max()
        a, b = x[:, pair], y[low:high, pair]
        at = np.arange(low, high)[:, None]
        inside = ((at >= b0) & (at < b1)).astype(kind)
        n, end_a, end_b = np.zeros(len(pair), kind), np.zeros(len(pair), np.int64), np.zeros(len(pair), np.int64)
        # Cell j + 1: the common run that ends at i and low + j.
        run = np.zeros((high - low + 1, len(pair)), kind)
        for i in range(a0.min(), a1.max()):
            same = (b == a[i]) & ((a0 <= i) & (i < a1))
            run[1:] = (run[:-1] + 1) * (same * inside)
            most = run.max(0)
            longer = np.flatnonzero(most > n)
            if len(longer):
                n[longer], end_a[longer], end_b[longer] = most[longer], i + 1, low + run[:, longer].argmax(0)
        np.add.at(total, pair, n)
        pieces = ((a0, end_a - n, b0, end_b - n), (end_a, a1, end_b, b1))
        keep = [(n > 0) & (p[0] < p[1]) & (p[2] < p[3]) for p in pieces]
        a0, a1, b0, b1 = (np.concatenate([p[k][m] for p, m in zip(pieces, keep, strict=True)]) for k in range(4))
        pair = np.concatenate([pair[m] for m in keep])
    return total


def ratios(a: pd.Series, b: pd.Series) -> pd.Series:
    """:func:`guarded_ratio` of many pairs; texts of like length together."""
    x, y = a.to_numpy(dtype=object), b.to_numpy(dtype=object)
    nx, ny = (np.fromiter(map(len, t), np.int64, len(t)) for t in (x, y))
    out = np.zeros(len(x))
    size = np.maximum(nx, ny)
    order = np.argsort(size, kind="stable")
    order = order[(nx > 0)[order] & (ny > 0)[order]]
    while len(order):
        # Texts up to an eighth longer than the shortest that is left.
        width = int(size[order[0]]) * 9 // 8 + 1
        here = order[: min(int(np.searchsorted(size[order], width, "right")), max(1, CELLS // width))]
        order = order[len(here) :]
        met = _blocks(_codes(x[here], width), _codes(y[here], width), nx[here], ny[here])
        out[here] = 2.0 * met / (nx[here] + ny[here])
    return pd.Series(out)


def many_ratios(a: Column, b: Column) -> Column:
    """:func:`guarded_ratio` of columns without nulls, in batches. A filter
    on it is not moved to where it would be worked out once more."""
    return F.pandas_udf(ratios, "double").asNondeterministic()(a, b)


def guarded_ratio(a: Column, b: Column) -> Column:
    """0 where a side is empty, 1 where both are equal."""
    return F.when((a == "") | (b == ""), 0.0).when(a == b, 1.0).otherwise(ratio(a, b))


def length_bound(a: Column, b: Column) -> Column:
    return 2.0 * F.least(F.length(a), F.length(b)) / (F.length(a) + F.length(b))


def letter_bound(a: Column, b: Column) -> Column:
    """Twice the letters in common, in any order, over all letters."""
    letters = F.array_distinct(F.split(a, ""))
    times = lambda text, c: F.length(text) - F.length(F.replace(text, c, F.lit("")))
    common = F.aggregate(letters, F.lit(0), lambda s, c: s + F.when(c == "", 0).otherwise(F.least(times(a, c), times(b, c))))
    return 2.0 * common / (F.length(a) + F.length(b))


def unmatched(length: int, threshold: float, gap: int) -> int:
    """The most letters that a word of ``length`` can have outside the matching
    blocks with a word at most ``gap`` longer or shorter, if their ratio is
    ``threshold`` or more."""
    most = 0
    for g in range(-min(gap, length - 1), gap + 1):
        both = int((1 - threshold) * (2 * length + g) + 1e-9)
        if both >= abs(g):
            most = max(most, (both - g) // 2)
    return most


def without(word: Column, letters: Column, most: int) -> Column:
    """``word`` with up to ``letters`` (``most`` at most) of its letters left
    out, in all ways. Matching blocks are in one order in both words, so two
    words share what is left when the unmatched letters of each are out."""
    less = lambda w: F.transform(F.sequence(F.lit(1), F.length(w)), lambda i: F.concat(F.substring(w, F.lit(1), i - 1), F.substring(w, i + 1, F.length(w))))
    none = F.array().cast("array<string>")
    levels = [F.array(word)]
    for k in range(1, most + 1):
        fewer = F.array_distinct(F.flatten(F.transform(F.filter(levels[-1], lambda w: w != ""), less)))
        levels.append(F.when(letters >= k, fewer).otherwise(none))
    return F.concat(*levels)
