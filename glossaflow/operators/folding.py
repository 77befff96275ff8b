"""Entries of packed pages, many pages at a time.

Spark deals out the pages and judges the texts that come of this; here boxes
are only put in order, cut into rows and rows into entries, with arrays over
all pages of a batch. No loop goes over boxes or pages.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from glossaflow.functions import text as tx

#: Boxes that are worked on at once; a page is never cut.
BOXES = 1 << 18
#: What an entry is before its texts are tidied.
ENTRY = {"col": pa.int32(), "entry": pa.int32(), "number": pa.string(), "english": pa.string(), "arabic": pa.string(), "y": pa.float64()}
_DDL = "array<struct<col:int,entry:int,number:string,english:string,arabic:string,y:double>>"


def _pattern(java: str) -> str:
    """Escapes of characters as the Arrow library writes them."""
    return java.encode("ascii").decode("unicode_escape") if "\\u" in java else java


_ARABIC = _pattern(tx.ARABIC)
#: All decimal digits; those that have a value here.
_DIGITS, _VALUED = r"\A\p{{Nd}}{{1,{0}}}\z", rf"\A[{tx.WESTERN_DIGITS[:10]}{tx.EASTERN_DIGITS}]*\z"


def _flat(values: pa.Array) -> np.ndarray:
    """Numbers as doubles, missing ones as NaN."""
    return pc.cast(values, pa.float64()).to_numpy(zero_copy_only=False)


def _low(values: np.ndarray) -> np.ndarray:
    """For sorting: missing values stand first."""
    return np.where(np.isnan(values), -np.inf, values)


def _joined(texts: pa.Array, at: np.ndarray, group: np.ndarray, groups: int) -> pa.Array:
    """The texts at ``at``, in this order, joined for each of their groups
    (ascending); none is empty."""
    offsets = np.searchsorted(group, np.arange(groups + 1)).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), texts.take(pa.array(at))), " ")


def _firsts(group: np.ndarray) -> np.ndarray:
    """Where a new group of neighbours begins."""
    return np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.zeros(0, np.int64)


def _row_starts(group: np.ndarray, y: np.ndarray, tol: int) -> np.ndarray:
    """Which boxes, by group and y, open a row: those more than ``tol`` below
    their row's first box. All groups take one step at a time."""
    key = np.empty(len(y), complex)
    key.real, key.imag = group, _low(y)
    reach = key.copy()
    reach.imag += tol
    first = _firsts(group)
    ends = np.r_[first[1:], len(y)]
    # The next row; after a row of no height there is none.
    following = np.where(np.isnan(y), len(y), np.searchsorted(key, reach, side="right"))
    opens = np.zeros(len(y), bool)
    while len(first):
        opens[first] = True
        first = following[first]
        inside = first < ends
        first, ends = first[inside], ends[inside]
    return opens


def _kinds(text: pa.Array, profile: str) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """Latin and Arabic parts of texts, null where there is none, and numbers."""
    yes = lambda pattern: pc.match_substring_regex(text, pattern).to_numpy(zero_copy_only=False).astype(bool)
    digit, latin, letters = yes(_DIGITS.format(tx.NUMBER_DIGITS[profile])), yes(tx.LATIN), yes(_ARABIC)
    parts = []
    for own, other, kept, least in ((latin, letters, "A-Za-z", 2), (letters, latin, _ARABIC[1:-1], 1)):
        part = pc.if_else(pa.array(own & ~digit), text, pa.scalar(None, text.type))
        mixed = own & other & ~digit
        if mixed.any():
            cut = pc.replace_substring_regex(text.filter(pa.array(mixed)), rf"[^{kept} .;,\-]", "")
            part = pc.replace_with_mask(part, pa.array(mixed), pc.utf8_trim(cut, tx.SPACES))
        parts.append(pc.if_else(pc.less(pc.utf8_length(part), least), pa.scalar(None, text.type), part))
    return parts[0], parts[1], digit


def _entries(page: np.ndarray, pages: int, text: pa.Array, col: np.ndarray, x: np.ndarray, y: np.ndarray, pos: np.ndarray, profile: str, tol: int, arabic_first: bool, numbered: bool) -> pa.Array:
    """Entries of each of ``pages`` pages, from boxes of ascending page."""
    order = np.lexsort((pos, _low(y), col, page))
    group = page[order] * 2 + col[order]
    row = np.cumsum(_row_starts(group, y[order], tol)) - 1
    # Within rows by x, then by y and place.
    seat = np.lexsort((pos[order], _low(y)[order], _low(x)[order], row))
    order = order[seat]
    text, x, y, pos = text.take(pa.array(order)), x[order], y[order], pos[order]
    head = _firsts(row)
    rows = len(head)
    latin, letters, digit = _kinds(text, profile)
    has = [part.is_valid().to_numpy(zero_copy_only=False) for part in (latin, letters)]
    box = np.arange(len(row))

    def first(mask: np.ndarray) -> np.ndarray:
        """Each row's first box of a kind, or -1."""
        out = np.full(rows, -1)
        at = box[mask]
        lead = _firsts(row[at])
        out[row[at][lead]] = at[lead]
        return out

    one, two, number = first(has[0]), first(has[1]), first(digit)
    valued = pc.match_substring_regex(text, _VALUED).to_numpy(zero_copy_only=False).astype(bool)
    number = np.where((number >= 0) & valued[number], number, -1) if rows else number
    e, a, n = one >= 0, two >= 0, number >= 0
    at_x = lambda i: np.where(i >= 0, x[i], np.nan) if rows else np.zeros(0)
    if profile == "v4":
        start = e | a
    elif not numbered:
        start = at_x(two) < at_x(one) if arabic_first else at_x(one) < at_x(two)
    elif arabic_first:
        start = n & a
    else:
        start = n & (e if profile == "v2" else e | a)
    # Rows without words start nothing and add nothing. Those of the next column
    # that stand before its first entry are none's.
    column = group[head]
    entry = np.cumsum(start) - 1
    heads = np.flatnonzero(start)
    owned = (entry >= 0) & (column[heads[np.maximum(entry, 0)]] == column) if len(heads) else np.zeros(rows, bool)
    more = start if profile == "v2" else start | ((arabic_first or not numbered) | ~a)
    in_latin = has[0] & (owned & more)[row]
    in_letters = has[1] & owned[row]

    left = box[in_latin]
    right = box[in_letters]
    if profile == "v4":
        back = (-pc.rank(letters.filter(pa.array(in_letters)), "ascending", tiebreaker="dense").to_numpy().astype(np.int64),)
    else:
        # From the right; a missing place still stands first.
        back = (pos[right], _low(y[right]), _low(-x[right]))
    right = right[np.lexsort((*back, row[right]))]
    place = np.arange(len(heads)) - np.searchsorted(column[heads], column[heads]) + 1
    if profile == "v4":
        numbers = pa.nulls(len(heads), pa.string())
    else:
        numbers = text.take(pa.array(number[heads], mask=number[heads] < 0)) if numbered else pc.cast(pa.array(place), pa.string())
    # A row's height is that of its first box.
    height = y[head][heads]
    fields = [
        pa.array(column[heads] % 2, pa.int32()),
        pa.array(heads - np.searchsorted(column, column[heads]) if profile == "v4" else place, pa.int32()),
        numbers,
        _joined(latin, left, entry[row[left]], len(heads)),
        _joined(letters, right, entry[row[right]], len(heads)),
        pa.array(height, mask=np.isnan(height)),
    ]
    offsets = np.searchsorted(column[heads] // 2, np.arange(pages + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(fields, list(ENTRY)))


def page_entries(boxes: str, conf: Column, ratio: Column, *, profile: str, least: int, tol: int, arabic_first: bool, numbered: bool) -> Column:
    """An array of ENTRY of each packed page, texts and numbers as they were read. Boxes without text or with less
    confidence than ``least`` take no part; columns part at ``ratio``."""

    @F.arrow_udf(_DDL)
    def found(text: pa.Array, conf: pa.Array, x: pa.Array, y: pa.Array, w: pa.Array, width: pa.Array, pos: pa.Array, ratio: pa.Array) -> pa.Array:
        sizes = pc.fill_null(pc.list_value_length(text), 0).to_numpy(zero_copy_only=False)
        part = np.r_[0, np.cumsum(sizes)][:-1] // BOXES
        done = []
        for lo, hi in zip(edges := _firsts(part), np.r_[edges[1:], len(sizes)]):
            cut = lambda v: v.slice(lo, hi - lo).flatten()  # noqa: B023, E731
            page = np.repeat(np.arange(hi - lo), sizes[lo:hi])
            texts = pc.utf8_trim(cut(text), tx.SPACES)
            kept = pc.and_(pc.not_equal(texts, ""), pc.greater_equal(pc.fill_null(cut(conf), -1), least))
            kept = pc.fill_null(kept, False).to_numpy(zero_copy_only=False)
            at_x, at_y, wide, page_wide, seat = (_flat(cut(v))[kept] for v in (x, y, w, width, pos))
            share = _flat(ratio.slice(lo, hi - lo))[page[kept]]
            # A place that is not known is not left of anything.
            col = 1 - ((page_wide <= 0) | (at_x + np.floor(wide / 2) < np.floor(page_wide * share)))
            done.append(_entries(page[kept], hi - lo, texts.filter(pa.array(kept)), col, at_x, at_y, _low(seat), profile, tol, arabic_first, numbered))
        return pa.concat_arrays(done) if done else pa.array([], pa.list_(pa.struct(ENTRY)))

    field = lambda name: F.col(f"{boxes}.{name}")
    return found(field("text"), conf, field("x"), field("y"), field("w"), field("width"), field("pos"), ratio)
