"""Page rasters: thresholds, ink and enhancement, as strips of rows.

Rendering stays outside. The input is one row for each line of a page's grey
raster: keys, ``y`` from 0 and ``pixels``, a byte for each pixel. Pages may be
of any size: histograms and ink are aggregated over all rows, and local filters
run over strips that overlap by what the filters reach, so no task holds a page.

Lines without pixels are left out. Of lines of one place the one with the
largest bytes counts. The lines of a page are of one length; a strip that has
two raises an error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

PAGE = ("pdf", "page")
#: Lines of a strip, without what it shares with its neighbours.
STRIP = 256
# Window and offset of the local threshold, size of the median,
# tiles and clip limit of the contrast.
BLOCK, OFFSET, MEDIAN, TILES, CLIP = 31, 15, 3, 8, 3.0
METHODS = ("none", "simple", "auto", "enhanced")

Lines = Iterator[tuple[tuple, dict[str, Any]]]


def _mapped(rows: DataFrame, keys: Sequence[str], extra: Sequence[str], run: Callable[[Lines], Iterator[tuple]], out: str) -> DataFrame:
    """``run`` over each batch's (key, other columns); it gives (key, *values)."""
    found = T.StructType([*(rows.schema[k] for k in keys), *T._parse_datatype_string(out).fields])
    arrow = rows.sparkSession.createDataFrame([], found).toArrow().schema

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = ((tuple(row[k] for k in keys), row) for row in batch.to_pylist())
            made = [(*key, *rest) for key, *rest in run(lines)]
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made, strict=True), arrow, strict=True)], schema=arrow)

    return rows.select(*keys, *extra).mapInArrow(each, found)


def _grey(pixels: bytes) -> np.ndarray:
    return np.frombuffer(pixels, np.uint8)


def single_lines(rows: DataFrame, keys: Sequence[str] = PAGE) -> DataFrame:
    """(keys, y, pixels) with one line for each place."""
    return rows.where(F.octet_length("pixels") > 0).groupBy(*keys, "y").agg(F.max("pixels").alias("pixels"))


def histogram(rows: DataFrame, keys: Sequence[str] = PAGE) -> DataFrame:
    """(keys, value, n): pixels of each value; counted in each batch first."""

    def run(lines: Lines) -> Iterator[tuple]:
        counts: dict[tuple, np.ndarray] = {}
        for key, row in lines:
            counts[key] = counts.get(key, 0) + np.bincount(_grey(row["pixels"]), minlength=256)
        for key, held in counts.items():
            yield from ((key, v, int(held[v])) for v in map(int, np.flatnonzero(held)))

    return _mapped(rows, keys, ["pixels"], run, "value int, n bigint").groupBy(*keys, "value").agg(F.sum("n").alias("n"))


def otsu(counts: DataFrame, keys: Sequence[str] = PAGE) -> DataFrame:
    """(keys, threshold): the value that parts a histogram's two sides most,
    the smallest of equal ones; 0 where there is one value only.

    A window holds one page's values, 256 at most.
    """
    upto, whole = Window.partitionBy(*keys).orderBy("value"), Window.partitionBy(*keys)
    mass = F.col("value") * F.col("n")
    sums = counts.select(*keys, "value", *(F.sum(c).over(w).alias(f"{name}{i}") for i, w in enumerate((upto, whole)) for name, c in (("n", F.col("n")), ("s", mass))))
    above = F.col("n1") - F.col("n0")
    apart = ((F.col("s0") / F.col("n0") - (F.col("s1") - F.col("s0")) / above) ** 2) * (F.col("n0").cast("double") * above)
    best = F.max_by("value", F.when(above > 0, F.struct(apart, -F.col("value"))))
    return sums.groupBy(*keys).agg(F.coalesce(best, F.lit(0)).alias("threshold"))


def ink(rows: DataFrame, thresholds: DataFrame, keys: Sequence[str] = PAGE) -> DataFrame:
    """(keys, x, ink, width): dark pixels of each vertical, as
    :func:`glossaflow.operators.layout.column_profile` takes them."""

    def run(lines: Lines) -> Iterator[tuple]:
        dark: dict[tuple, np.ndarray] = {}
        for key, row in lines:
            here = (_grey(row["pixels"]) <= row["threshold"]).astype(np.int64)
            held = dark.setdefault(key, np.zeros(0, np.int64))
            wide = np.zeros(max(len(here), len(held)), np.int64)
            wide[: len(held)] += held
            wide[: len(here)] += here
            dark[key] = wide
        for key, sums in dark.items():
            yield from ((key, x, int(n)) for x, n in enumerate(sums))

    met = rows.join(thresholds, list(keys))
    sums = _mapped(met, keys, ["pixels", "threshold"], run, "x int, ink bigint").groupBy(*keys, "x").agg(F.sum("ink").alias("ink"))
    return sums.withColumn("width", F.count("*").over(Window.partitionBy(*keys)).cast("int"))


def strips(rows: DataFrame, keys: Sequence[str] = PAGE, height: int = STRIP, halo: int = 0) -> DataFrame:
    """(keys, strip, lines): runs of ``height`` lines with ``halo`` more on both
    sides, where the page has them; ``lines`` are (y, pixels) by y."""
    near = F.sequence(F.floor(F.greatest(F.col("y") - halo, F.lit(0)) / height), F.floor((F.col("y") + halo) / height))
    spread = rows.select(*keys, F.explode(near).alias("strip"), F.struct("y", "pixels").alias("line"))
    found = spread.groupBy(*keys, "strip").agg(F.sort_array(F.collect_list("line")).alias("lines"))
    # Past a page's last line there are strips of nothing but a halo.
    return found.where(F.exists("lines", lambda r: F.floor(r["y"] / height) == F.col("strip")))


def _around(grey: np.ndarray, reach: int) -> np.ndarray:
    return np.pad(grey, reach, mode="edge")


def local_threshold(grey: np.ndarray, block: int = BLOCK, offset: int = OFFSET) -> np.ndarray:
    """255 where a pixel is above the Gaussian mean about it less ``offset``,
    else 0; the mean is rounded to whole values, edges are repeated."""
    reach = block // 2
    sigma = 0.3 * ((block - 1) * 0.5 - 1) + 0.8
    weights = np.exp(-((np.arange(block) - reach) ** 2) / (2 * sigma * sigma))
    weights /= weights.sum()
    wide = _around(grey, reach).astype(np.float64)
    down = sum(w * wide[i : i + grey.shape[0]] for i, w in enumerate(weights))
    mean = sum(w * down[:, i : i + grey.shape[1]] for i, w in enumerate(weights))
    return np.where(grey.astype(np.int64) - np.rint(mean).astype(np.int64) > -offset, 255, 0).astype(np.uint8)


def median(grey: np.ndarray, size: int = MEDIAN) -> np.ndarray:
    wide = _around(grey, size // 2)
    views = [wide[i : i + grey.shape[0], j : j + grey.shape[1]] for i in range(size) for j in range(size)]
    return np.median(np.stack(views), axis=0).astype(np.uint8)


def _padded(size: int, other: int) -> int:
    """A side as the tiles want it: both sides grow if either has a rest."""
    return size if size % TILES == 0 and other % TILES == 0 else size + TILES - size % TILES


def contrast_tables(rows: DataFrame, keys: Sequence[str] = PAGE, clip: float = CLIP) -> DataFrame:
    """(keys, height, width, tables): for each of a page's 8 x 8 tiles the 256
    values that its own become, from its clipped histogram; in one binary.

    A page whose sides have a rest grows by its mirrored edge. Pages of under
    eight lines or columns more than the edge adds are not defined.
    """
    sizes = rows.groupBy(*keys).agg((F.max("y") + 1).cast("int").alias("height"), F.max(F.octet_length("pixels")).alias("width"))

    def run(lines: Lines) -> Iterator[tuple]:
        counts: dict[tuple, np.ndarray] = {}
        for key, row in lines:
            high, wide = _padded(row["height"], row["width"]), _padded(row["width"], row["height"])
            line = np.pad(_grey(row["pixels"]), (0, wide - row["width"]), mode="reflect").astype(np.int64)
            coded = np.arange(wide) // (wide // TILES) * 256 + line
            mirrored = 2 * (row["height"] - 1) - row["y"]
            for y in (row["y"], mirrored) if row["height"] <= mirrored < high else (row["y"],):
                place = (key, y // (high // TILES))
                counts[place] = counts.get(place, 0) + np.bincount(coded, minlength=TILES * 256)
        for (key, tile), held in counts.items():
            yield from ((key, tile * TILES + int(at) // 256, int(at) % 256, int(held[at])) for at in np.flatnonzero(held))

    counted = _mapped(rows.join(sizes, list(keys)), keys, ["y", "pixels", "height", "width"], run, "tile int, value int, n bigint")
    tiles = counted.groupBy(*keys, "tile", "value").agg(F.sum("n").alias("n")).groupBy(*keys).agg(F.collect_list(F.struct("tile", "value", "n")).alias("counts"))

    def tables(lines: Lines) -> Iterator[tuple]:
        for key, row in lines:
            held = np.zeros((TILES * TILES, 256), np.int64)
            for c in row["counts"]:
                held[c["tile"], c["value"]] = c["n"]
            area = int(held[0].sum())
            most = max(int(clip * area / 256), 1)
            over = np.maximum(held - most, 0).sum(axis=1)
            held = np.minimum(held, most) + (over // 256)[:, None]
            for tile, rest in enumerate(over % 256):
                if rest:
                    held[tile, np.arange(rest) * max(256 // int(rest), 1)] += 1
            yield key, row["height"], row["width"], np.clip(np.rint(held.cumsum(axis=1) * (255 / area)), 0, 255).astype(np.uint8).tobytes()

    return _mapped(tiles.join(sizes, list(keys)), keys, ["height", "width", "counts"], tables, "height int, width int, tables binary")


def equalised(grey: np.ndarray, first: int, height: int, width: int, tables: bytes) -> np.ndarray:
    """Lines of a page from ``first`` on with the tiles' tables put between the
    tiles' middles."""
    held = _grey(tables).reshape(TILES, TILES, 256).astype(np.float64)

    def between(places: np.ndarray, side: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = places / (side // TILES) - 0.5
        low = np.floor(at).astype(np.int64)
        return np.maximum(low, 0), np.minimum(low + 1, TILES - 1), at - low

    top, bottom, down = (v[:, None] for v in between(np.arange(first, first + grey.shape[0]), _padded(height, width)))
    left, right, along = (v[None, :] for v in between(np.arange(grey.shape[1]), _padded(width, height)))
    upper = held[top, left, grey] * (1 - along) + held[top, right, grey] * along
    lower = held[bottom, left, grey] * (1 - along) + held[bottom, right, grey] * along
    return np.clip(np.rint(upper * (1 - down) + lower * down), 0, 255).astype(np.uint8)


def preprocess(rows: DataFrame, method: str = "auto", keys: Sequence[str] = PAGE, height: int = STRIP) -> DataFrame:
    """(keys, y, pixels) as recognition wants them: unchanged (``none``), black
    and white by one threshold a page (``simple``) or a local one and a median
    (``auto``), the latter after local contrast (``enhanced``)."""
    if method not in METHODS:
        raise ValueError(f"method is one of {', '.join(METHODS)}")
    lines = single_lines(rows, keys)
    if method == "none":
        return lines
    if method == "simple":

        def cut(found: Lines) -> Iterator[tuple]:
            for key, row in found:
                yield key, row["y"], np.where(_grey(row["pixels"]) > row["threshold"], 255, 0).astype(np.uint8).tobytes()

        return _mapped(lines.join(otsu(histogram(lines, keys), keys), list(keys)), keys, ["y", "pixels", "threshold"], cut, "y int, pixels binary")

    cuts, more = strips(lines, keys, height, BLOCK // 2 + MEDIAN // 2), []
    if method == "enhanced":
        cuts, more = cuts.join(contrast_tables(lines, keys), list(keys)), ["height", "width", "tables"]

    def run(found: Lines) -> Iterator[tuple]:
        for key, row in found:
            places = [r["y"] for r in row["lines"]]
            if places != list(range(places[0], places[0] + len(places))) or len({len(r["pixels"]) for r in row["lines"]}) > 1:
                raise ValueError(f"page {key}: a line is missing or of another length")
            grey = np.stack([_grey(r["pixels"]) for r in row["lines"]])
            if more:
                grey = equalised(grey, places[0], *(row[c] for c in more))
            done = median(local_threshold(grey))
            yield from ((key, y, line.tobytes()) for y, line in zip(places, done, strict=True) if y // height == row["strip"])

    return _mapped(cuts, keys, ["strip", "lines", *more], run, "y int, pixels binary")


def page_columns(rows: DataFrame, keys: Sequence[str] = PAGE) -> DataFrame:
    """(keys, gutter_x, least, mean, num_columns, page_width, page_height): the
    columns of each page by the ink of its verticals."""
    from glossaflow.operators.layout import column_profile

    lines = single_lines(rows, keys)
    dark = ink(lines, otsu(histogram(lines, keys), keys), keys)
    sizes = lines.groupBy(*keys).agg(F.max(F.octet_length("pixels")).alias("page_width"), (F.max("y") + 1).cast("int").alias("page_height"))
    return column_profile(dark, keys).join(sizes, list(keys))
