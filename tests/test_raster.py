"""Page rasters in strips against whole pages in numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from glossaflow.operators import layout, raster

SCHEMA = "pdf int, page int, y int, pixels binary"


def page(seed, height, width):
    rng = np.random.default_rng(seed)
    shade = np.linspace(120, 240, width)[None, :] + np.linspace(-30, 10, height)[:, None]
    dark = (rng.random((height, width)) < 0.2) * 90
    return np.clip(shade - dark + rng.integers(-4, 5, (height, width)), 0, 255).astype(np.uint8)


PAGES = {(1, 0): page(1, 70, 90), (1, 1): page(2, 64, 64), (2, 0): page(3, 33, 47), (3, 0): np.full((5, 9), 7, np.uint8)}


def lines(spark, pages):
    rows = [(*key, y, bytes(line)) for key, grey in pages.items() for y, line in enumerate(grey)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def whole(df):
    found = {}
    for r in df.orderBy("pdf", "page", "y").collect():
        found.setdefault((r["pdf"], r["page"]), []).append(np.frombuffer(bytes(r["pixels"]), np.uint8))
    return {k: np.stack(v) for k, v in found.items()}


def otsu_of(grey):
    best, at = -1.0, 0
    for t in range(256):
        low, high = grey[grey <= t].astype(float), grey[grey > t].astype(float)
        if len(low) and len(high):
            apart = len(low) * len(high) * (low.mean() - high.mean()) ** 2
            if apart > best * (1 + 1e-12):
                best, at = apart, t
    return at


def test_otsu_and_ink(spark):
    rows = lines(spark, PAGES)
    found = {(r["pdf"], r["page"]): r["threshold"] for r in raster.otsu(raster.histogram(rows)).collect()}
    assert found == {k: otsu_of(v) for k, v in PAGES.items()}
    dark = raster.ink(rows, raster.otsu(raster.histogram(rows))).collect()
    assert len(dark) == sum(v.shape[1] for v in PAGES.values())
    for r in dark:
        grey = PAGES[r["pdf"], r["page"]]
        assert r["width"] == grey.shape[1] and r["ink"] == (grey[:, r["x"]] <= found[r["pdf"], r["page"]]).sum()


@pytest.mark.parametrize("height", [16, 40, 256])
def test_strips_equal_whole_pages(spark, height):
    """Also where a strip is lower than what the filters reach."""
    found = whole(raster.preprocess(lines(spark, PAGES), "auto", height=height))
    assert found.keys() == PAGES.keys()
    for key, grey in PAGES.items():
        assert (found[key] == raster.median(raster.local_threshold(grey))).all()


def test_filters_by_hand():
    grey = PAGES[2, 0]
    reach, sigma = 15, 5.0
    weights = np.exp(-np.subtract.outer(np.arange(31) - reach, np.zeros(1))[:, 0] ** 2 / (2 * sigma**2))
    square = np.outer(weights, weights) / weights.sum() ** 2
    wide, done = np.pad(grey, reach, mode="edge").astype(float), raster.local_threshold(grey)
    for y, x in [(0, 0), (5, 46), (32, 20), (16, 16)]:
        mean = round((wide[y : y + 31, x : x + 31] * square).sum())
        assert done[y, x] == (255 if int(grey[y, x]) - mean > -15 else 0)
    near = np.pad(done, 1, mode="edge")
    assert raster.median(done)[7, 9] == sorted(near[7:10, 9:12].ravel())[4]


def contrast_of(grey):
    """One pixel after the other, from the method's description."""
    high, wide = grey.shape
    grown = (8 - high % 8, 8 - wide % 8) if high % 8 or wide % 8 else (0, 0)
    full = np.pad(grey, ((0, grown[0]), (0, grown[1])), mode="reflect")
    th, tw = full.shape[0] // 8, full.shape[1] // 8
    tables = np.zeros((8, 8, 256))
    for i in range(8):
        for j in range(8):
            counts = [0] * 256
            for v in full[i * th : (i + 1) * th, j * tw : (j + 1) * tw].ravel():
                counts[v] += 1
            most, over = max(int(3.0 * th * tw / 256), 1), 0
            for v in range(256):
                over += max(counts[v] - most, 0)
                counts[v] = min(counts[v], most)
            each, rest = divmod(over, 256)
            counts = [c + each for c in counts]
            step, v = max(256 // rest, 1) if rest else 1, 0
            while rest and v < 256:
                counts[v] += 1
                v, rest = v + step, rest - 1
            tables[i, j] = np.clip(np.rint(np.cumsum(counts) * (255 / (th * tw))), 0, 255)
    out = np.zeros(grey.shape)
    for y in range(high):
        for x in range(wide):
            fy, fx = y / th - 0.5, x / tw - 0.5
            y0, x0 = int(np.floor(fy)), int(np.floor(fx))
            part = 0.0
            for ty, wy in ((max(y0, 0), 1 - (fy - y0)), (min(y0 + 1, 7), fy - y0)):
                for tx, wx in ((max(x0, 0), 1 - (fx - x0)), (min(x0 + 1, 7), fx - x0)):
                    part += tables[ty, tx, grey[y, x]] * wy * wx
            out[y, x] = part
    return out


def test_enhanced(spark):
    pages = {k: v for k, v in PAGES.items() if k != (3, 0)}
    held = {(r["pdf"], r["page"]): r for r in raster.contrast_tables(lines(spark, pages)).collect()}
    found = whole(raster.preprocess(lines(spark, pages), "enhanced", height=24))
    for key, grey in pages.items():
        r = held[key]
        ours = raster.equalised(grey, 0, r["height"], r["width"], bytes(r["tables"]))
        # The nearest whole value; between two that are equally near, either.
        assert np.abs(ours - contrast_of(grey)).max() <= 0.5 + 1e-6
        assert (found[key] == raster.median(raster.local_threshold(ours))).all()


def test_simple_repeats_and_empty(spark):
    rows = lines(spark, PAGES)
    twice = rows.unionByName(rows).unionByName(spark.createDataFrame([(9, 9, 0, None), (9, 9, 1, b"")], SCHEMA)).withColumn("threshold_", F.lit(1))
    found = whole(raster.preprocess(twice, "simple"))
    assert found.keys() == PAGES.keys()
    assert all((found[k] == np.where(v > otsu_of(v), 255, 0)).all() for k, v in PAGES.items())
    assert raster.preprocess(rows.where("false"), "enhanced").count() == 0
    assert raster.preprocess(rows, "none").count() == rows.count()
    with pytest.raises(ValueError):
        raster.preprocess(rows, "other")


def test_missing_line(spark):
    with pytest.raises(Exception, match="missing"):
        raster.preprocess(lines(spark, PAGES).where("y <> 3"), "auto").collect()


def test_columns_feed_the_vote(spark):
    two = np.full((40, 100), 230, np.uint8)
    two[:, 5:45] = two[:, 55:95] = 20
    one = np.full((40, 100), 230, np.uint8)
    one[:, 5:95] = 20
    found = raster.page_columns(lines(spark, {(1, 0): two, (1, 1): two, (1, 2): one}))
    facts = {"is_scanned": F.lit(True), "has_text": F.lit(False), "image_w": F.lit(0), "image_h": F.lit(0)}
    voted = layout.layout_vote(found.withColumns(facts)).collect()
    assert [(r["num_columns"], r["gutter_x"], r["page_width"], r["page_height"]) for r in voted] == [(2, 45, 100, 40)]
