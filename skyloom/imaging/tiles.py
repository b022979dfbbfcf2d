"""Source finding on images cut into tiles, so that no task holds more than a tile and what its neighbours say of it.

The background grid is a value a tile; the noise map inside a tile follows from its own value and its eight neighbours'.
Pixels above the threshold are labelled in each tile, and parts that touch over a border become one island by connected
components of the border's edges. Results are those of the kernels on the whole image.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.imaging import kernels
from skyloom.operators.components import components
from skyloom.plans.state import cut

TILE = "image long, nx int, ny int, i int, j int, pixels array<double>"
PART = "image long, kind string, x int, y int, node long, n long, total double, peak double, above boolean"


def tiles(images: DataFrame, size: int = 32) -> DataFrame:
    """images(image, nx, ny, pixels) as TILE rows: tile i, j begins at pixel (i * size, j * size); those at the end may be smaller."""

    def one(i, j):
        wide = F.least(F.lit(size), F.col("ny") - j * size)
        rows = F.sequence(i * size, F.least(F.col("nx"), (i + 1) * size) - 1)
        return F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), F.flatten(F.transform(rows, lambda x: F.slice("pixels", x * F.col("ny") + j * size + 1, wide))).alias("pixels"))

    count = lambda c: F.sequence(F.lit(0), F.floor((F.col(c) - 1) / size).cast("int"))
    each = F.flatten(F.transform(count("nx"), lambda i: F.transform(count("ny"), lambda j: one(i, j))))
    own = images.selectExpr("CAST(image AS BIGINT) AS image", "CAST(nx AS INT) AS nx", "CAST(ny AS INT) AS ny", "pixels")
    return own.select("image", "nx", "ny", F.explode(each).alias("t")).select("image", "nx", "ny", "t.*")


def _array(pixels, nx: int, ny: int, i: int, j: int, size: int) -> np.ndarray:
    return np.asarray(pixels, float).reshape(min(size, nx - i * size), min(size, ny - j * size))


def background(tiles_: DataFrame, size: int = 32) -> DataFrame:
    """image, i, j, mode, rms of every whole tile; null where a tile has no usable pixel or is all zero."""

    def run(batches):
        import pandas as pd

        for b in batches:
            rows = []
            for r in b.itertuples():
                data = _array(r.pixels, r.nx, r.ny, r.i, r.j, size)
                if data.shape == (size, size):
                    mode, rms = (None if np.isnan(g[0, 0]) else float(g[0, 0]) for g in kernels.background_grids(data, kernels.usable(data), (size, size)))
                    rows.append((r.image, r.i, r.j, mode, rms))
            yield pd.DataFrame(rows, columns=["image", "i", "j", "mode", "rms"])

    return tiles_.select("image", "nx", "ny", "i", "j", "pixels").mapInPandas(run, "image long, i int, j int, mode double, rms double")


def with_grid(tiles_: DataFrame, grid: DataFrame) -> DataFrame:
    """tiles with `near`: the grid around each, a struct for each of up to nine tiles; empty tiles have the image's mean, and `least` is its least noise."""
    means = grid.groupBy("image").agg(F.avg("mode").alias("m"), F.avg("rms").alias("s"), F.min("rms").alias("least"))
    filled = grid.join(means, "image").select("image", "i", "j", F.coalesce("mode", "m").alias("mode"), F.coalesce("rms", "s").alias("rms"), "least")
    step = F.explode(F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (-1, 0, 1) for b in (-1, 0, 1))))
    spread = filled.withColumn("d", step).select("image", (F.col("i") + F.col("d.a")).alias("i"), (F.col("j") + F.col("d.b")).alias("j"), "least", F.struct(F.col("i").alias("gi"), F.col("j").alias("gj"), "mode", "rms").alias("g"))
    near = spread.groupBy("image", "i", "j").agg(F.collect_list("g").alias("near"), F.first("least").alias("least"))  # nine at most
    return tiles_.join(near, ["image", "i", "j"])


def _map(near: list, name: str, shape: tuple[int, int], i: int, j: int, size: int) -> np.ndarray:
    """A tile's part of the map that is linear between tile centres and constant beyond the outer ones."""
    gi, gj = (sorted({g[k] for g in near}) for k in ("gi", "gj"))
    grid = np.full((len(gi), len(gj)), np.nan)
    for g in near:
        grid[gi.index(g["gi"]), gj.index(g["gj"])] = g[name]
    x, y = i * size + np.arange(shape[0]), j * size + np.arange(shape[1])
    cx, cy = ((np.array(k) + 0.5) * size - 0.5 for k in (gi, gj))
    rows = np.stack([np.interp(y, cy, r) for r in grid])
    return np.stack([np.interp(x, cx, c) for c in rows.T], 1)


def parts(tiles_: DataFrame, detection: float, analysis: float, size: int = 32) -> DataFrame:
    """PART rows of tiles: a part for each label of a tile, named by its first pixel, and its pixels on the tile's borders.

    Tiles with a grid (`near`) have their background taken off and thresholds in units of noise; others are taken as they are.
    """
    columns = ["image", "nx", "ny", "i", "j", "pixels", *(["near", "least"] if "near" in tiles_.columns else [])]

    def run(batches):
        import pandas as pd

        for b in batches:
            rows = []
            for r in b.to_dict("records"):
                i, j, ny = r["i"], r["j"], r["ny"]
                data = _array(r["pixels"], r["nx"], ny, i, j, size)
                flux, rms = data, np.ones_like(data)
                if "near" in r:
                    near = [dict(g) for g in r["near"]]
                    flux, rms = data - _map(near, "mode", data.shape, i, j, size), np.maximum(_map(near, "rms", data.shape, i, j, size), r["least"])
                names, n = kernels.label(~np.isnan(data) & (flux > analysis * rms))
                x, y = np.nonzero(names)
                k = names[x, y] - 1
                place = (x + i * size) * ny + y + j * size
                first = np.full(n, np.iinfo(np.int64).max)
                np.minimum.at(first, k, place)
                v = flux[x, y]
                peak, total, over = np.full(n, -np.inf), np.bincount(k, v, n), np.zeros(n, bool)
                np.maximum.at(peak, k, v)
                np.logical_or.at(over, k, v - detection * rms[x, y] >= 0)
                rows += [(r["image"], "part", None, None, int(first[m]), int(c), float(total[m]), float(peak[m]), bool(over[m])) for m, c in enumerate(np.bincount(k, minlength=n).tolist())]
                # a pixel at a tile's end is met by the one at the next tile's beginning, under that one's place
                for kind, at, far, dx, dy in (("x", x, data.shape[0] - 1, 1, 0), ("y", y, data.shape[1] - 1, 0, 1)):
                    for edge, px, py in ((at == far, dx, dy), (at == 0, 0, 0)):
                        rows += [(r["image"], kind + ("<" if px + py else ">"), int(a + i * size + px), int(c + j * size + py), int(first[m]), None, None, None, None) for a, c, m in zip(x[edge], y[edge], k[edge], strict=True)]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in PART.split(", ")]).astype({"x": "Int32", "y": "Int32", "n": "Int64", "above": "boolean"})

    return tiles_.select(columns).mapInPandas(run, PART)


def islands(images: DataFrame, detection: float, analysis: float, size: int = 32, grid: bool = True) -> DataFrame:
    """image, island (its first pixel, x * ny + y), n, total, peak of pixels above analysis that touch one above detection.

    With grid, in units of the noise and without the background; otherwise thresholds are values of pixels.
    """
    own = tiles(images, size)
    if grid:
        own = cut(own)
        own = with_grid(own, background(own, size))
    found = cut(parts(own, detection, analysis, size))
    one, other = found.filter("kind IN ('x<', 'y<')"), found.filter("kind IN ('x>', 'y>')")
    side = lambda df, name: df.select("image", F.substring("kind", 1, 1).alias("kind"), "x", "y", F.col("node").alias(name))
    roots = components(side(one, "a").join(side(other, "b"), ["image", "kind", "x", "y"]).select("image", "a", "b"))
    whole = found.filter("kind = 'part'").join(roots, ["image", "node"], "left").withColumn("island", F.coalesce("root", "node"))
    sums = whole.groupBy("image", "island").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.max("peak").alias("peak"), F.bool_or("above").alias("above"))
    return sums.filter("above").drop("above")
