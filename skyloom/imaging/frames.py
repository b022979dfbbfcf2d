"""Source finding over DataFrames of images."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FOUND = "image long, n int, x double, y double, peak double, peak_err double, flux double, flux_err double, major double, minor double, theta double, significance double, chisq double, reduced_chisq double, fitted boolean, major_dc double, major_dc_err double, minor_dc double, minor_dc_err double, theta_dc double, failed_dc int, x_err double, y_err double, major_err double, minor_err double, theta_err double"
NAMES = [c.split()[0] for c in FOUND.split(", ")]
BEAM = ("beam_smaj_pix", "beam_smin_pix", "beam_pa_rad")


def _columns(beam) -> list[str]:
    return ["image", "nx", "ny", "pixels", *(BEAM if beam is None else ())]


def _beam(row, beam):
    from skyloom.imaging.kernels import Beam

    return Beam(*(beam or (getattr(row, c) for c in BEAM)))


def _row(image, n, f, beam):
    from skyloom.imaging.kernels import deconvolution_errors, deconvolved

    s = f.shape
    own, theirs = (s.major, s.minor, float(np.degrees(s.theta))), (beam.major, beam.minor, float(np.degrees(beam.theta)))
    major, minor, angle, failed = deconvolved(*own, theirs)
    e = deconvolution_errors(*own, theirs, (s.errors["major"], s.errors["minor"], float(np.degrees(s.errors["theta"]))))
    return (image, n, float(s.x), float(s.y), float(s.peak), float(s.errors["peak"]), float(s.flux), float(s.errors["flux"]), float(s.major), float(s.minor), float(s.theta), f.significance, f.chi, f.reduced, s.fitted, major, e[0], minor, e[1], float(np.radians(angle)), failed, *(float(s.errors[k]) for k in ("x", "y", "major", "minor", "theta")))


def extract(images: DataFrame, beam: tuple[float, float, float] | None = None, detection: float = 8.0, analysis: float = 3.0, tile: tuple[int, int] = (32, 32), margin: int = 0, blend: bool = False, force_beam: bool = False, alpha: float | None = None) -> DataFrame:
    """images(image, nx, ny, pixels) -> the sources found in each; with alpha, at the false-discovery threshold.

    Without a beam for all, each image has its own in columns BEAM. An image is one row and is worked on by itself, so
    tasks need the memory of one image at a time.
    """

    def run(batches):
        import pandas as pd

        from skyloom.imaging.kernels import Finder

        for batch in batches:
            rows = []
            for r in batch.itertuples():
                finder = Finder(np.asarray(r.pixels, float).reshape(r.nx, r.ny), _beam(r, beam), tile, margin)
                found = finder.extract(detection, analysis, blend, force_beam) if alpha is None else finder.false_discovery(alpha)
                rows += [_row(r.image, i, f, finder.beam) for i, f in enumerate(found)]
            yield pd.DataFrame(rows, columns=NAMES)

    return images.select(*_columns(beam)).mapInPandas(run, FOUND)


def forced(images: DataFrame, requests: DataFrame, beam: tuple[float, float, float] | None = None, box: float = 10.0, tile: tuple[int, int] = (32, 32)) -> DataFrame:
    """Fits at requests(image, n, x, y); positions outside or masked give no row."""

    def run(image, wanted):
        import pandas as pd

        from skyloom.imaging.kernels import Finder

        rows = []
        for r in image.itertuples():
            finder = Finder(np.asarray(r.pixels, float).reshape(r.nx, r.ny), _beam(r, beam), tile)
            rows += [_row(r.image, q.n, f, finder.beam) for q in wanted.itertuples() if (f := finder.fit_at(q.x, q.y, box)) is not None]
        return pd.DataFrame(rows, columns=NAMES)

    return images.select(*_columns(beam)).groupBy("image").cogroup(requests.groupBy("image")).applyInPandas(run, FOUND)


def labels(detecting: DataFrame, beam: tuple[float, float, float] | None = None, detection: float = 8.0, analysis: float = 3.0, tile: tuple[int, int] = (32, 32), margin: int = 0, grid: bool = True) -> DataFrame:
    """detecting(field, nx, ny, pixels), one image a field -> field, label_nx, label_ny, islands: array of (island, cells).

    An island is known by its first cell. Without a grid, background is 0 and noise 1. Two images of one field are an error.
    """
    if not detecting.groupBy("field").count().filter("count > 1").isEmpty():
        raise ValueError("a field has more than one detection image")

    def run(batches):
        import pandas as pd

        from skyloom.imaging.kernels import Finder

        for batch in batches:
            rows = []
            for r in batch.itertuples():
                data = np.asarray(r.pixels, float).reshape(r.nx, r.ny)
                flat = {} if grid else {"background": np.zeros_like(data), "rms": np.ones_like(data)}
                finder = Finder(data, _beam(r, beam), tile, margin, **flat)
                rows.append((r.field, r.nx, r.ny, [{"island": int(c[0]), "cells": c.tolist()} for c in finder.labelled(detection, analysis)]))
            yield pd.DataFrame(rows, columns=["field", "label_nx", "label_ny", "islands"])

    own = detecting.select("field", "nx", "ny", "pixels", *(BEAM if beam is None else ()))
    return own.mapInPandas(run, f"field {own.schema['field'].dataType.simpleString()}, label_nx int, label_ny int, islands array<struct<island:int,cells:array<int>>>")


def _labelled(images: DataFrame, found: DataFrame) -> DataFrame:
    """Images with their field's islands. An image is one row and takes its field's labels to it, so no field is a group."""
    same = (F.col("nx") == F.col("label_nx")) & (F.col("ny") == F.col("label_ny"))
    joined = images.join(found, "field")
    return joined.withColumn("islands", F.when(same, F.col("islands")).otherwise(F.raise_error(F.lit("an image and its field's detection image differ in shape")).cast(found.schema["islands"].dataType)))


def extract_in(images: DataFrame, found: DataFrame, beam: tuple[float, float, float] | None = None, detection: float = 8.0, analysis: float = 3.0, tile: tuple[int, int] = (32, 32), margin: int = 0, blend: bool = False, force_beam: bool = False) -> DataFrame:
    """images(image, field, nx, ny, pixels) measured in the islands that `labels` found on their field's detection image.

    Columns as of `extract` and island. Images of a field without detection image give nothing, as do islands without flux.
    """

    def run(batches):
        import pandas as pd

        from skyloom.imaging.kernels import Finder

        for batch in batches:
            rows = []
            for r in batch.itertuples():
                finder = Finder(np.asarray(r.pixels, float).reshape(r.nx, r.ny), _beam(r, beam), tile, margin)
                n = 0
                for i in r.islands:
                    for f in finder.extract_in(i["cells"], detection, analysis, blend, force_beam):
                        rows.append((*_row(r.image, n, f, finder.beam), i["island"]))
                        n += 1
            yield pd.DataFrame(rows, columns=[*NAMES, "island"])

    return _labelled(images.select("field", *_columns(beam)), found).select(*_columns(beam), "islands").mapInPandas(run, f"{FOUND}, island int")


def sums_in(images: DataFrame, found: DataFrame) -> DataFrame:
    """image, island, n, total, peak of the pixels that lie in the islands of the field's detection image; nothing is taken off them."""
    of = lambda i: F.transform(i["cells"], lambda c: F.col("pixels")[c])
    sums = F.transform("islands", lambda i: F.struct(i["island"].alias("island"), F.size(i["cells"]).cast("long").alias("n"), F.aggregate(of(i), F.lit(0.0), lambda a, v: a + v).alias("total"), F.array_max(of(i)).alias("peak")))
    return _labelled(images.select("image", "field", "nx", "ny", "pixels"), found).select("image", F.inline(sums))


#: Maps by name: found Gaussians, what is left of the image without them, noise, and flux over noise.
MAPS = ("gaussians", "residual", "rms", "significance")


def result_maps(images: DataFrame, found: DataFrame, beam: tuple[float, float, float] | None = None, kinds: tuple[str, ...] = MAPS, tile: tuple[int, int] = (32, 32), margin: int = 0) -> DataFrame:
    """image, map, nx, ny, pixels: a row for each map asked for of each image, from what any mode found on it.

    Significance is NaN where there is no noise.
    """
    if not set(kinds) <= set(MAPS):
        raise ValueError(f"maps are {', '.join(MAPS)}")

    def run(image, theirs):
        import pandas as pd

        from skyloom.imaging.kernels import Finder, Found, Shape

        rows = []
        for r in image.itertuples():
            data = np.asarray(r.pixels, float).reshape(r.nx, r.ny)
            finder = Finder(data, _beam(r, beam), tile, margin)
            shapes = [Found(Shape(q.peak, q.x, q.y, q.major, q.minor, q.theta), q.significance, q.chisq, q.reduced_chisq) for q in theirs.itertuples()]
            model = finder.maps(shapes)[0]
            with np.errstate(divide="ignore", invalid="ignore"):
                made = {"gaussians": model, "residual": data - model, "rms": finder.rms, "significance": np.where(finder.rms > 0, finder.flux / finder.rms, np.nan)}
            rows += [(r.image, k, r.nx, r.ny, made[k].ravel()) for k in kinds]
        return pd.DataFrame(rows, columns=["image", "map", "nx", "ny", "pixels"])

    shapes = found.select("image", "peak", "x", "y", "major", "minor", "theta", "significance", "chisq", "reduced_chisq")
    return images.select(*_columns(beam)).groupBy("image").cogroup(shapes.groupBy("image")).applyInPandas(run, "image long, map string, nx int, ny int, pixels array<double>")


def flux_at(images: DataFrame, positions: DataFrame, n: int = 1) -> DataFrame:
    """image, id, flux: the largest pixel within n of each of positions(image, id, x, y), by the kernel; no background is taken off."""

    def run(image, wanted):
        import pandas as pd

        from skyloom.imaging.kernels import largest_near

        rows = []
        for r in image.itertuples():
            data = np.asarray(r.pixels, float).reshape(r.nx, r.ny)
            rows += [(r.image, q.id, largest_near(data, q.x, q.y, n)) for q in wanted.itertuples()]
        return pd.DataFrame(rows, columns=["image", "id", "flux"])

    return images.select("image", "nx", "ny", "pixels").groupBy("image").cogroup(positions.groupBy("image")).applyInPandas(run, "image long, id long, flux double")


def clipped_rms(images: DataFrame, sigma: float = 3.0, fraction: float = 4.0) -> DataFrame:
    """image, rms."""

    def run(batches):
        import pandas as pd

        from skyloom.imaging import kernels

        for b in batches:
            yield pd.DataFrame({"image": b.image, "rms": [kernels.clipped_rms(np.asarray(p, float).reshape(x, y), sigma, fraction) for p, x, y in zip(b.pixels, b.nx, b.ny, strict=True)]})

    return images.select("image", "nx", "ny", "pixels").mapInPandas(run, "image long, rms double")


def noise(images: DataFrame, tile: tuple[int, int] = (32, 32), margin: int = 0, sigma: float = 3.0, fraction: float = 4.0) -> DataFrame:
    """image, rms_qc, rms_min, rms_max: the clipped noise of the middle, and the range of the noise map over usable pixels.

    Null where an image holds NaN, and where no pixel is usable.
    """

    def run(batches):
        import pandas as pd

        from skyloom.imaging import kernels

        for b in batches:
            rows = []
            for i, p, x, y in zip(b.image, b.pixels, b.nx, b.ny, strict=True):
                data = np.asarray(p, float).reshape(x, y)
                if np.isnan(data).any():
                    rows.append((i, None, None, None))
                    continue
                finder = kernels.Finder(data, kernels.Beam(1.0, 1.0, 0.0), tile, margin)
                inside = finder.rms[finder.ok]
                low, high = (float(inside.min()), float(inside.max())) if len(inside) and not finder.empty else (None, None)
                rows.append((i, float(kernels.clipped_rms(data, sigma, fraction)), low, high))
            yield pd.DataFrame(rows, columns=["image", "rms_qc", "rms_min", "rms_max"])

    return images.select("image", "nx", "ny", "pixels").mapInPandas(run, "image long, rms_qc double, rms_min double, rms_max double")


def combined(images: DataFrame, key: str, average: bool = True) -> DataFrame:
    """key, freq_low, freq_high, pixels: sum or mean of each key's images, pixel by pixel."""
    exploded = images.select(key, "freq_eff", F.posexplode("pixels").alias("pos", "p"))
    one = exploded.groupBy(key, "pos").agg((F.avg("p") if average else F.sum("p")).alias("p"), F.min("freq_eff").alias("lo"), F.max("freq_eff").alias("hi"))
    return one.groupBy(key).agg(F.min("lo").alias("freq_low"), F.max("hi").alias("freq_high"), F.transform(F.array_sort(F.collect_list(F.struct("pos", "p"))), lambda s: s["p"]).alias("pixels"))


def image_moments(images: DataFrame) -> DataFrame:
    """image, total, xbar, ybar, xx, yy, xy of arrays, by sums alone. Null where an image sums to 0."""
    p = images.select("image", "ny", F.posexplode("pixels").alias("pos", "v")).withColumns({"x": F.floor(F.col("pos") / F.col("ny")), "y": F.col("pos") % F.col("ny")})
    total = F.nullif(F.sum("v"), F.lit(0.0))
    mean = lambda c: F.sum(c * F.col("v")) / total
    x, y = F.col("x"), F.col("y")
    m = p.groupBy("image").agg(F.sum("v").alias("total"), mean(x).alias("xbar"), mean(y).alias("ybar"), mean(x * x).alias("a"), mean(y * y).alias("b"), mean(x * y).alias("c"))
    return m.select("image", "total", "xbar", "ybar", (F.col("a") - F.col("xbar") * F.col("xbar")).alias("xx"), (F.col("b") - F.col("ybar") * F.col("ybar")).alias("yy"), (F.col("c") - F.col("xbar") * F.col("ybar")).alias("xy"))
