import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyloom.functions import geometry as g
from skyloom.imaging import kernels as k
from skyloom.imaging import tiles
from skyloom.operators import discovery
from skyloom.operators import images as im
from skyloom.operators.components import components


def planted(seed):
    rng = np.random.default_rng(seed)
    x, y = np.indices((83, 70))
    image = rng.normal(2, 1, (83, 70)) * (1 + x / 100)
    for _ in range(14):
        image += k.gaussian(k.Shape(rng.uniform(8, 60), rng.uniform(0, 83), rng.uniform(0, 70), rng.uniform(2, 7), 2.0, rng.uniform(0, 3), 0.0), x, y)
    image[15, 16], image[40:44, 30] = np.nan, np.nan
    return image


def test_islands_over_tiles_are_those_of_the_whole_image(spark):
    images = [planted(i) for i in range(3)]
    df = spark.createDataFrame([(i, *a.shape, a.ravel().tolist()) for i, a in enumerate(images)], "image long, nx int, ny int, pixels array<double>")
    got = {(r.image, r.island): (r.n, round(r.total, 6), round(r.peak, 6)) for r in tiles.islands(df, 5, 3, 16).collect()}
    want = {}
    for i, a in enumerate(images):
        f = k.Finder(a, k.Beam(2, 2, 0), (16, 16))
        for s in k.islands(f.flux, f.rms, f.ok, 5, 3):
            x, y = np.nonzero(~np.isnan(s.data))
            want[i, int(((x + s.x0) * 70 + y + s.y0).min())] = (len(x), round(float(np.nansum(s.data)), 6), round(float(np.nanmax(s.data)), 6))
    assert got == want and len(want) > 15


def test_tiles_hold_every_pixel_once(spark):
    a = np.arange(7 * 5, dtype=float).reshape(7, 5)
    rows = tiles.tiles(spark.createDataFrame([(1, 7, 5, a.ravel().tolist())], "image long, nx int, ny int, pixels array<double>"), 3).collect()
    assert sorted((r.i, r.j) for r in rows) == [(i, j) for i in range(3) for j in range(2)]
    for r in rows:
        assert r.pixels == a[r.i * 3 : r.i * 3 + 3, r.j * 3 : r.j * 3 + 3].ravel().tolist()


def test_components_of_chains_and_groups(spark):
    edges = [(0, i, i + 1) for i in range(40)] + [(1, 5, 3), (1, 3, 9), (1, 7, 8), (1, 2, 2)]
    got = {(r.image, r.node): r.root for r in components(spark.createDataFrame(edges, "image long, a long, b long")).collect()}
    assert all(got[0, i] == 0 for i in range(41)) and [got[1, i] for i in (3, 5, 9, 7, 8)] == [3, 3, 3, 7, 7] and (1, 2) not in got


@pytest.mark.parametrize("digits", [0, 2, 12])
def test_false_discovery_is_the_kernels(spark, digits):
    rng = np.random.default_rng(digits)
    images = {i: np.round(np.r_[rng.normal(0, 1, 900), rng.normal(4, 1, 10 * i)], digits) for i in range(6)}
    df = spark.createDataFrame([(i, float(v)) for i, a in images.items() for v in a] + [(0, None), (0, float("nan"))], "image long, snr double")
    beam = k.Beam(2.0, 1.5, 0.0)
    got = {r.image: r.threshold for r in discovery.fdr_threshold(df, 0.05, 0.25 * math.pi * beam.lengths[0] * beam.lengths[1]).collect()}
    want = {i: k.fdr_threshold(a, 0.05, beam) for i, a in images.items()}
    assert got == {i: t for i, t in want.items() if t is not None} and len(got) >= 4


def test_every_image_is_judged(spark):
    rms = [1.0, 1.1, 0.9, 1.0, 5.0, 1.0, 1.1, 0.9, 5.0, None, 1.0]
    df = spark.createDataFrame([(i, 1, i, v) for i, v in enumerate(rms)] + [(20 + i, 2, i, 1.0) for i in range(4)], "image long, band long, ts long, rms_qc double")
    got = {r.image: r.rejected for r in im.judged_by_history(df, 4, 1.5).collect()}
    for i, v in enumerate(rms):
        last = [x for x in rms[max(0, i - 3) : i + 1] if x is not None]
        want = None if v is None and len(last) >= 4 else len(last) >= 4 and not abs(v - np.mean(last)) < 1.5 * np.std(last)
        assert bool(got[i]) == bool(want), i
    assert [got[20 + i] for i in range(4)] == [False] * 3 + [True]  # all alike: none lies strictly within


@pytest.mark.parametrize("name", g.PROJECTIONS)
def test_projections_go_back(spark, name):
    w = {"crpix1": F.lit(50.0), "crpix2": F.lit(60.0), "crval1": F.lit(359.0), "crval2": F.lit(40.0), "cdelt1": F.lit(-0.3), "cdelt2": F.lit(0.3), "crota2": F.lit(33.0)}
    spots = [(a % 360.0, d) for a in range(330, 390, 7) for d in (5.0, 40.0, 66.0, 89.0)]
    df = spark.createDataFrame(spots, "ra double, decl double")
    x, y = g.pixel_of_sky(F.col("ra"), F.col("decl"), w, name)
    ra, decl = g.sky_of_pixel(F.col("x"), F.col("y"), w, name)
    for r in df.select("ra", "decl", x.alias("x"), y.alias("y")).select("ra", "decl", ra.alias("a"), decl.alias("d")).collect():
        assert abs((r.ra - r.a + 180) % 360 - 180) < 1e-6 and abs(r.decl - r.d) < 1e-7


def test_unknown_projection_is_an_error(spark):
    w = {c: F.lit(1.0) for c in ("crpix1", "crpix2", "crval1", "crval2", "cdelt1", "cdelt2", "crota2")}
    with pytest.raises(ValueError, match="CAR"):
        g.sky_of_pixel(F.lit(1.0), F.lit(1.0), w, "CAR")
    with pytest.raises(Exception, match="no projection CAR"):
        spark.range(1).select(*g.sky_of_pixel(F.lit(1.0), F.lit(1.0), w, F.lit("CAR"))).collect()


def test_ncp_at_a_right_angle_from_its_reference_goes_back(spark):
    w = {"crpix1": F.lit(128.0), "crpix2": F.lit(128.0), "crval1": F.lit(140.0), "crval2": F.lit(55.0), "cdelt1": F.lit(-0.5), "cdelt2": F.lit(0.5), "crota2": F.lit(20.0)}
    at = spark.createDataFrame([(230.0, 10.004), (50.0, 10.004), (230.0, 33.0), (140.0, 20.0)], "ra double, decl double")
    x, y = g.pixel_of_sky(F.col("ra"), F.col("decl"), w, "NCP")
    seen = at.withColumns({"x": x, "y": y})
    for row in seen.select("ra", "decl", *(c.alias(n) for n, c in zip(("ra2", "decl2"), g.sky_of_pixel(F.col("x"), F.col("y"), w, "NCP"), strict=True))).collect():
        assert (row.ra2, row.decl2) == pytest.approx((row.ra, row.decl))


def test_detections_on_sky_use_all_cores_however_few_files_there_are(spark):
    from skyloom.plans import survey_queries

    found = survey_queries.detections_on_sky(spark, "/root/testdata/sf0.001")
    assert found.select(F.spark_partition_id()).distinct().count() >= spark.sparkContext.defaultParallelism
