import os

import numpy as np
import pytest

from skyloom.cli import main
from skyloom.imaging import frames
from skyloom.imaging import kernels as k
from skyloom.sources import fits
from tests.test_imaging import BEAM, sky

BANDS = [(60, 30.3, 39.8), (40, 90.4, 80.1)], [(20, 30.3, 39.8), (2.5, 90.4, 80.1), (80, 64.0, 100.5)]
SCHEMA = "image long, field int, nx int, ny int, pixels array<double>"
BEAM3 = (BEAM.major, BEAM.minor, BEAM.theta)


def rows(*images, field=1):
    return [(i, field, *m.shape, m.ravel().tolist()) for i, m in enumerate(images)]


@pytest.fixture(scope="module")
def bands():
    return sky(BANDS[0], 1), sky(BANDS[1], 2)


def test_fluxes_of_one_bands_islands_in_all(spark, bands):
    """A source too weak to be detected is measured, one that the detection image lacks is not."""
    images = spark.createDataFrame(rows(*bands), SCHEMA).repartition(2)
    found = frames.labels(images.filter("image = 0"), BEAM3)
    out = frames.extract_in(images, found, BEAM3).collect()
    by = {(r.image, r.island): r for r in out}
    islands = sorted({r.island for r in out})
    assert len(islands) == 2 and {i for i, _ in by} == {0, 1}
    for image, truth in enumerate(BANDS):
        for island, (peak, x, y) in zip(islands, truth, strict=False):
            if (image, island) in by and peak > 10:
                r = by[image, island]
                assert abs(r.peak - peak) < 5 * r.peak_err + 1 and abs(r.x - x) < 1 and abs(r.y - y) < 1
    assert not any(abs(r.x - 64) < 3 and abs(r.y - 100) < 3 for r in out)
    own = {(round(f.shape.x, 6), round(f.shape.peak, 6)) for f in k.Finder(bands[0], BEAM).extract(8, 3)}
    assert {(round(r.x, 6), round(r.peak, 6)) for r in out if r.image == 0} == own  # on itself it is plain extraction
    assert len({(r.image, r.n) for r in out}) == len(out)


def test_sums_equal_numpy(spark, bands):
    images = spark.createDataFrame(rows(*bands), SCHEMA)
    found = frames.labels(images.filter("image = 0"), BEAM3)
    cells = k.Finder(bands[0], BEAM).labelled(8, 3)
    got = {(r.image, r.island): r for r in frames.sums_in(images, found).collect()}
    assert len(got) == 2 * len(cells)
    for c in cells:
        for i, m in enumerate(bands):
            r = got[i, int(c[0])]
            assert r.n == len(c) and r.total == pytest.approx(m.ravel()[c].sum()) and r.peak == m.ravel()[c].max()


def test_edges(spark, bands):
    """Empty and flat images, all NaN, another shape, a field without and one with two detection images."""
    empty, flat, lost = np.zeros((128, 128)), np.full((128, 128), 3.0), np.full((128, 128), np.nan)
    images = spark.createDataFrame(rows(bands[0], empty, flat, lost, -np.abs(bands[0])), SCHEMA)
    found = frames.labels(images.filter("image = 0"), BEAM3)
    assert {r.image for r in frames.extract_in(images, found, BEAM3).collect()} == {0}
    for one in (1, 2, 3):
        assert frames.labels(images.filter(f"image = {one}"), BEAM3).first().islands == []
    assert frames.extract_in(images.limit(0), found, BEAM3).collect() == []
    other = spark.createDataFrame(rows(bands[0], field=7), SCHEMA)
    assert frames.extract_in(other, found, BEAM3).collect() == []
    with pytest.raises(ValueError, match="more than one"):
        frames.labels(images, BEAM3)
    small = spark.createDataFrame(rows(bands[0][:64]), SCHEMA)
    with pytest.raises(Exception, match="differ in shape"):
        frames.extract_in(small, found, BEAM3).collect()
    with pytest.raises(ValueError, match="must not exceed"):
        k.Finder(bands[0], BEAM).labelled(3, 8)


def test_maps_add_up(spark, bands):
    images = spark.createDataFrame(rows(*bands), SCHEMA)
    found = frames.extract(images, BEAM3)
    maps = {(r.image, r.map): np.array(r.pixels).reshape(r.nx, r.ny) for r in frames.result_maps(images, found, BEAM3).collect()}
    assert len(maps) == 8
    for i, m in enumerate(bands):
        finder = k.Finder(m, BEAM)
        assert np.allclose(maps[i, "gaussians"] + maps[i, "residual"], m) and np.allclose(maps[i, "rms"], finder.rms)
        assert np.allclose(maps[i, "gaussians"], finder.maps(finder.extract(8, 3))[0])
        assert np.nanmax(maps[i, "significance"]) == pytest.approx((finder.flux / finder.rms).max())
    assert np.abs(maps[0, "residual"][25:36, 35:46]).max() < 8 < maps[0, "gaussians"].max()
    none = frames.result_maps(images, found.limit(0), BEAM3, ("residual",)).collect()
    assert len(none) == 2 and np.allclose(np.sort([sum(r.pixels) for r in none]), np.sort([m.sum() for m in bands]))
    with pytest.raises(ValueError, match="maps are"):
        frames.result_maps(images, found, BEAM3, ("islands",))


def test_command_writes_maps_of_images_measured_in_a_detection_image(spark, bands, tmp_path):
    head = {"CTYPE1": "RA---SIN", "CTYPE2": "DEC--SIN", "CRPIX1": 64.0, "CRPIX2": 64.0, "CRVAL1": 120.0, "CRVAL2": 40.0, "CDELT1": -0.01, "CDELT2": 0.01, "RESTFRQ": 60e6, "DATE-OBS": "2013-05-01T10:00:00", "BMAJ": 0.05, "BMIN": 0.04, "BPA": 17.0}
    for name, m in zip("ab", bands, strict=True):
        (tmp_path / f"{name}.fits").write_bytes(fits.render(m, head))
    out, maps = str(tmp_path / "found"), tmp_path / "maps"
    assert main(["find", str(tmp_path / "*.fits"), "--detection-image", str(tmp_path / "a.fits"), "--out", out, "--maps", "residual", "rms", "--maps-out", str(maps)], spark) == 0
    assert sorted(os.listdir(maps)) == ["a.residual.fits", "a.rms.fits", "b.residual.fits", "b.rms.fits"]
    header, _, data = fits.parse((maps / "b.residual.fits").read_bytes())
    assert float(header["CRVAL1"]) == 120.0 and header["CTYPE1"] == "RA---SIN" and data.shape == (128, 128)
    assert data[64, 100] > 60  # not in the detection image, so still there
    assert abs(data[30, 40]) < 10 and spark.read.option("header", True).csv(out).count() >= 3
    with pytest.raises(SystemExit):
        main(["find", str(tmp_path), "--maps", "rms"], spark)
