import numpy as np
import pytest
from pyspark.sql import functions as F

from skyloom import cli
from skyloom.imaging import kernels as k
from skyloom.plans import batch
from skyloom.plans.catalogue import Catalogue
from skyloom.sources import fits


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    home = tmp_path_factory.mktemp("images")
    x, y = np.indices((96, 96))
    for i in range(3):
        image = np.random.default_rng(i).normal(0, 1, (96, 96))
        for peak, a, b in ((40 + 20 * i, 30, 40), (60, 70, 60)):
            image += k.gaussian(k.Shape(peak, a, b, 2.5, 2.5, 0.0), x, y)
        header = {"CRVAL1": 180.0, "CRVAL2": 30.0, "CRPIX1": 48.0, "CRPIX2": 48.0, "CDELT1": -0.01, "CDELT2": 0.01, "RESTFRQ": 6e7, "BMAJ": 0.05, "BMIN": 0.05, "BPA": 0.0, "DATE-OBS": f"2024-01-0{i + 1}T00:00:00"}
        (home / f"{i}.fits").write_bytes(fits.render(image, header))
    flat = fits.render(np.zeros((96, 96)), header | {"DATE-OBS": "2024-01-09T00:00:00"})
    (home / "flat.fits").write_bytes(flat)
    return home


def test_images_become_a_catalogue(spark, folder, tmp_path):
    state, measured = batch.run(spark, str(folder / "*.fits"), str(tmp_path / "store"), sys_err_arcsec=10.0, copy_images=True, compaction=3)
    assert measured.count() == 6 and state.runcat.count() == 2 and {r.datapoints for r in state.runcat.collect()} == {3}
    v = sorted(r.v_int for r in batch.variability(state, measured).collect())
    assert v[0] < 0.1 < 0.25 < v[1]
    store = Catalogue(spark, str(tmp_path / "store"))
    assert sorted(str(r.reason) for r in store.read("image").collect()) == ["None"] * 3 + ["flat image"]
    assert store.log()["version"] > 6 and store.log()["generation"] >= 2 and store.read("varmetric").count() == 2 and store.read("dataset").first().process_end_ts is not None
    copies = {r.image: fits.parse(bytes(r.fits_data)) for r in store.read("imagedata").collect()}
    assert len(copies) == 4 and all(h["CRVAL1"] == "180.0" and data.shape == (96, 96) for h, _, data in copies.values())
    for r in store.read("extractedsource").collect():  # the two planted places, in degrees
        assert abs(r.decl - 30) < 0.4 and 0 < r.error_radius < 60 and 60 < r.semimajor < 140 and r.uew > 10 / 3600


@pytest.fixture(scope="module")
def fading(tmp_path_factory):
    """Four images: one steady source, one that is only in the third, one that fades after the second; beams differ."""
    home = tmp_path_factory.mktemp("fading")
    x, y = np.indices((96, 96))
    for i in range(4):
        image = np.random.default_rng(50 + i).normal(0, 1, (96, 96))
        for peak, a, b, when in ((60, 30, 40, (0, 1, 2, 3)), (50, 70, 60, (2,)), (40, 60, 20, (0, 1))):
            if i in when:
                image += k.gaussian(k.Shape(peak, a, b, 2.0 + 0.5 * (i % 2), 2.0 + 0.5 * (i % 2), 0.0), x, y)
        half = 2 * (2.0 + 0.5 * (i % 2)) * 0.01
        header = {"CRVAL1": 0.05, "CRVAL2": 30.0, "CRPIX1": 48.0, "CRPIX2": 48.0, "CDELT1": -0.01, "CDELT2": 0.01, "RESTFRQ": 6e7, "BMAJ": half, "BMIN": half, "BPA": 0.0, "DATE-OBS": f"2024-01-0{i + 1}T00:00:00", "END_UTC": f"2024-01-0{i + 1}T00:05:00"}
        (home / f"{i}.fits").write_bytes(fits.render(image, header))
    return home


def test_time_steps_over_the_meridian(spark, fading, tmp_path):
    """New source in the third image, forced fits where sources are not seen, a monitored place, V and eta kept."""
    state, made = batch.run(spark, str(fading / "*.fits"), str(tmp_path / "store"), monitors=[(0.2, 30.2)])
    runcat = {r.runcat: r for r in state.runcat.collect()}
    blind = sorted((r for r in runcat.values() if not r.mon_src), key=lambda r: r.datapoints)
    assert [(r.datapoints, r.forcedfits_count) for r in blind] == [(1, 1), (2, 2), (4, 0)]
    watched = [r for r in runcat.values() if r.mon_src]
    assert len(watched) == 1 and watched[0].datapoints == 4
    events = state.newsource.collect()
    assert [(r.runcat, r.newsource_type) for r in events] == [(blind[0].runcat, 1)]
    types = sorted((r.runcat == watched[0].runcat, r.type) for r in state.assoc.collect())
    assert types == [*[(False, 3)] * 4, *[(False, 4)] * 3, *[(False, 7)] * 3, (True, 8), *[(True, 9)] * 3]
    store = Catalogue(spark, str(tmp_path / "store"))
    assert [r.runcat for r in store.read("monitor").collect()] == [watched[0].runcat]
    assert {r.tau_time for r in store.read("image").collect()} == {300.0}
    ff = {r.xtrsrc: r for r in made.filter(F.col("xtrsrc") % batch.IMAGE >= batch.NULL).collect()}
    assert len(ff) == 7  # their peaks have the fit's noise bias taken off, which at no signal is noise**2 / peak
    steady = [r for r in made.join(state.assoc.filter(F.col("runcat") == blind[2].runcat), "xtrsrc").collect()]
    assert all(abs(r.f_int - 60) < 12 for r in steady)  # by each image's own beam


def test_command_line(spark, folder, tmp_path):
    assert cli.main(["find", str(folder / "[0-2].fits"), "--out", str(tmp_path / "csv")], spark) == 0
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 6
