import pytest
from pyspark.sql import functions as F

from skyloom.functions import ephemeris as e
from skyloom.functions import geometry as g
from skyloom.operators import images as im
from skyloom.plans import batch


def test_sun_at_published_places(spark):
    """A worked example (13 October 1992, place of date precessed to J2000) and an equinox."""
    days = F.col("d")
    rows = spark.createDataFrame([(48908.0,), (51623.316,)], "d double").select(e.sun(days).alias("s")).select("s.*").collect()
    assert rows[0][0] == pytest.approx(198.474, abs=0.02) and rows[0][1] == pytest.approx(-7.824, abs=0.02)
    assert min(rows[1][0], 360 - rows[1][0]) < 0.02 and abs(rows[1][1]) < 0.02


def test_jupiter_is_opposite_to_the_sun_at_an_opposition(spark):
    d = F.lit(55460.5)  # 21 September 2010
    both = spark.range(1).select(e.sun(d).alias("s"), e.jupiter(d).alias("j"), e.jupiter(F.lit(51544.5)).alias("k"))
    row = both.select(g.distance_deg((F.col("s.ra") + 180) % 360, -F.col("s.decl"), F.col("j.ra"), F.col("j.decl")), "k.ra", "k.decl").first()
    assert row[0] < 2 and row[1] == pytest.approx(23.87, abs=0.2) and row[2] == pytest.approx(8.59, abs=0.2)


def test_apparent_sidereal_time_and_nutation(spark):
    """A worked example: 10 April 1987, 0 h at Greenwich: 13 h 10 min 46.1351 s."""
    d = F.lit(46895.0)
    psi, eps, true = e.nutation(d)
    row = spark.range(1).select(psi, eps, true, e.apparent_sidereal_seconds(d, F.lit(0.0))).first()
    assert row[0] == pytest.approx(-3.788, abs=0.1) and row[1] == pytest.approx(9.443, abs=0.1) and row[2] == pytest.approx(23.44357, abs=1e-4)
    assert row[3] == pytest.approx(13 * 3600 + 10 * 60 + 46.1351, abs=0.02)


def test_images_near_the_sun_are_told_by_their_time(spark):
    ts = F.to_timestamp(F.lit("2000-03-20 07:35:00"))
    row = spark.range(1).select(im.bright_reason(F.lit(3.0), F.lit(2.0), 10.0, ts), im.bright_reason(F.lit(3.0), F.lit(2.0), 10.0), im.bright_reason(F.lit(183.0), F.lit(2.0), 5.0, ts), im.bright_reason(F.lit(3.0), F.lit(2.0), 10.0, F.lit(None).cast("timestamp"))).first()
    assert tuple(row) == ("Sun near", None, None, None)


def test_lofar_is_held_to_its_own_noise(spark):
    """High-band images against the theoretical noise, others against the range; integration time and bright bodies of LOFAR only."""
    columns = "telescope string, flat boolean, nan boolean, rms_qc double, beam_smaj_pix double, beam_smin_pix double, tau_time double, taustart_ts timestamp, centre_ra double, centre_decl double, freq_eff double, freq_bw double, antenna_set string, ncore double, nremote double, nintl double"
    from datetime import datetime

    at = datetime(2000, 3, 20, 7, 35)
    common = (False, False, 1.0, 3.0, 3.0)
    rows = [
        ("LOFAR", False, False, 10.0, 3.0, 3.0, 60.0, at, 60.0, 52.0, 150e6, 2e5, "HBA", 24.0, 9.0, 0.0),  # 10 Jy is far above its noise
        ("LOFAR", False, False, 1e-9, 3.0, 3.0, 60.0, at, 60.0, 52.0, 150e6, 2e5, "HBA", 24.0, 9.0, 0.0),
        ("LOFAR", *common, 60.0, at, 60.0, 52.0, 60e6, 2e5, "LBA", 24.0, 9.0, 0.0),  # not known for low-band
        ("LOFAR", *common, 0.0, at, 60.0, 52.0, 150e6, 2e5, "HBA", 24.0, 9.0, 0.0),
        ("LOFAR", *common, 60.0, at, 1.0, 1.0, 60e6, 2e5, None, None, None, None),
        ("other", *common, 0.0, at, 1.0, 1.0, 60e6, 2e5, None, None, None, None),
    ]
    found = [r[0] for r in spark.createDataFrame(rows, columns).coalesce(1).select(batch.reason(0.0, 100.0, 10.0)).collect()]
    assert found == ["rms too high", "rms too low", None, "tau_time is 0", "Sun near", None]
