import math
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from skyloom.functions import statistics as st
from skyloom.operators import association as a
from skyloom.operators import lightcurves as lc
from skyloom.plans.state import Snapshots

ARC = 1 / 3600


def shots(spark, rows):
    """rows: (xtrsrc, ra, decl, flux)"""
    return spark.createDataFrame([Row(xtrsrc=i, ra=float(ra), decl=float(d), uew=10 * ARC, uns=10 * ARC, band="b", stokes=1, f_peak=float(f), f_peak_err=0.1, f_int=float(f), f_int_err=0.1) for i, ra, d, f in rows], "xtrsrc long, ra double, decl double, uew double, uns double, band string, stokes int, f_peak double, f_peak_err double, f_int double, f_int_err double")


def step(state, spark, rows, **k):
    return a.associate(state, shots(spark, rows), 0.05, **k)


def types(state):
    return sorted((r.runcat, r.xtrsrc, r.type) for r in state.assoc.collect())


def test_one_to_one_follows_the_weighted_mean(spark):
    s = step(a.State.new(spark), spark, [(1, 120, 30, 5.0)])
    s = step(s, spark, [(2, 120 + 4 * ARC, 30, 7.0)])
    s = step(s, spark, [(3, 120 + 8 * ARC, 30, 6.0)])
    assert types(s) == [(1, 1, 4), (1, 2, 3), (1, 3, 3)]
    r = s.runcat.collect()
    assert len(r) == 1 and r[0].datapoints == 3 and r[0].wm_ra == pytest.approx(120 + 4 * ARC) and r[0].wm_uew == pytest.approx(10 * ARC / math.sqrt(3))
    f = s.flux.first()
    assert f.f_datapoints == 3 and f.avg_f_int == pytest.approx(6) and f.avg_f_int_sq == pytest.approx((25 + 49 + 36) / 3)
    last = {x.xtrsrc: x for x in s.assoc.collect()}[3]
    assert last.v_int == pytest.approx(np.std([5, 7, 6], ddof=1) / 6) and last.eta_int == pytest.approx(2 / 2 / 0.01)


def test_one_to_many_forks_with_history(spark):
    s = step(a.State.new(spark), spark, [(1, 50, 10, 5.0)])
    s = step(s, spark, [(2, 50, 10 + 3 * ARC, 5.0), (3, 50, 10 - 3 * ARC, 5.0)])
    assert types(s) == [(2, 1, 6), (2, 2, 2), (3, 1, 6), (3, 3, 2)]
    assert sorted(r.runcat for r in s.runcat.collect()) == [2, 3] and all(r.datapoints == 2 for r in s.runcat.collect())
    assert sorted((r.runcat, r.f_datapoints) for r in s.flux.collect()) == [(2, 2), (3, 2)]


def test_datasets_taken_together_never_link(spark):
    apart = lambda *rows: shots(spark, rows).withColumn("dataset", F.col("xtrsrc") % 2)
    s = a.associate(a.State.new(spark), apart((2, 50, 10, 5.0), (3, 50, 10, 6.0)), 0.05)
    s = a.associate(s, apart((4, 50, 10, 5.0), (5, 50, 10, 6.0), (7, 50, 10 + ARC, 6.0)), 0.05)
    assert types(s) == [(2, 2, 4), (2, 4, 3), (5, 3, 6), (5, 5, 2), (7, 3, 6), (7, 7, 2)]
    assert sorted((r.runcat, r.dataset) for r in s.runcat.collect()) == [(2, 0), (5, 1), (7, 1)]


def test_many_to_one(spark):
    s = step(a.State.new(spark), spark, [(1, 50, 10 + 5 * ARC, 5.0), (2, 50, 10 - 5 * ARC, 5.0)])
    s = step(s, spark, [(3, 50, 10, 5.0)])
    assert types(s) == [(1, 1, 4), (1, 3, 3), (2, 2, 4), (2, 3, 3)]


def test_many_to_many_keeps_the_nearest(spark):
    s = step(a.State.new(spark), spark, [(1, 50, 10 + 6 * ARC, 5.0), (2, 50, 10 - 6 * ARC, 5.0)])
    s = step(s, spark, [(3, 50, 10 + 7 * ARC, 5.0), (4, 50, 10 - 7 * ARC, 5.0)])
    assert types(s) == [(1, 1, 4), (1, 3, 3), (2, 2, 4), (2, 4, 3)]


def test_rhombus_is_an_error(spark):
    s = step(a.State.new(spark), spark, [(1, 50, 5 * ARC, 5.0), (2, 50, -5 * ARC, 5.0)])
    with pytest.raises(ValueError, match="more than one source"):
        step(s, spark, [(3, 50 + 5 * ARC, 0, 5.0), (4, 50 - 5 * ARC, 0, 5.0)])


def test_new_sources_and_fields(spark):
    regions = spark.createDataFrame([(1, 50.0, 10.0, 5.0), (2, 52.0, 10.0, 5.0), (3, 120.0, 10.0, 5.0)], "skyrgn long, centre_ra double, centre_decl double, xtr_radius double")
    limits = spark.createDataFrame([(70, 1, 1.0, 4.0), (71, 2, 2.0, 9.0), (72, 3, 0.1, 0.2)], "image long, skyrgn long, low double, high double")
    s = step(a.State.new(spark), spark, [(1, 50, 10, 5.0), (2, 51, 10, 3.0), (3, 51, 11, 0.5)], skyrgn=1, regions=regions, limits=limits)
    assert sorted((r.runcat, r.newsource_type, r.previous_limits_image) for r in s.newsource.collect()) == [(1, 1, 70), (2, 0, 70)]
    assert sorted((r.runcat, r.skyrgn, r.distance_deg is None) for r in s.skyrgn.collect()) == [(i, k, k == 1) for i in (1, 2, 3) for k in (1, 2)]


def test_null_detections_expire_and_reset(spark):
    s = step(a.State.new(spark), spark, [(1, 50, 10, 5.0)], skyrgn=1)
    none = s.runcat.select("runcat").limit(0)
    for i in range(2):
        assert a.null_detections(s.runcat, none, s.skyrgn, 1, expiration=2).count() == 1
        s = a.associate_forced(s, shots(spark, [(10 + i, 50, 10, 0.1)]).selectExpr("*", "1L AS runcat"))
    assert a.null_detections(s.runcat, none, s.skyrgn, 1, expiration=2).count() == 0
    assert s.runcat.first().datapoints == 1 and s.flux.first().f_datapoints == 3 and [t for *_, t in types(s)] == [4, 7, 7]
    assert step(s, spark, [(20, 50, 10, 5.0)]).runcat.first().forcedfits_count == 0


def test_a_source_of_this_time_step_is_no_null_detection(spark):
    s = step(a.State.new(spark), spark, [(1, 50, 10, 5.0), (2, 60, 10, 5.0)], skyrgn=1)
    founded = spark.sql("SELECT 1L AS runcat, TIMESTAMP '2024-01-01' AS ts UNION ALL SELECT 2L, TIMESTAMP '2024-01-02'")
    lost = a.null_detections(s.runcat, s.runcat.select("runcat").limit(0), s.skyrgn, 1, founded=founded, ts=datetime(2024, 1, 2))
    assert [r.runcat for r in lost.collect()] == [1]


def test_cells_lose_no_pair(spark):
    """The cell join against a plain product, over poles, right ascension 0, and radii from small to very large."""
    rng = np.random.default_rng(3)
    spots = [(i, float(ra), float(d)) for i, (ra, d) in enumerate(zip(rng.uniform(0, 360, 400), np.degrees(np.arcsin(rng.uniform(-1, 1, 400))), strict=True))]
    spots += [(900, 0.0, 0.0), (901, 359.999, 0.0), (902, 0.001, 89.95), (903, 180.0, -90.0), (904, 360.0, 45.0)]
    fields = [(1, 0.0, 0.0, 3.0), (2, 359.5, 44.0, 2.0), (3, 10.0, 89.0, 4.0), (4, 200.0, -88.0, 20.0), (5, 120.0, 30.0, 60.0), (6, 0.0005, 0.0, 0.01)]
    near = spark.createDataFrame(fields, "skyrgn long, centre_ra double, centre_decl double, xtr_radius double")
    got = {(r.runcat, r.skyrgn) for r in a.memberships(spark.createDataFrame(spots, "runcat long, ra double, decl double"), near).collect()}
    unit = lambda ra, d: np.array([np.cos(np.radians(d)) * np.cos(np.radians(ra)), np.cos(np.radians(d)) * np.sin(np.radians(ra)), np.sin(np.radians(d))])
    want = {(i, k) for i, ra, d in spots for k, cr, cd, radius in fields if np.degrees(2 * np.arcsin(np.linalg.norm(unit(ra, d) - unit(cr, cd)) / 2)) < radius}
    assert got == want and len(want) > 60


def test_monitored_positions_stay_out_of_blind_association(spark):
    fit = lambda i, run: shots(spark, [(i, 50, 10, 1.0)]).selectExpr("*", f"CAST({run} AS LONG) AS runcat")
    s = a.associate_monitored(a.State.new(spark), fit(1, "NULL"))
    s = a.associate_monitored(s, fit(2, "1"))
    assert types(s) == [(1, 1, 8), (1, 2, 9)] and s.runcat.first().datapoints == 2 and s.runcat.first().mon_src
    assert sorted(r.runcat for r in step(s, spark, [(3, 50, 10, 5.0)]).runcat.collect()) == [1, 3]


@pytest.mark.parametrize(("first", "second"), [(359.9999, 0.0001), (0.0001, 359.9999), (0.0, 0.0)])
def test_across_the_meridian(spark, first, second):
    s = step(a.State.new(spark), spark, [(1, first, 10, 5.0)], across=True)
    s = step(s, spark, [(2, second, 10, 5.0)], across=True)
    r = s.runcat.collect()
    assert len(r) == 1 and min(r[0].wm_ra, 360 - r[0].wm_ra) == pytest.approx(0, abs=1e-6) and 0 <= r[0].wm_ra < 360


def test_zone_join_is_the_theta_join(spark):
    rng = np.random.default_rng(1)
    near = shots(spark, [(i, 40 + x, 9.5 + y, 1.0) for i, (x, y) in enumerate(rng.random((60, 2)))])
    far = a._founded(shots(spark, [(1000 + i, 40 + x, 9.5 + y, 1.0) for i, (x, y) in enumerate(rng.random((80, 2)))]), 1).drop("zone", "x", "y", "z")
    got = {(r.runcat, r.xtrsrc) for r in a.candidates(near, far, 0.2, 1e9).collect()}
    want = set()
    for p in near.collect():
        for q in far.collect():
            c = math.sin(math.radians(p.decl)) * math.sin(math.radians(q.wm_decl)) + math.cos(math.radians(p.decl)) * math.cos(math.radians(q.wm_decl)) * math.cos(math.radians(p.ra - q.wm_ra))
            if math.degrees(math.acos(min(1, c))) < 0.2:
                want.add((q.runcat, p.xtrsrc))
    assert got == want and want


def test_prefix_windows_equal_the_iterated_state(spark):
    rng = np.random.default_rng(2)
    flux, err = rng.random(12) * 10, rng.random(12) + 0.1
    rows = spark.createDataFrame([(i, 1, "b", i, float(f), float(e)) for i, (f, e) in enumerate(zip(flux, err, strict=True))], "xtrsrc long, source long, band string, ts long, f_int double, f_int_err double")
    got = {r.xtrsrc: r for r in lc.running_metrics(rows).collect()}
    m = np.zeros(5)
    for n, (f, e) in enumerate(zip(flux, err, strict=True)):
        w = 1 / e**2
        m = (n * m + np.array([f, f * f, w, w * f, w * f * f])) / (n + 1)
        if n:
            assert got[n].v_int == pytest.approx(math.sqrt((n + 1) * (m[1] - m[0] ** 2) / n) / m[0])
            assert got[n].eta_int == pytest.approx((n + 1) / n * (m[2] * m[4] - m[3] ** 2) / m[2])


def test_constant_flux_does_not_vary(spark):
    from pyspark.sql import functions as F

    r = spark.range(1).select(st.v_int(F.lit(3), F.lit(2.0), F.lit(4.0)).alias("v"), st.v_int(F.lit(1), F.lit(2.0), F.lit(9.0)).alias("one"), st.eta_int(F.lit(1), F.lit(1.0), F.lit(1.0), F.lit(5.0)).alias("eta")).first()
    assert (r.v, r.one, r.eta) == (0, 0, 0)


def test_snapshots_publish_whole_versions(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path))
    assert store.version() == 0 and store.read("runningcatalog").count() == 0
    s = step(a.State.new(spark), spark, [(1, 50, 10, 5.0)])
    assert store.write({"runningcatalog": s.runcat, "assocxtrsource": s.assoc}) == 1
    assert store.read("runningcatalog").first().runcat == 1 and store.version() == 1


def test_variability_filters(spark):
    rows = spark.createDataFrame([(1, 10.0, 5.0, 0.5, 2.0, None), (2, 50.0, 5.0, 0.1, 9.0, 7)], "source long, wm_ra double, wm_decl double, v_int double, eta_int double, newsource long")
    assert lc.select_variables(rows, ra_range=(0, 20)).count() == 2
    assert lc.select_variables(rows, ra_range=(0, 20), decl_range=(0, 10)).count() == 1
    assert [r.source for r in lc.select_variables(rows, new_only=True).collect()] == [2]
    assert lc.select_variables(rows, v_int_min=0.2, eta_int_min=5).count() == 0


def test_entries_of_the_same_measurements_tie_in_any_order(spark):
    """Two sources at one place with the same measurements, one's rows in ascending order and the other's in descending."""
    from skyloom.plans import fixtures as fx

    one = [(0, 2 * i, 155.001 + (i * 7 % 11) * 0.002, 20.003 + (i % 3) * 0.002, (80 + i * 13 % 4 * 10) / 20000) for i in range(97)]
    rows = [(source, source * 1000 + x, ra, decl, u, u) for source, turn in ((0, 1), (2, -1)) for _, x, ra, decl, u in one[::turn]]
    m = spark.createDataFrame(rows, "source long, xtrsrc long, ra double, decl double, uew double, uns double").withColumn("day", F.lit("2024-01-02").cast("date")).coalesce(1)
    a_, b_ = fx.catalogue(m).drop("runcat").collect()
    assert a_ == b_


def test_pairs_of_one_place_are_made_by_many_tasks(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F

    from skyloom.plans import queries as q

    monkeypatch.setattr(a, "BLOCK", 64, raising=False)
    i = F.col("id")
    rows = spark.range(3150).select((i * 60).alias("event_id"), F.when(i < 150, 0).otherwise(i * 120).alias("user_id"), F.lit("view").alias("event_type"), F.when(i < 150, F.lit("2024-01-16 01:00:00")).otherwise(F.lit("2024-01-02 01:00:00")).cast("timestamp").alias("ts"), F.lit(1.0).alias("value"))
    rows.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    found = q.association_over_zero(spark, str(tmp_path)).withColumn("task", F.spark_partition_id())
    counts = [r["count"] for r in found.groupBy("task").count().collect()]
    assert sum(counts) == 150 * 3001 and max(counts) < 0.6 * sum(counts)
    once = found.select("runcat", "xtrsrc").distinct().count()
    assert once == sum(counts) and [tuple(r) for r in found.select("r", "new_wm_ra").distinct().collect()] == [(0.0, 359.996)]


def test_edges_kept_where_only_rounding_tells_sources_apart(spark, tmp_path):
    """Sources of one place, whose measurements repeat under other ids until two of them average to the very same position."""
    import duckdb

    from skyloom.plans import queries as q

    c = duckdb.connect()
    c.execute("SET threads = 1")
    c.execute("CREATE TABLE e AS SELECT * FROM '/root/testdata/sf0.1/events.parquet' WHERE user_id % 360 = 280")
    c.execute(f"COPY (SELECT e.* REPLACE (event_id + 100000 * k AS event_id) FROM e, range(60) r(k) ORDER BY k, event_id) TO '{tmp_path}/events.parquet' (FORMAT parquet)")
    c.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet'")
    for name in ("association_pruned", "association_types", "association_fluxes"):
        want = c.execute(q.ORACLE_SQL[name]).fetchall()
        assert sorted(tuple(r) for r in q.QUERIES[name](spark, str(tmp_path)).collect()) == sorted(want) and want


def test_sums_of_the_catalogue_follow_the_measurements(spark):
    from skyloom.plans import fixtures as fx

    rng = np.random.default_rng(5)
    rows = [(0, 2 * i, 200 + 0.002 * int(k), -20 + 0.002 * (i % 3), 0.0045 + 0.001 * int(w), 0.0045) for i, (k, w) in enumerate(zip(rng.integers(0, 5, 800), rng.integers(0, 2, 800), strict=True))]
    m = spark.createDataFrame(rows, "source long, xtrsrc long, ra double, decl double, uew double, uns double").withColumn("day", F.lit("2024-01-02").cast("date"))
    ra, u = np.array([r[2] for r in rows]), np.array([r[4] for r in rows])
    last = lambda x: np.cumsum(x)[-1]
    found = fx.catalogue(m.repartition(7, F.rand(1))).collect()
    assert [(r.wm_ra, r.wm_uew, r.datapoints) for r in found] == [(last(ra / (u * u)) / last(1 / (u * u)), np.sqrt(1 / last(1 / (u * u))), 800)]
