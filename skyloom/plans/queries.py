"""Queries over the sky tables derived from the driver's data, and DuckDB SQL with the same rows.

Every float is rounded; every order that matters has a unique tie-break.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyloom.functions import clock
from skyloom.functions import geometry as g
from skyloom.functions import statistics as st
from skyloom.functions import uncertain as u
from skyloom.operators import association as a
from skyloom.operators import images as im
from skyloom.operators import lightcurves as lc
from skyloom.plans import fixtures as fx
from skyloom.sources import fits, tables

RADIUS = 0.1
QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
M, SKY, CAT = fx.MEASUREMENT_SQL, fx.SKYREGION_SQL, fx.CATALOGUE_SQL


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def r(c, digits: int = 6):
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({c: F.round(c, d) for c, d in digits.items()})


# -- lightcurves ------------------------------------------------------------------------------------------------------

RUNNING = f"""m AS ({M}), s AS (SELECT *, COUNT(*) OVER w AS n, AVG(f_int) OVER w AS mean, AVG(f_int * f_int) OVER w AS mean2, AVG(1 / (f_int_err * f_int_err)) OVER w AS w0,
 AVG(f_int / (f_int_err * f_int_err)) OVER w AS w1, AVG(f_int * f_int / (f_int_err * f_int_err)) OVER w AS w2 FROM m WINDOW w AS (PARTITION BY source, band ORDER BY ts, xtrsrc ROWS UNBOUNDED PRECEDING)),
 v AS (SELECT *, CASE WHEN n = 1 THEN 0 WHEN ABS(mean2 - mean * mean) < 8e-14 THEN 0 ELSE SQRT(n * (mean2 - mean * mean) / (n - 1)) / mean END AS v_int,
 CASE WHEN n = 1 THEN 0 ELSE n / (n - 1) * (w0 * w2 - w1 * w1) / w0 END AS eta_int FROM s)"""


@query(f"WITH {RUNNING} SELECT xtrsrc, source, band, n, ROUND(v_int, 6) AS v_int, ROUND(eta_int, 6) AS eta_int FROM v")
def running_variability(spark, sf_dir):
    return rounded(lc.running_metrics(fx.measurements(spark, sf_dir)).select("xtrsrc", "source", "band", "n", "v_int", "eta_int"), v_int=6, eta_int=6)


BEST = f"""{RUNNING}, l AS (SELECT source, band, MAX(ts) AS ts FROM v GROUP BY ALL), b AS (SELECT v.*, ROW_NUMBER() OVER (PARTITION BY v.source ORDER BY f_int DESC, xtrsrc DESC) AS k FROM v JOIN l USING (source, band, ts)),
 c AS (SELECT source, band, MAX(f_int) AS lightcurve_max, AVG(f_int) AS lightcurve_avg, MEDIAN(f_int) AS lightcurve_median FROM v GROUP BY ALL),
 x AS (SELECT source, band, ROUND(v_int, 6) AS v_int, ROUND(eta_int, 4) AS eta_int, ROUND(lightcurve_max, 6) AS lightcurve_max, ROUND(lightcurve_avg, 6) AS lightcurve_avg, ROUND(lightcurve_median, 6) AS lightcurve_median FROM b JOIN c USING (source, band) WHERE k = 1)"""


@query(f"WITH {BEST} SELECT * FROM x")
def variability(spark, sf_dir):
    return rounded(lc.variability(lc.running_metrics(fx.measurements(spark, sf_dir))).select("source", "band", "v_int", "eta_int", "lightcurve_max", "lightcurve_avg", "lightcurve_median"), v_int=6, eta_int=4, lightcurve_max=6, lightcurve_avg=6, lightcurve_median=6)


@query(f"WITH {BEST} SELECT source, band, v_int, eta_int FROM x WHERE v_int >= 0.5 AND eta_int >= 1000")
def variable_sources(spark, sf_dir):
    return lc.select_variables(variability(spark, sf_dir), v_int_min=0.5, eta_int_min=1000).select("source", "band", "v_int", "eta_int")


@query(f"WITH {RUNNING}, l AS (SELECT DISTINCT source, ts FROM (SELECT source, band, MAX(ts) AS ts FROM v GROUP BY ALL)) SELECT v.source, v.band, v.xtrsrc FROM v JOIN l USING (source, ts)")
def last_associations_any_band(spark, sf_dir):
    return lc.last_by_band(lc.running_metrics(fx.measurements(spark, sf_dir)), strict=True).select("source", "band", "xtrsrc")


@query(f"WITH m AS ({M}) SELECT source AS runcat, ts, band, stokes, xtrsrc, f_int, f_int_err FROM m")
def lightcurve(spark, sf_dir):
    m = fx.measurements(spark, sf_dir)
    return lc.lightcurve(m.select(F.col("source").alias("runcat"), "xtrsrc"), m, m.select(F.col("source").alias("runcat")).distinct())


@query("SELECT user_id, event_type, COUNT(*) AS n, ROUND(MEDIAN(CASE WHEN event_id % 11 <> 0 THEN value END), 6) AS med FROM events GROUP BY ALL")
def median_with_nulls(spark, sf_dir):
    e = fx.read(spark, sf_dir, "events")
    return e.groupBy("user_id", "event_type").agg(F.count("*").alias("n"), r(F.median(F.when(F.col("event_id") % 11 != 0, F.col("value")))).alias("med"))


@query("SELECT l_returnflag AS band, l_partkey AS source, COUNT(*) AS n, ROUND(STDDEV_SAMP(l_extendedprice) / AVG(l_extendedprice), 6) AS v_int FROM lineitem GROUP BY ALL HAVING COUNT(*) > 1")
def parts_variability(spark, sf_dir):
    x = fx.read(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("band"), F.col("l_partkey").alias("source")).agg(F.count("*").alias("n"), F.avg("l_extendedprice").alias("m"), F.avg(F.col("l_extendedprice") * F.col("l_extendedprice")).alias("q"))
    return x.filter("n > 1").select("band", "source", "n", r(st.v_int(F.col("n"), F.col("m"), F.col("q"))).alias("v_int"))


@query("SELECT event_type AS band, ROUND(SUM(value * w) / SUM(w), 6) AS mean, ROUND(SQRT(1 / SUM(w)), 8) AS sigma_mean, ROUND(SQRT((SUM(w * value * value) - SUM(w * value) * SUM(w * value) / SUM(w)) * SUM(w) / (SUM(w) * SUM(w) - SUM(w * w))), 5) AS sigma FROM (SELECT *, 1 / ((1 + event_id % 5) * (1 + event_id % 5)) AS w FROM events) GROUP BY ALL")
def weighted_statistics(spark, sf_dir):
    e = fx.read(spark, sf_dir, "events").withColumn("w", 1 / ((1 + F.col("event_id") % 5) * (1 + F.col("event_id") % 5)))
    w = F.col("w")
    return e.groupBy(F.col("event_type").alias("band")).agg(r(st.weighted_mean(F.col("value"), w)).alias("mean"), r(st.weighted_mean_sigma(w), 8).alias("sigma_mean"), r(st.weighted_sigma(F.col("value"), w), 5).alias("sigma"))


@query("SELECT DISTINCT event_type AS band FROM events")
def frequency_bands(spark, sf_dir):
    return fx.read(spark, sf_dir, "events").select(F.col("event_type").alias("band")).distinct()


@query(f"WITH {RUNNING}, f AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY source, band ORDER BY ts DESC, xtrsrc DESC) AS k FROM v) SELECT source, band, n, ROUND(v_int, 6) AS v_int, ROUND(eta_int, 6) AS eta_int FROM f WHERE k = 1 AND v_int > 0.4")
def final_variability(spark, sf_dir):
    v = lc.running_metrics(fx.measurements(spark, sf_dir))
    k = F.row_number().over(Window.partitionBy("source", "band").orderBy(F.col("ts").desc(), F.col("xtrsrc").desc()))
    return rounded(v.withColumn("k", k).filter("k = 1 AND v_int > 0.4").select("source", "band", "n", "v_int", "eta_int"), v_int=6, eta_int=6)


# -- association ------------------------------------------------------------------------------------------------------


def _theta(across: bool = False) -> str:
    """The same candidates as a plain theta join."""
    turn = lambda x: f"CAST(CAST({x} + 180 AS DECIMAL(11,8)) % 360 AS DOUBLE)"
    dra = f"CASE WHEN c.wm_ra < 90 OR c.wm_ra > 270 THEN {turn('i.ra')} - {turn('c.wm_ra')} ELSE i.ra - c.wm_ra END" if across else "i.ra - c.wm_ra"
    alpha = f"CASE WHEN ABS(i.decl) + {RADIUS} > 89.9 THEN 180 ELSE DEGREES(ABS(ATAN(SIN(RADIANS({RADIUS})) / SQRT(ABS(COS(RADIANS(i.decl - {RADIUS})) * COS(RADIANS(i.decl + {RADIUS}))))))) END"
    box = "" if across else f" AND c.wm_ra BETWEEN i.ra - ({alpha}) AND i.ra + ({alpha})"
    return f"""m AS ({M}), c AS ({CAT}), i AS (SELECT * FROM m WHERE day = DATE '{fx.NEW_FROM}' AND band = 'view'),
 p AS (SELECT *, SQRT(dra * COS(RADIANS((decl + wm_decl) / 2)) * dra * COS(RADIANS((decl + wm_decl) / 2)) / (uew * uew + wm_uew * wm_uew) + (decl - wm_decl) * (decl - wm_decl) / (uns * uns + wm_uns * wm_uns)) AS r,
  SQRT((COS(RADIANS(decl)) * COS(RADIANS(ra)) - COS(RADIANS(wm_decl)) * COS(RADIANS(wm_ra))) ** 2 + (COS(RADIANS(decl)) * SIN(RADIANS(ra)) - COS(RADIANS(wm_decl)) * SIN(RADIANS(wm_ra))) ** 2 + (SIN(RADIANS(decl)) - SIN(RADIANS(wm_decl))) ** 2) AS chord
  FROM (SELECT i.*, c.*, {dra} AS dra FROM i, c WHERE ABS(c.wm_decl - i.decl) <= {RADIUS}{box})),
 e AS (SELECT *, 3600 * DEGREES(2 * ASIN(LEAST(1, chord / 2))) AS distance_arcsec, datapoints * avg_weight_ra + 1 / (uew * uew) AS wra, datapoints * avg_weight_decl + 1 / (uns * uns) AS wde FROM p WHERE r < {a.DE_RUITER} AND 1 - chord * chord / 2 > COS(RADIANS({RADIUS}))),
 q AS (SELECT *, COUNT(*) OVER (PARTITION BY runcat) > 1 AND COUNT(*) OVER (PARTITION BY xtrsrc) > 1 AS many FROM e),
 k AS (SELECT *, NOT many OR r <= MIN(CASE WHEN many THEN r END) OVER (PARTITION BY xtrsrc) AS kept FROM q)"""


def _edges(spark, sf_dir, across: bool = False) -> DataFrame:
    m = fx.measurements(spark, sf_dir)
    return a.candidates(fx.new_image(m), fx.catalogue(m), RADIUS, across=across)


@query(f"WITH {_theta()} SELECT runcat, xtrsrc, ROUND(r, 5) AS r, ROUND(distance_arcsec, 4) AS distance_arcsec, ROUND((datapoints * avg_wra + ra / (uew * uew)) / wra, 6) AS new_wm_ra, ROUND((datapoints * avg_wdecl + decl / (uns * uns)) / wde, 6) AS new_wm_decl, ROUND(SQRT(1 / wra), 8) AS new_wm_uew FROM e")
def association_candidates(spark, sf_dir):
    return rounded(_edges(spark, sf_dir).select("runcat", "xtrsrc", "r", "distance_arcsec", "new_wm_ra", "new_wm_decl", "new_wm_uew"), r=5, distance_arcsec=4, new_wm_ra=6, new_wm_decl=6, new_wm_uew=8)


@query(f"WITH {_theta(True)} SELECT runcat, xtrsrc, ROUND(r, 4) AS r, ROUND(wra / (datapoints + 1), 2) AS new_avg_weight_ra FROM e")
def association_candidates_meridian(spark, sf_dir):
    return rounded(_edges(spark, sf_dir, True).select("runcat", "xtrsrc", "r", "new_avg_weight_ra"), r=4, new_avg_weight_ra=2)


@query(f"WITH {_theta()} SELECT runcat, xtrsrc, kept FROM k")
def association_pruned(spark, sf_dir):
    return a.prune(_edges(spark, sf_dir)).select("runcat", "xtrsrc", "kept")


@query(f"WITH {_theta()}, t AS (SELECT runcat, xtrsrc, CASE WHEN COUNT(*) OVER (PARTITION BY runcat) > 1 THEN 2 ELSE 3 END AS type FROM k WHERE kept) SELECT runcat, xtrsrc, type FROM t")
def association_types(spark, sf_dir):
    return a.classify(a.prune(_edges(spark, sf_dir))).select("runcat", "xtrsrc", F.col("type").cast("int"))


FLUX = "SELECT runcat, band, stokes, COUNT(*) AS n, AVG(f_int) AS a1, AVG(f_int * f_int) AS a2, AVG(1 / (f_int_err * f_int_err)) AS w0, AVG(f_int / (f_int_err * f_int_err)) AS w1, AVG(f_int * f_int / (f_int_err * f_int_err)) AS w2 FROM (SELECT *, MIN(xtrsrc) OVER (PARTITION BY source, xtrsrc % 2) AS runcat FROM m WHERE day < DATE '" + fx.NEW_FROM + "') GROUP BY ALL"


@query(f"""WITH {_theta()}, f AS ({FLUX}), t AS (SELECT k.runcat, k.xtrsrc, k.band, f_int, 1 / (f_int_err * f_int_err) AS w, COALESCE(n, 0) AS n, COALESCE(a1, 0) AS a1, COALESCE(a2, 0) AS a2, COALESCE(w0, 0) AS w0, COALESCE(w1, 0) AS w1, COALESCE(w2, 0) AS w2 FROM k LEFT JOIN f ON k.runcat = f.runcat AND k.band = f.band AND k.stokes = f.stokes WHERE kept),
 y AS (SELECT runcat, xtrsrc, n + 1 AS f_datapoints, (n * a1 + f_int) / (n + 1) AS b1, (n * a2 + f_int * f_int) / (n + 1) AS b2, (n * w0 + w) / (n + 1) AS c0, (n * w1 + w * f_int) / (n + 1) AS c1, (n * w2 + w * f_int * f_int) / (n + 1) AS c2 FROM t)
 SELECT runcat, xtrsrc, f_datapoints, ROUND(b1, 5) AS avg_f_int, ROUND(CASE WHEN f_datapoints = 1 OR ABS(b2 - b1 * b1) < 8e-14 THEN 0 ELSE SQRT(f_datapoints * (b2 - b1 * b1) / (f_datapoints - 1)) / b1 END, 5) AS v_int, ROUND(CASE WHEN f_datapoints = 1 THEN 0 ELSE f_datapoints * (c0 * c2 - c1 * c1) / c0 / (f_datapoints - 1) END, 3) AS eta_int FROM y""")
def association_fluxes(spark, sf_dir):
    m = fx.measurements(spark, sf_dir)
    old = m.filter(F.col("day") < F.lit(fx.NEW_FROM).cast("date")).withColumn("runcat", F.min("xtrsrc").over(Window.partitionBy("source", F.col("xtrsrc") % 2)))
    means = {**st.flux_means(F.col("f_int"), F.col("f_int_err"), "f_int"), **st.flux_means(F.col("f_peak"), F.col("f_peak_err"), "f_peak")}
    flux = old.groupBy("runcat", "band", "stokes").agg(F.count("*").alias("f_datapoints"), *(v.alias(k) for k, v in means.items()))
    after = a.metrics(a.flux_after(a.classify(a.prune(_edges(spark, sf_dir))), flux))
    return rounded(after.select("runcat", "xtrsrc", "f_datapoints", "avg_f_int", "v_int", "eta_int"), avg_f_int=5, v_int=5, eta_int=3)


@query(f"WITH {_theta()} SELECT xtrsrc, source FROM i WHERE xtrsrc NOT IN (SELECT xtrsrc FROM e WHERE runcat % 3 = 0)")
def unmatched_measurements(spark, sf_dir):
    m = fx.measurements(spark, sf_dir)
    return a.unmatched(fx.new_image(m), _edges(spark, sf_dir).filter("runcat % 3 = 0")).select("xtrsrc", "source")


LIMITS = f"""m AS ({M}), g AS (SELECT day, band, DATEDIFF('day', DATE '2024-01-01', day) * 10 + LENGTH(band) AS image, AVG(f_int) / 50 AS rms_min, AVG(f_int) / 20 AS rms_max FROM m GROUP BY ALL),
 n AS (SELECT * FROM m WHERE day = DATE '{fx.NEW_FROM}'), j AS (SELECT n.xtrsrc, n.f_peak, g.image, g.rms_min * 9 AS low, g.rms_max * 9 AS high FROM n JOIN g ON n.band = g.band AND g.day < n.day),
 b AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY xtrsrc ORDER BY low, high, image) AS k FROM j)"""


@query(f"WITH {LIMITS} SELECT xtrsrc AS runcat, xtrsrc AS trigger_xtrsrc, image AS previous_limits_image, CAST(CASE WHEN f_peak > high THEN 1 ELSE 0 END AS INTEGER) AS newsource_type FROM b WHERE k = 1 AND f_peak > low")
def new_source_events(spark, sf_dir):
    m = fx.measurements(spark, sf_dir)
    g_ = m.groupBy("day", "band").agg(F.avg("f_int").alias("x")).select("day", "band", (F.datediff("day", F.lit("2024-01-01").cast("date")) * 10 + F.length("band")).cast("long").alias("image"), (F.col("x") / 50 * 9).alias("low"), (F.col("x") / 20 * 9).alias("high"))
    n = m.filter(F.col("day") == F.lit(fx.NEW_FROM).cast("date"))
    pairs = n.join(g_.withColumnRenamed("day", "before"), "band").filter(F.col("before") < F.col("day"))
    return a.new_sources(a.best_limits(pairs.select("xtrsrc", "f_peak", "image", "low", "high")))


SPOTS = f"m AS ({M}), s AS ({SKY}), o AS (SELECT source AS runcat, MIN(ra) AS ra, MIN(decl) AS decl FROM m GROUP BY ALL)"
CHORD = "SQRT((COS(RADIANS(decl)) * COS(RADIANS(ra)) - COS(RADIANS(centre_decl)) * COS(RADIANS(centre_ra))) ** 2 + (COS(RADIANS(decl)) * SIN(RADIANS(ra)) - COS(RADIANS(centre_decl)) * SIN(RADIANS(centre_ra))) ** 2 + (SIN(RADIANS(decl)) - SIN(RADIANS(centre_decl))) ** 2)"


def _spots(spark, sf_dir) -> DataFrame:
    return fx.measurements(spark, sf_dir).groupBy(F.col("source").alias("runcat")).agg(F.min("ra").alias("ra"), F.min("decl").alias("decl"))


@query(f"WITH {SPOTS}, d AS (SELECT runcat, skyrgn, DEGREES(2 * ASIN({CHORD} / 2)) AS d, xtr_radius FROM o, s) SELECT runcat, CAST(skyrgn AS BIGINT) AS skyrgn, ROUND(d, 6) AS distance_deg FROM d WHERE d < xtr_radius")
def region_memberships(spark, sf_dir):
    return rounded(a.memberships(_spots(spark, sf_dir), fx.skyregions(spark, sf_dir)).select("runcat", F.col("skyrgn").cast("long"), "distance_deg"), distance_deg=6)


@query(f"WITH {SPOTS}, l AS (SELECT runcat, ra, decl FROM o, s WHERE DEGREES(2 * ASIN({CHORD} / 2)) < xtr_radius AND skyrgn = 3) SELECT runcat, ROUND(ra, 6) AS wm_ra, ROUND(decl, 6) AS wm_decl FROM l WHERE runcat NOT IN (SELECT source FROM m WHERE day = DATE '{fx.NEW_FROM}') AND runcat % 12 < 10")
def null_detections(spark, sf_dir):
    m = fx.measurements(spark, sf_dir)
    spots = _spots(spark, sf_dir)
    links = a.memberships(spots, fx.skyregions(spark, sf_dir))
    sources = spots.select("runcat", F.col("ra").alias("wm_ra"), F.col("decl").alias("wm_decl"), (F.col("runcat") % 12).alias("forcedfits_count"), F.lit(False).alias("mon_src"))
    seen = m.filter(F.col("day") == F.lit(fx.NEW_FROM).cast("date")).select(F.col("source").alias("runcat")).distinct()
    return rounded(a.null_detections(sources, seen, links, 3), wm_ra=6, wm_decl=6)


@query("WITH x AS (SELECT CAST(c_nationkey % 5 AS DOUBLE) AS centre_ra, CAST(c_nationkey % 3 AS DOUBLE) AS centre_decl FROM customer), k AS (SELECT DISTINCT centre_ra, centre_decl, CAST(5 AS DOUBLE) AS xtr_radius FROM x WHERE NOT (centre_ra = 0 AND centre_decl = 0)) SELECT CAST(1 AS BIGINT) AS skyrgn, CAST(0 AS DOUBLE) AS centre_ra, CAST(0 AS DOUBLE) AS centre_decl, CAST(5 AS DOUBLE) AS xtr_radius UNION ALL SELECT ROW_NUMBER() OVER (ORDER BY centre_ra, centre_decl, xtr_radius) + 1, centre_ra, centre_decl, xtr_radius FROM k")
def regions_get_or_create(spark, sf_dir):
    c = fx.read(spark, sf_dir, "customer").select((F.col("c_nationkey") % 5).cast("double").alias("centre_ra"), (F.col("c_nationkey") % 3).cast("double").alias("centre_decl"), F.lit(5.0).alias("xtr_radius"))
    there = spark.range(1).select(F.lit(1).cast("long").alias("skyrgn"), F.lit(0.0).alias("centre_ra"), F.lit(0.0).alias("centre_decl"), F.lit(5.0).alias("xtr_radius"))
    return im.get_or_create_regions(c, there)


@query(f"WITH m AS ({M}), q AS (SELECT xtrsrc % 7 AS id, source % 5 AS image, CAST(FLOOR(decl) AS INTEGER) % 3 AS zone FROM m) SELECT 'id' AS problem, COUNT(*) AS n FROM q WHERE id = 0 UNION ALL SELECT 'image', COUNT(*) FROM q WHERE image = 0 UNION ALL SELECT 'all', COUNT(*) FROM q WHERE id = 0 AND image = 0 AND zone = 0")
def consistency(spark, sf_dir):
    q = fx.measurements(spark, sf_dir).select((F.col("xtrsrc") % 7).alias("id"), (F.col("source") % 5).alias("image"), (g.zone(F.col("decl")) % 3).alias("zone"))
    return a.inconsistencies(q, "id", "image", "zone")


@query(f"WITH m AS ({M}), t AS (SELECT source, MIN(xtrsrc) AS newsource FROM m GROUP BY ALL) SELECT t.source, t.newsource, ROUND(f_int / (1 + t.source % 5), 6) AS sigma_rms_min, ROUND(f_int / (2 + t.source % 5), 6) AS sigma_rms_max FROM t JOIN m ON m.xtrsrc = t.newsource")
def trigger_significance(spark, sf_dir):
    m = fx.measurements(spark, sf_dir)
    events = m.groupBy("source").agg(F.min("xtrsrc").alias("trigger_xtrsrc")).withColumn("image", F.col("source") % 5)
    noise = spark.range(5).select(F.col("id").alias("image"), (F.col("id") + 1.0).alias("rms_min"), (F.col("id") + 2.0).alias("rms_max"))
    return rounded(lc.trigger_significance(events, m, noise), sigma_rms_min=6, sigma_rms_max=6)


# -- images -----------------------------------------------------------------------------------------------------------


@query("SELECT CAST(o_orderdate AS DATE) AS ts, STRING_AGG(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_custkey, CAST(o_orderkey AS VARCHAR)) AS urls FROM orders GROUP BY 1")
def group_per_timestep(spark, sf_dir):
    o = fx.read(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("ts"), F.col("o_custkey").alias("freq_eff"), F.col("o_orderkey").cast("string").alias("url"))
    return im.group_per_timestep(o).select("ts", F.array_join("urls", ",").alias("urls"))


@query("""WITH x AS (SELECT l_suppkey AS station, DATEDIFF('day', DATE '1990-01-01', CAST(l_shipdate AS DATE)) AS s, DATEDIFF('day', DATE '1990-01-01', CAST(l_shipdate AS DATE)) + CAST(l_quantity AS BIGINT) AS e FROM lineitem),
 y AS (SELECT *, MAX(e) OVER (PARTITION BY station ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM x), z AS (SELECT *, SUM(CASE WHEN p IS NULL OR s > p THEN 1 ELSE 0 END) OVER (PARTITION BY station ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM y)
 SELECT station, CAST(SUM(len) AS BIGINT) AS covered FROM (SELECT station, island, MAX(e) - MIN(s) AS len FROM z GROUP BY ALL) GROUP BY station""")
def covered_time(spark, sf_dir):
    day = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1990-01-01").cast("date")).cast("long")
    x = fx.read(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("station"), day.alias("s"), (day + F.col("l_quantity").cast("long")).alias("e"))
    return im.union_length(x, "station", "s", "e").select("station", F.col("covered").cast("long"))


BANDS = "SELECT r_regionkey AS band, CAST(r_regionkey * 100 + 20 AS DOUBLE) AS lo, CAST(r_regionkey * 100 + 90 AS DOUBLE) AS hi FROM region"


@query(f"WITH b AS ({BANDS}), i AS (SELECT s_suppkey AS image, CAST(s_suppkey % 500 AS DOUBLE) AS f FROM supplier) SELECT image, f AS freq_eff, MIN(band) AS band FROM i LEFT JOIN b ON GREATEST(f + 5, hi) - LEAST(f - 5, lo) < 10 + hi - lo GROUP BY image, f")
def overlapping_bands(spark, sf_dir):
    b = fx.read(spark, sf_dir, "region").select(F.col("r_regionkey").alias("band"), (F.col("r_regionkey") * 100 + 20).cast("double").alias("freq_low"), (F.col("r_regionkey") * 100 + 90).cast("double").alias("freq_high"))
    i = fx.read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("image"), (F.col("s_suppkey") % 500).cast("double").alias("freq_eff"), F.lit(10.0).alias("freq_bw"))
    return im.overlapping_band(i, b).select("image", "freq_eff", "band")


IMAGES = f"m AS ({M}), g AS (SELECT DATEDIFF('day', DATE '2024-01-01', day) * 10 + LENGTH(band) AS image, band, day AS ts, ROUND(AVG(f_int) / 50, 9) AS rms_qc FROM m GROUP BY day, band)"


def _images(spark, sf_dir) -> DataFrame:
    return fx.measurements(spark, sf_dir).groupBy("day", "band").agg(F.round(F.avg("f_int") / 50, 9).alias("rms_qc")).select((F.datediff("day", F.lit("2024-01-01").cast("date")) * 10 + F.length("band")).cast("long").alias("image"), "band", F.col("day").alias("ts"), "rms_qc")


@query(f"WITH {IMAGES}, n AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY band ORDER BY ts DESC, image DESC) AS k FROM g), s AS (SELECT band, COUNT(*) AS c, AVG(rms_qc) AS mu, STDDEV_POP(rms_qc) AS sd FROM n WHERE k <= 20 GROUP BY band) SELECT n.band, n.image, c >= 20 AND ABS(rms_qc - mu) > 1.0 * sd AS rejected FROM n JOIN s USING (band) WHERE k = 1")
def historical_rms(spark, sf_dir):
    return im.historical_rms(_images(spark, sf_dir), 20, 1.0)


@query(f"WITH {IMAGES}, b AS (SELECT *, CAST(image % 40 AS DOUBLE) AS smaj, CAST(image % 7 AS DOUBLE) / 2 AS smin FROM g) SELECT image, band, COALESCE(CASE WHEN NOT (rms_qc > 3 AND rms_qc < 6) THEN 'rms outside range' END, CASE WHEN smaj * 2 <= 1 OR smin * 2 <= 1 THEN 'beam undersampled' WHEN smaj > 30 OR smin > 30 THEN 'beam oversampled' WHEN smaj / smin > 2 THEN 'beam elliptical' END) AS reason FROM b")
def quality_reasons(spark, sf_dir):
    b = _images(spark, sf_dir).withColumns({"smaj": (F.col("image") % 40).cast("double"), "smin": (F.col("image") % 7).cast("double") / 2})
    return b.select("image", "band", im.first_reason(im.rms_reason(F.col("rms_qc"), 3, 6), im.beam_reason(F.col("smaj"), F.col("smin"))).alias("reason"))


@query("WITH p AS (SELECT vec_id AS image, UNNEST(embedding) AS v FROM embeddings) SELECT image, CASE WHEN BOOL_OR(ISNAN(v)) THEN 'contains nan' WHEN MIN(v) = MAX(v) THEN 'flat image' END AS reason FROM p GROUP BY image")
def pixel_reasons(spark, sf_dir):
    p = fx.read(spark, sf_dir, "embeddings")
    return p.select(F.col("vec_id").alias("image"), im.first_reason(im.nan_reason(F.col("embedding")), im.flat_reason(F.col("embedding"))).alias("reason"))


@query("WITH p AS (SELECT vec_id AS image, CAST(UNNEST(embedding) AS DOUBLE) AS v, GENERATE_SUBSCRIPTS(embedding, 1) - 1 AS k FROM embeddings), q AS (SELECT image, SUM(v) AS total, SUM((k // 8) * v) / SUM(v) AS x, SUM((k % 8) * v) / SUM(v) AS y FROM (SELECT image, ABS(v) AS v, k FROM p) GROUP BY image) SELECT image, ROUND(total, 6) AS total, ROUND(x, 6) AS xbar, ROUND(y, 6) AS ybar FROM q")
def image_moments(spark, sf_dir):
    from skyloom.imaging import frames

    p = fx.read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("image"), F.lit(8).alias("ny"), F.transform("embedding", lambda v: F.abs(v.cast("double"))).alias("pixels"))
    return rounded(frames.image_moments(p).select("image", "total", "xbar", "ybar"), total=6, xbar=6, ybar=6)


@query("WITH p AS (SELECT label, CAST(vec_id AS DOUBLE) AS f, CAST(UNNEST(embedding) AS DOUBLE) AS v, GENERATE_SUBSCRIPTS(embedding, 1) - 1 AS k FROM embeddings), q AS (SELECT label, k, AVG(v) AS v, MIN(f) AS lo, MAX(f) AS hi FROM p GROUP BY ALL) SELECT label, MIN(lo) AS freq_low, MAX(hi) AS freq_high, ROUND(SUM(v), 6) AS total, ROUND(MAX(v), 6) AS peak FROM q GROUP BY label")
def combined_images(spark, sf_dir):
    from skyloom.imaging import frames

    p = fx.read(spark, sf_dir, "embeddings").select("label", F.col("vec_id").cast("double").alias("freq_eff"), F.transform("embedding", lambda v: v.cast("double")).alias("pixels"))
    c = frames.combined(p, "label")
    return c.select("label", "freq_low", "freq_high", r(F.aggregate("pixels", F.lit(0.0), lambda s, x: s + x)).alias("total"), r(F.array_max("pixels")).alias("peak"))


@query("SELECT vec_id AS image, ROUND(LIST_MAX(LIST_TRANSFORM([19, 20, 21, 27, 28, 29, 35, 36, 37], lambda i: CAST(embedding[i] AS DOUBLE))), 6) AS flux FROM embeddings")
def flux_at_pixel(spark, sf_dir):
    from skyloom.imaging import frames

    p = fx.read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("image"), F.lit(8).alias("nx"), F.lit(8).alias("ny"), F.transform("embedding", lambda v: v.cast("double")).alias("pixels"))
    return frames.flux_at(p, p.select("image", F.lit(0).cast("long").alias("id"), F.lit(3).alias("x"), F.lit(3).alias("y"))).select("image", r("flux").alias("flux"))


@query()
def clipped_rms(spark, sf_dir):
    from skyloom.imaging import frames

    p = fx.read(spark, sf_dir, "embeddings").filter("embedding is not null").select(F.col("vec_id").alias("image"), F.lit(8).alias("nx"), F.lit(8).alias("ny"), F.transform("embedding", lambda v: v.cast("double")).alias("pixels"))
    return rounded(frames.clipped_rms(p), rms=9)


@query()
def extracted_sources(spark, sf_dir):
    """Each vector's 64 values as weak structure under a planted source, found again."""
    from skyloom.imaging import frames

    def pixel(pos):
        x, y = (pos / 32).cast("int"), pos % 32
        bump = 60 * F.exp(-((x - 15) * (x - 15) + (y - 17) * (y - 17)) / 6.0)
        return (F.element_at("embedding", (pos * 37 % 64 + 1).cast("int")) * 5 + bump).cast("double")

    images = fx.read(spark, sf_dir, "embeddings").filter("embedding is not null").select(F.col("vec_id").alias("image"), F.lit(32).alias("nx"), F.lit(32).alias("ny"), F.transform(F.sequence(F.lit(0), F.lit(1023)), pixel).alias("pixels"))
    found = frames.extract(images, (2.0, 2.0, 0.0), tile=(16, 16))
    return found.select("image", "n", r("x", 3).alias("x"), r("y", 3).alias("y"), r("peak", 2).alias("peak"))


@query(f"WITH s AS ({SKY}) SELECT skyrgn, ROUND(a, 6) AS alpha, centre_ra - a < 0 OR centre_ra + a > 360 AS across FROM (SELECT *, CASE WHEN ABS(centre_decl) + xtr_radius > 89.9 THEN 180 ELSE DEGREES(ABS(ATAN(SIN(RADIANS(xtr_radius)) / SQRT(ABS(COS(RADIANS(centre_decl - xtr_radius)) * COS(RADIANS(centre_decl + xtr_radius))))))) END AS a FROM s)")
def meridian_fields(spark, sf_dir):
    s = fx.skyregions(spark, sf_dir)
    return s.select("skyrgn", r(g.alpha_inflate(F.col("xtr_radius"), F.col("centre_decl"))).alias("alpha"), a.crosses_meridian(F.col("centre_ra"), F.col("centre_decl"), F.col("xtr_radius")).alias("across"))


@query("WITH x AS (SELECT s_suppkey AS station, CAST(30 + s_suppkey % 5 AS DOUBLE) AS d, 1.3 * (299792458.0 / 60e6) / (30 + s_suppkey % 5) AS w FROM supplier) SELECT station, ROUND(w, 8) AS fwhm, ROUND(PI() * w * w / 4, 8) AS fov FROM x")
def station_beams(spark, sf_dir):
    w = im.fwhm(F.lit(im.C / 60e6), (30 + F.col("s_suppkey") % 5).cast("double"))
    return fx.read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("station"), r(w, 8).alias("fwhm"), r(im.field_of_view(w), 8).alias("fov"))


@query("WITH x AS (SELECT s_suppkey AS station, 120e6 + (s_suppkey % 100) * 1e6 AS f, CAST(20 + s_suppkey % 9 AS DOUBLE) AS nc, CAST(10 + s_suppkey % 5 AS DOUBLE) AS nr FROM supplier), y AS (SELECT *, 299792458.0 / f AS w FROM x), z AS (SELECT *, LEAST(w * w / 3, 1.5625) AS a, 60 * w ** 2.55 + 200 AS t FROM y), s AS (SELECT *, 2 * 1.380649e-23 / (a * 16 * 24) * t * 1e26 AS c, 2 * 1.380649e-23 / (a * 16 * 48) * t * 1e26 AS q FROM z) SELECT station, ROUND(1e6 / SQRT(4 * 195312.5 * 60 * (nc * (nc - 1) / 2 / (c * c) + nr * (nr - 1) / 2 / (q * q) + nc * nr / (c * q))), 3) AS noise_microjansky FROM s")
def theoretical_noise(spark, sf_dir):
    f = 120e6 + (F.col("s_suppkey") % 100) * 1e6
    area = im.dipole_area(f)
    n = im.noise_level(f, F.lit(195312.5), F.lit(60.0), ((20 + F.col("s_suppkey") % 9).cast("double"), (10 + F.col("s_suppkey") % 5).cast("double"), F.lit(0.0)), (area * 16 * 24, area * 16 * 48, area * 16 * 96))
    return fx.read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("station"), r(n * 1e6, 3).alias("noise_microjansky"))


@query("WITH x AS (SELECT s_nationkey AS station, s_suppkey AS antenna, CAST(s_suppkey % 13 AS DOUBLE) AS x, CAST(s_suppkey % 17 AS DOUBLE) AS y, CAST(s_suppkey % 5 AS DOUBLE) AS z FROM supplier) SELECT a.station, a.antenna, ROUND(MIN(SQRT((a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2)), 6) AS distance FROM x a JOIN x b ON a.station = b.station AND a.antenna <> b.antenna GROUP BY ALL")
def nearest_antennas(spark, sf_dir):
    s = fx.read(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("station"), F.col("s_suppkey").alias("antenna"), *((F.col("s_suppkey") % n).cast("double").alias(c) for c, n in (("x", 13), ("y", 17), ("z", 5))))
    return rounded(im.nearest_neighbour(s), distance=6)


@query(f"WITH m AS ({M}) SELECT source, ROUND(MIN(ra), 6) AS ra FROM m WHERE 3 < 4 AND (DEGREES(ACOS(LEAST(1, GREATEST(-1, SIN(RADIANS(decl)) * SIN(RADIANS(40.733916)) + COS(RADIANS(decl)) * COS(RADIANS(40.733916)) * COS(RADIANS(ra - 299.868153)))))) < 10 OR DEGREES(ACOS(LEAST(1, GREATEST(-1, SIN(RADIANS(decl)) * SIN(RADIANS(58.811778)) + COS(RADIANS(decl)) * COS(RADIANS(58.811778)) * COS(RADIANS(ra - 350.866417)))))) < 10 OR DEGREES(ACOS(LEAST(1, GREATEST(-1, SIN(RADIANS(decl)) * SIN(RADIANS(12.391123)) + COS(RADIANS(decl)) * COS(RADIANS(12.391123)) * COS(RADIANS(ra - 187.705930)))))) < 10 OR DEGREES(ACOS(LEAST(1, GREATEST(-1, SIN(RADIANS(decl)) * SIN(RADIANS(22.014500)) + COS(RADIANS(decl)) * COS(RADIANS(22.014500)) * COS(RADIANS(ra - 83.633083)))))) < 10 OR DEGREES(ACOS(LEAST(1, GREATEST(-1, SIN(RADIANS(decl)) * SIN(RADIANS(4.992561)) + COS(RADIANS(decl)) * COS(RADIANS(4.992561)) * COS(RADIANS(ra - 252.783433)))))) < 10) GROUP BY source")
def near_bright_sources(spark, sf_dir):
    return fx.measurements(spark, sf_dir).filter(im.bright_reason(F.col("ra"), F.col("decl")).isNotNull()).groupBy("source").agg(r(F.min("ra")).alias("ra"))


# -- scalar functions -------------------------------------------------------------------------------------------------


@query(f"WITH m AS ({M}) SELECT xtrsrc, CAST(FLOOR(decl) AS INTEGER) AS zone, ROUND(COS(RADIANS(decl)) * COS(RADIANS(ra)), 9) AS x, ROUND(COS(RADIANS(decl)) * SIN(RADIANS(ra)), 9) AS y, ROUND(SIN(RADIANS(decl)), 9) AS z, ROUND(3600 * DEGREES(ACOS(LEAST(1, GREATEST(-1, SIN(RADIANS(decl)) * SIN(RADIANS(10)) + COS(RADIANS(decl)) * COS(RADIANS(10)) * COS(RADIANS(ra - 180)))))), 2) AS angsep, ROUND(3600 * (ra - 180) * COS(RADIANS((decl + 10) / 2)), 3) AS alphasep, ROUND(3600 * (decl - 10), 4) AS deltasep FROM m")
def positions(spark, sf_dir):
    ra, d = F.col("ra"), F.col("decl")
    x, y, z = g.cartesian(ra, d)
    c, t = F.lit(180.0), F.lit(10.0)
    return fx.measurements(spark, sf_dir).select("xtrsrc", g.zone(d).alias("zone"), r(x, 9).alias("x"), r(y, 9).alias("y"), r(z, 9).alias("z"), r(g.angsep_arcsec(ra, d, c, t), 2).alias("angsep"), r(g.alphasep_arcsec(ra, c, d, t), 3).alias("alphasep"), r(g.deltasep_arcsec(d, t), 4).alias("deltasep"))


@query(f"WITH m AS ({M}), p AS (SELECT xtrsrc, ra, decl, COS(RADIANS(decl)) * SIN(RADIANS(ra - 180)) AS l, SIN(RADIANS(decl)) * COS(RADIANS(30)) - COS(RADIANS(decl)) * SIN(RADIANS(30)) * COS(RADIANS(ra - 180)) AS m FROM m WHERE ra BETWEEN 140 AND 220 AND decl BETWEEN 0 AND 60) SELECT xtrsrc, ROUND(l, 8) AS l, ROUND(m, 8) AS m, ROUND(ra, 6) AS ra, ROUND(decl, 6) AS decl FROM p")
def direction_cosines(spark, sf_dir):
    m = fx.measurements(spark, sf_dir).filter("ra BETWEEN 140 AND 220 AND decl BETWEEN 0 AND 60")
    l, q, _ = g.radec_to_lmn(F.radians(F.lit(180.0)), F.radians(F.lit(30.0)), F.radians("ra"), F.radians("decl"))
    p = m.select("xtrsrc", l.alias("l"), q.alias("m"))
    return p.select("xtrsrc", r("l", 8).alias("l"), r("m", 8).alias("m"), r(g.lm_alpha(F.col("l"), F.col("m"), F.lit(180.0), F.lit(30.0))).alias("ra"), r(g.lm_delta(F.col("l"), F.col("m"), F.lit(30.0))).alias("decl"))


@query(f"WITH m AS ({M}) SELECT xtrsrc, CAST(FLOOR(ra / 15) AS INTEGER) AS h, CAST(FLOOR((ra / 15 - FLOOR(ra / 15)) * 60) AS INTEGER) AS hm, CAST(CASE WHEN decl < 0 THEN -1 ELSE 1 END AS INTEGER) AS sign, CAST(FLOOR(ABS(decl)) AS INTEGER) AS d, ROUND(ra, 6) AS ra, ROUND(decl, 6) AS decl FROM m")
def sexagesimal(spark, sf_dir):
    m = fx.measurements(spark, sf_dir).withColumns({"t": clock.ra_to_hms(F.col("ra")), "q": clock.decl_to_dms(F.col("decl"))})
    sign = F.col("q.sign")
    back = clock.dms_to_decl(sign * F.col("q.d"), sign * F.col("q.m"), sign * F.col("q.s"))
    return m.select("xtrsrc", F.col("t.h").alias("h"), F.col("t.m").alias("hm"), sign.alias("sign"), F.col("q.d").alias("d"), r(clock.hms_to_ra(F.col("t.h"), F.col("t.m"), F.col("t.s"))).alias("ra"), r(back).alias("decl"))


@query("WITH e AS (SELECT event_id, EPOCH_US(ts) / 86400e6 + 40587 AS mjd FROM events), t AS (SELECT *, (mjd - 51544.5) / 36525 AS c, 280.46061837 + 360.98564736629 * (mjd - 51544.5) AS s FROM e), u AS (SELECT *, s + 0.000387933 * c * c - c * c * c / 38710000 + 6.9 AS v FROM t) SELECT event_id, ROUND(mjd, 8) AS mjd, ROUND(mjd + 2400000.5, 5) AS jd, ROUND(v - 360 * FLOOR(v / 360), 4) AS lst FROM u")
def times(spark, sf_dir):
    day = clock.mjd(F.col("ts"))
    return fx.read(spark, sf_dir, "events").select("event_id", r(day, 8).alias("mjd"), r(clock.julian_date(F.col("ts")), 5).alias("jd"), r(clock.sidereal_degrees(day, F.lit(6.9)), 4).alias("lst"))


def _rotate_sql(m, lon="ra", lat="decl"):
    v = [f"COS(RADIANS({lat})) * COS(RADIANS({lon}))", f"COS(RADIANS({lat})) * SIN(RADIANS({lon}))", f"SIN(RADIANS({lat}))"]
    return [" + ".join(f"({m[i][j]!r}) * {v[j]}" for j in range(3)) for i in range(3)]


_GX, _GY, _GZ = _rotate_sql(g.TO_GALACTIC)
_JX, _JY, _JZ = _rotate_sql(g.TO_J2000)


@query(f"WITH m AS ({M}), v AS (SELECT xtrsrc, DEGREES(ATAN2({_GY}, {_GX})) AS l, DEGREES(ASIN({_GZ})) AS b, DEGREES(ATAN2({_JY}, {_JX})) AS a, DEGREES(ASIN({_JZ})) AS d FROM m) SELECT xtrsrc, ROUND(CASE WHEN l < 0 THEN l + 360 ELSE l END, 6) AS gal_l, ROUND(b, 6) AS gal_b, ROUND(CASE WHEN a < 0 THEN a + 360 ELSE a END, 6) AS ra_j2000, ROUND(d, 6) AS decl_j2000 FROM v")
def frames_of_reference(spark, sf_dir):
    lon, lat = g.eq_to_gal(F.col("ra"), F.col("decl"))
    ra, d = g.b1950_to_j2000(F.col("ra"), F.col("decl"))
    return fx.measurements(spark, sf_dir).select("xtrsrc", r(lon).alias("gal_l"), r(lat).alias("gal_b"), r(ra).alias("ra_j2000"), r(d).alias("decl_j2000"))


WCS_SQL = f"""m AS ({M}), p AS (SELECT *, COS(RADIANS(decl)) * SIN(RADIANS(ra - 180)) AS l, SIN(RADIANS(decl)) * COS(RADIANS(30)) - COS(RADIANS(decl)) * SIN(RADIANS(30)) * COS(RADIANS(ra - 180)) AS q,
 SIN(RADIANS(decl)) * SIN(RADIANS(30)) + COS(RADIANS(decl)) * COS(RADIANS(30)) * COS(RADIANS(ra - 180)) AS n FROM m WHERE ra BETWEEN 170 AND 190 AND decl BETWEEN 20 AND 40), t AS (SELECT *, DEGREES(l / n) AS u, DEGREES(q / n) AS v FROM p)"""


@query(f"WITH {WCS_SQL} SELECT xtrsrc, ROUND((u * COS(RADIANS(12)) + v * SIN(RADIANS(12))) / -0.02 + 512, 4) AS x, ROUND((v * COS(RADIANS(12)) - u * SIN(RADIANS(12))) / 0.02 + 512, 4) AS y, ROUND(ra, 5) AS ra, ROUND(decl, 5) AS decl FROM t")
def wcs_round_trip(spark, sf_dir):
    w = {"crpix1": F.lit(512.0), "crpix2": F.lit(512.0), "crval1": F.lit(180.0), "crval2": F.lit(30.0), "cdelt1": F.lit(-0.02), "cdelt2": F.lit(0.02), "crota2": F.lit(12.0)}
    m = fx.measurements(spark, sf_dir).filter("ra BETWEEN 170 AND 190 AND decl BETWEEN 20 AND 40")
    x, y = g.pixel_of_sky(F.col("ra"), F.col("decl"), w, "TAN")
    p = m.select("xtrsrc", x.alias("x"), y.alias("y"))
    ra, d = g.sky_of_pixel(F.col("x"), F.col("y"), w, "TAN")
    return p.select("xtrsrc", r("x", 4).alias("x"), r("y", 4).alias("y"), r(ra, 5).alias("ra"), r(d, 5).alias("decl"))


@query("WITH e AS (SELECT event_id, EPOCH_US(ts) / 86400e6 + 40587 AS mjd, CAST(user_id % 360 AS DOUBLE) AS ra, CAST(user_id % 80 AS DOUBLE) AS decl FROM events), t AS (SELECT *, (mjd - 51544.5) / 36525 AS c FROM e), u AS (SELECT *, RADIANS(280.46061837 + 360.98564736629 * (mjd - 51544.5) + 0.000387933 * c * c - c * c * c / 38710000 + 6.9 - ra) AS h, RADIANS(decl) AS d, RADIANS(52.9) AS p FROM t) SELECT event_id, ROUND(DEGREES(ASIN(SIN(d) * SIN(p) + COS(d) * COS(p) * COS(h))), 4) AS alt, ROUND(SIN(d) * COS(p) - COS(d) * SIN(p) * COS(h), 6) AS north, ROUND(-COS(d) * SIN(h), 6) AS east FROM u")
def horizontal_positions(spark, sf_dir):
    alt, az = clock.altaz(clock.mjd(F.col("ts")), (F.col("user_id") % 360).cast("double"), (F.col("user_id") % 80).cast("double"), F.lit(52.9), F.lit(6.9))
    e = fx.read(spark, sf_dir, "events").select("event_id", alt.alias("alt"), az.alias("az"))
    return e.select("event_id", r("alt", 4).alias("alt"), r(F.cos(F.radians("alt")) * F.cos(F.radians("az"))).alias("north"), r(F.cos(F.radians("alt")) * F.sin(F.radians("az"))).alias("east"))


@query("SELECT event_id, ROUND(value * EXP(-LN(2) * (((COS(0.3) * (event_id % 7 - 3) + SIN(0.3) * (event_id % 5 - 2)) / 2) ** 2 + ((COS(0.3) * (event_id % 5 - 2) - SIN(0.3) * (event_id % 7 - 3)) / 3) ** 2)), 6) AS flux FROM events")
def gaussian_profile(spark, sf_dir):
    k, d = F.col("event_id"), lambda x: F.lit(float(x))
    return fx.read(spark, sf_dir, "events").select("event_id", r(g.gaussian(F.col("value"), d(3), d(2), d(3), d(2), d(0.3), (k % 7).cast("double"), (k % 5).cast("double"))).alias("flux"))


@query("SELECT event_id, CASE WHEN value < (1 + event_id % 9) * 10 * 0.8 THEN 'rms too low' WHEN value > (1 + event_id % 9) * 10 * 1.6 THEN 'rms too high' END AS reason FROM events")
def noise_reasons(spark, sf_dir):
    return fx.read(spark, sf_dir, "events").select("event_id", im.noise_reason(F.col("value"), (1 + F.col("event_id") % 9) * 10.0, 0.8, 1.6).alias("reason"))


@query("SELECT s_suppkey AS id, ROUND((2 + s_suppkey % 4) / 2.0 / SQRT((0.01 * SIN(RADIANS(s_suppkey % 90))) ** 2 + (0.02 * COS(RADIANS(s_suppkey % 90))) ** 2), 6) AS smaj, ROUND(1.5 / 2 / SQRT((0.01 * COS(RADIANS(s_suppkey % 90))) ** 2 + (0.02 * SIN(RADIANS(s_suppkey % 90))) ** 2), 6) AS smin, ROUND(RADIANS(s_suppkey % 90), 8) AS pa FROM supplier")
def beams_in_pixels(spark, sf_dir):
    k = F.col("s_suppkey")
    smaj, smin, pa = fits.beam_pixels((2.0 + k % 4), F.lit(1.5), (k % 90).cast("double"), F.lit(0.01), F.lit(0.02))
    return fx.read(spark, sf_dir, "supplier").select(k.alias("id"), r(smaj).alias("smaj"), r(smin).alias("smin"), r(pa, 8).alias("pa"))


@query("SELECT s_suppkey AS id, CASE WHEN s_suppkey % 3 > 0 THEN TIMESTAMP '2024-01-01 00:00:00' END AS start, CASE WHEN s_suppkey % 3 = 2 THEN CAST(60 + s_suppkey % 60 AS DOUBLE) ELSE 0 END AS tau FROM supplier")
def observation_times(spark, sf_dir):
    k = F.col("s_suppkey")
    end = F.concat(F.lit("2024-01-01T00:01:"), F.lpad((k % 60).cast("string"), 2, "0"))
    h = F.when(k % 3 == 0, F.create_map(F.lit("OBJECT"), F.lit("x"))).when(k % 3 == 1, F.create_map(F.lit("DATE-OBS"), F.lit("2024-01-01T00:00:00; a comment"))).otherwise(F.create_map(F.lit("DATE-OBS"), F.lit("2024-01-01T00:00:00"), F.lit("END_UTC"), end))
    s = fx.read(spark, sf_dir, "supplier").select(k.alias("id"), h.alias("h"))
    return s.select("id", fits.start_time(F.col("h")).cast("timestamp_ntz").alias("start"), fits.duration(F.col("h")).alias("tau"))


@query("WITH e AS (SELECT event_id, value AS a, 1 + event_id % 3 AS s, 2.0 + event_id % 5 AS b, 0.5 AS t FROM events) SELECT event_id, ROUND(a + b, 6) AS sum, ROUND(SQRT(s * s + t * t), 6) AS sum_err, ROUND(a * b, 6) AS product, ROUND(SQRT((s * b) ** 2 + (t * a) ** 2), 6) AS product_err, ROUND(a / b, 6) AS ratio, ROUND(SQRT((s / b) ** 2 + (t * a / (b * b)) ** 2), 6) AS ratio_err, ROUND(LN(b), 6) AS log, ROUND(t / b, 6) AS log_err FROM e")
def uncertain_values(spark, sf_dir):
    e = fx.read(spark, sf_dir, "events").select("event_id", u.uncertain(F.col("value"), 1 + F.col("event_id") % 3).alias("a"), u.uncertain(2.0 + F.col("event_id") % 5, 0.5).alias("b"))
    parts = {"sum": u.add(F.col("a"), F.col("b")), "product": u.multiply(F.col("a"), F.col("b")), "ratio": u.divide(F.col("a"), F.col("b")), "log": u.log(F.col("b"))}
    return e.select("event_id", *(r(v[f]).alias(k + s) for k, v in parts.items() for f, s in (("value", ""), ("error", "_err"))))


@query("WITH e AS (SELECT event_id, CASE WHEN event_id % 5 = 0 THEN CAST('Infinity' AS DOUBLE) WHEN event_id % 7 = 0 THEN CAST('NaN' AS DOUBLE) ELSE CAST(event_id AS DOUBLE) END AS v FROM events) SELECT event_id, CASE WHEN ISINF(v) THEN 'Infinity' WHEN ISNAN(v) THEN 'NaN' ELSE CAST(CAST(v AS BIGINT) AS VARCHAR) END AS inf, ROUND(CASE WHEN ISNAN(v) THEN 0 WHEN ISINF(v) THEN -1 ELSE v END, 6) AS nan FROM e")
def substituted(spark, sf_dir):
    e = F.col("event_id")
    v = F.when(e % 5 == 0, float("inf")).when(e % 7 == 0, float("nan")).otherwise(e.cast("double"))
    rows = fx.read(spark, sf_dir, "events").select("event_id", v.alias("v")).withColumns({"inf": st.substitute_inf(F.col("v")), "nan": st.substitute_nan(F.col("v"))})
    whole = F.when(F.col("inf").isin("Infinity", "NaN"), F.col("inf")).otherwise(F.col("inf").cast("double").cast("bigint").cast("string"))
    return rows.select("event_id", whole.alias("inf"), F.when(F.abs("nan") == float("inf"), -1.0).otherwise(F.round("nan", 6)).alias("nan"))


# -- tables and headers -----------------------------------------------------------------------------------------------


@query(f"WITH m AS ({M}), p AS (SELECT *, CASE WHEN xtrsrc % 13 = 0 THEN CAST(360 AS DOUBLE) ELSE CAST(10 AS DOUBLE) END AS er FROM m WHERE xtrsrc % 17 <> 0) SELECT xtrsrc, er AS error_radius, ROUND(SQRT(100 + er * er) / 3600, 9) AS uew, CAST(FLOOR(decl) AS INTEGER) AS zone, ROUND(ra * COS(RADIANS(decl)), 6) AS racosdecl, CAST(0 AS INTEGER) AS extract_type FROM p")
def prepared_measurements(spark, sf_dir):
    inf = float("inf")
    m = fx.measurements(spark, sf_dir).drop("uew", "uns").withColumns({
        "f_int_err": F.when(F.col("xtrsrc") % 17 == 0, inf).otherwise(F.col("f_int_err")), "error_radius": F.when(F.col("xtrsrc") % 13 == 0, inf).otherwise(10.0),
        "ew_sys_err": F.lit(10.0), "ns_sys_err": F.lit(10.0), "ra_fit_err": F.lit(0.001), "decl_fit_err": F.lit(0.001),
    })
    return rounded(tables.prepared(m).select("xtrsrc", "error_radius", "uew", "zone", "racosdecl", "extract_type"), uew=9, racosdecl=6)


@query("SELECT s_suppkey AS id, s_name AS label FROM supplier WHERE s_nationkey = 3")
def table_scan(spark, sf_dir):
    return tables.columns_from_table(fx.read(spark, sf_dir, "supplier"), ["s_suppkey", "s_name"], {"s_suppkey": "id", "s_name": "label"}, {"s_nationkey": 3}, "s_suppkey")


@query("SELECT s_suppkey, CASE WHEN s_nationkey = 3 THEN 'moved' ELSE s_name END AS s_name FROM supplier")
def table_update(spark, sf_dir):
    return tables.set_columns(fx.read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_name"), {"s_name": "moved"}, {"s_nationkey": 3}).select("s_suppkey", "s_name")


@query(f"WITH {IMAGES} SELECT image, band FROM g WHERE NOT (rms_qc > 5) OR image % 3 = 0")
def good_images(spark, sf_dir):
    i = _images(spark, sf_dir)
    bad = tables.reject(spark.createDataFrame([], "image long, rejectreason int, comment string"), i.filter("rms_qc > 5"), 0, "rms")
    return tables.good_images(i, tables.unreject(bad, i.filter("image % 3 = 0"))).select("image", "band")


@query("SELECT o_orderkey AS id, o_orderpriority AS description, CAST(ROW_NUMBER() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate, o_orderkey) - 1 AS INTEGER) AS rerun FROM orders")
def dataset_reruns(spark, sf_dir):
    o = fx.read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), "o_custkey", F.col("o_orderpriority").alias("description"), F.col("o_orderdate").alias("process_start_ts"))
    return tables.with_reruns(o, ("o_custkey", "description")).select("id", "description", "rerun")


@query("SELECT o_orderkey AS id, CASE WHEN o_orderkey = 7 THEN o_orderdate + INTERVAL 1 DAY END AS process_end_ts FROM orders")
def dataset_ended(spark, sf_dir):
    o = fx.read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), "o_orderdate", F.lit(None).cast("timestamp").alias("process_end_ts"))
    return tables.ended(o, 7, (F.col("o_orderdate") + F.expr("interval 1 day")).cast("timestamp")).select("id", F.col("process_end_ts").cast("timestamp_ntz"))


@query("SELECT 'image' AS name, COUNT(*) AS n FROM orders WHERE o_custkey % 3 <> 1 UNION ALL SELECT 'dataset', 2 UNION ALL SELECT 'rejection', COUNT(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_custkey % 3 <> 1 UNION ALL SELECT 'runningcatalog', COUNT(*) FROM customer WHERE c_custkey % 3 <> 1 UNION ALL SELECT 'newsource', COUNT(*) FROM orders WHERE o_custkey % 3 <> 1")
def dataset_deleted(spark, sf_dir):
    """Sets 0, 1, 2 of images (orders) and sources (customers): what is left without set 1."""
    o, c = fx.read(spark, sf_dir, "orders"), fx.read(spark, sf_dir, "customer")
    left = tables.without_dataset({
        "dataset": spark.range(3), "image": o.select(F.col("o_orderkey").alias("id"), (F.col("o_custkey") % 3).alias("dataset")), "rejection": fx.read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("image")),
        "runningcatalog": c.select(F.col("c_custkey").alias("runcat"), (F.col("c_custkey") % 3).alias("dataset")), "newsource": o.select(F.col("o_custkey").alias("runcat")),
    }, 1)
    out = None
    for name, df in left.items():
        one = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("SELECT ROW_NUMBER() OVER (ORDER BY ra, decl) AS id, ra, decl FROM (SELECT DISTINCT CAST(c_nationkey AS DOUBLE) AS ra, CAST(c_custkey % 4 AS DOUBLE) AS decl FROM customer)")
def monitors_stored(spark, sf_dir):
    c = fx.read(spark, sf_dir, "customer").select(F.col("c_nationkey").cast("double").alias("ra"), (F.col("c_custkey") % 4).cast("double").alias("decl"))
    return tables.monitor_rows(c).select("id", "ra", "decl")


@query("SELECT s_suppkey AS id, CAST(1 AS BIGINT) AS dataset, s_nationkey AS band, ROUND((2 + s_suppkey % 3) * 0.01, 8) AS rb_smaj, ROUND(1.5 * 0.01, 8) AS rb_smin, ROUND(DEGREES(CAST(s_suppkey % 3 AS DOUBLE)), 8) AS rb_pa FROM supplier")
def image_rows(spark, sf_dir):
    k = F.col("s_suppkey")
    i = fx.read(spark, sf_dir, "supplier").select(k.alias("image"), F.col("s_nationkey").alias("band"), F.lit(1).alias("skyrgn"), F.lit(300.0).alias("tau_time"), F.lit(6e7).alias("freq_eff"), F.lit(1e6).alias("freq_bw"), F.lit("2024-01-01").cast("timestamp").alias("taustart_ts"), (2.0 + k % 3).alias("beam_smaj_pix"), F.lit(1.5).alias("beam_smin_pix"), (k % 3).cast("double").alias("beam_pa_rad"), F.lit(-0.01).alias("deltax"), F.lit(0.01).alias("deltay"), F.lit(1.0).alias("rms_qc"), F.lit("x").alias("url"))
    return rounded(tables.image_rows(i).select("id", "dataset", "band", "rb_smaj", "rb_smin", "rb_pa"), rb_smaj=8, rb_smin=8, rb_pa=8)


@query("SELECT s_suppkey AS image, CASE WHEN s_suppkey % 3 = 0 THEN CAST(60000000 + s_suppkey AS DOUBLE) WHEN s_suppkey % 3 = 1 THEN CAST(70000000 AS DOUBLE) END AS freq_eff, CASE WHEN s_suppkey % 3 = 0 THEN 1e6 WHEN s_suppkey % 3 = 1 THEN CAST(195312.5 AS DOUBLE) END AS freq_bw, CASE WHEN s_suppkey % 2 = 0 THEN CAST(0.5 AS DOUBLE) ELSE CAST(0.25 AS DOUBLE) END AS bmaj FROM supplier")
def header_columns(spark, sf_dir):
    k = F.col("s_suppkey")
    first = F.when(k % 3 == 0, F.create_map(F.lit("RESTFRQ"), (60000000 + k).cast("string"))).when(k % 3 == 1, F.create_map(F.lit("CTYPE3"), F.lit("FREQ"), F.lit("CRVAL3"), F.lit("7.0E7"), F.lit("CDELT3"), F.lit("195312.5"))).otherwise(F.create_map(F.lit("OBJECT"), F.lit("x")))
    h = F.when(k % 2 == 0, F.map_concat(first, F.create_map(F.lit("BMAJ"), F.lit("0.5")))).otherwise(first)
    s = fx.read(spark, sf_dir, "supplier").select(k.alias("image"), h.alias("h"), F.lit("AIPS CLEAN BMAJ= 2.5E-01 BMIN= 1.0E-01 BPA= 12.0").alias("history"))
    f, w = fits.frequency(F.col("h"))
    return s.select("image", f.alias("freq_eff"), w.alias("freq_bw"), fits.beam_degrees(F.col("h"), F.col("history"))[0].alias("bmaj"))


@query("SELECT s_suppkey AS image, 'LOFAR' AS telescope, CASE WHEN s_suppkey % 2 = 0 THEN 'kept' ELSE 'HBA' END AS antenna FROM supplier")
def injected_headers(spark, sf_dir):
    k = F.col("s_suppkey")
    h = F.when(k % 2 == 0, F.create_map(F.lit("ANTENNA"), F.lit("kept"))).otherwise(F.create_map(F.lit("OBJECT"), F.lit("x")))
    s = fx.read(spark, sf_dir, "supplier").select(k.alias("image"), fits.inject(h, {"TELESCOP": "LOFAR", "ANTENNA": "HBA"}).alias("h"))
    return s.select("image", fits.text(F.col("h"), "TELESCOP").alias("telescope"), fits.text(F.col("h"), "ANTENNA").alias("antenna"))


@query(f"WITH m AS ({M}), w AS (SELECT *, ROW_NUMBER() OVER (ORDER BY SQRT((ra - 180) ** 2 + (decl - 10) ** 2), xtrsrc) AS k FROM m) SELECT xtrsrc FROM w WHERE k = 1")
def closest_object(spark, sf_dir):
    return tables.closest(fx.measurements(spark, sf_dir).select("xtrsrc", F.col("ra").alias("x"), F.col("decl").alias("y")), 180, 10).select("xtrsrc")


@query(f"WITH m AS ({M}) SELECT PRINTF('%.6f', ra) || ', ' || PRINTF('%.6f', decl) || ', ' || PRINTF('%.6f', CAST(xtrsrc AS DOUBLE)) || ', ' || PRINTF('%.6f', f_int) AS value FROM m")
def csv_text(spark, sf_dir):
    return tables.csv_lines(fx.measurements(spark, sf_dir).withColumn("id", F.col("xtrsrc").cast("double")), ("ra", "decl", "id", "f_int"))


@query(f"WITH m AS ({M}) SELECT CAST(xtrsrc AS VARCHAR) || ', POINT, ' || PRINTF('%.6f', ra) || ', ' || PRINTF('%.6f', decl) || ', ' || PRINTF('%.4e', f_int) AS value FROM m")
def sky_model_text(spark, sf_dir):
    return tables.sky_model_lines(fx.measurements(spark, sf_dir))


@query(f"WITH m AS ({M}) SELECT 'ellipse(' || PRINTF('%.6f', ra) || ', ' || PRINTF('%.6f', decl) || ', ' || PRINTF('%.4f', CAST(2 + xtrsrc % 3 AS DOUBLE)) || '\", ' || PRINTF('%.4f', CAST(1 AS DOUBLE)) || '\", ' || PRINTF('%.2f', CAST(xtrsrc % 180 AS DOUBLE)) || ')' AS value FROM m")
def region_text(spark, sf_dir):
    k = F.col("xtrsrc")
    return tables.region_lines(fx.measurements(spark, sf_dir).withColumns({"semimajor": (2 + k % 3).cast("double"), "semiminor": F.lit(1.0), "pa": (k % 180).cast("double")}))


@query(f"WITH m AS ({M}) SELECT PRINTF('%d: RA %.5f Dec %.5f, peak %.4f +- %.4f, flux %.4f +- %.4f, %.1f sigma', xtrsrc, ra, decl, f_peak, f_peak_err, f_int, f_int_err, CAST(xtrsrc % 90 AS DOUBLE) + 0.3) AS value FROM m")
def summary_text(spark, sf_dir):
    return tables.summary_lines(fx.measurements(spark, sf_dir).withColumn("det_sigma", (F.col("xtrsrc") % 90) + 0.3))


@query("SELECT c_custkey AS id, CAST(c_nationkey AS DOUBLE) AS ra, CAST(c_nationkey - 10 AS DOUBLE) AS decl FROM customer")
def monitor_positions(spark, sf_dir):
    k = F.col("c_nationkey")
    p = fx.read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.explode(tables.parse_positions(F.concat(F.lit("[["), k.cast("string"), F.lit(", "), (k - 10).cast("string"), F.lit("]]")))).alias("p"))
    return p.select("id", F.element_at("p", 1).alias("ra"), F.element_at("p", 2).alias("decl"))


@query(f"WITH m AS ({M}), s AS (SELECT xtrsrc, band, f_int / 30.0 AS z FROM m), k AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY band ORDER BY z DESC, xtrsrc) AS i, COUNT(*) OVER (PARTITION BY band) AS n, EXP(-z * z / 2) AS p FROM s) SELECT band, ROUND(MIN(z), 6) AS threshold, COUNT(*) AS accepted FROM k WHERE p <= 0.05 * i / n GROUP BY band")
def false_discovery(spark, sf_dir):
    w = Window.partitionBy("band")
    k = fx.measurements(spark, sf_dir).select("xtrsrc", "band", (F.col("f_int") / 30.0).alias("z")).withColumns({"i": F.row_number().over(w.orderBy(F.col("z").desc(), "xtrsrc")), "n": F.count("*").over(w), "p": F.exp(-F.col("z") * F.col("z") / 2)})
    return k.filter(F.col("p") <= 0.05 * F.col("i") / F.col("n")).groupBy("band").agg(r(F.min("z")).alias("threshold"), F.count("*").alias("accepted"))


# -- the state machine ------------------------------------------------------------------------------------------------

TURN = lambda x: f"CAST(CAST({x} + 180 AS DECIMAL(11,8)) % 360 AS DOUBLE)"
ZERO = f"""m AS ({M}), i AS (SELECT *, CAST((359996 + (xtrsrc % 5) * 2) % 360000 AS DOUBLE) / 1000 AS a FROM m WHERE day = DATE '{fx.NEW_FROM}'),
 c AS (SELECT source AS runcat, 1 + source % 3 AS n, CAST((359996 + (source % 5) * 2) % 360000 AS DOUBLE) / 1000 AS wa, MIN(decl) AS wd FROM m GROUP BY source),
 j AS (SELECT *, {TURN("a")} - {TURN("wa")} AS dra, n / (0.003 * 0.003) AS w0, 1 / (uew * uew) AS w FROM i, c WHERE ABS(decl - wd) <= {RADIUS}),
 k AS (SELECT *, SQRT((dra * COS(RADIANS((decl + wd) / 2))) ** 2 / (uew * uew + 0.003 * 0.003) + (decl - wd) ** 2 / (uns * uns + 0.003 * 0.003)) AS r FROM j),
 t AS (SELECT *, (w0 * {TURN("wa")} + w * {TURN("a")}) / (w0 + w) - 180 AS turned FROM k WHERE r < {a.DE_RUITER})"""


@query(f"WITH {ZERO}, u AS (SELECT *, CASE WHEN turned < 0 AND turned > -8e-14 THEN 0 WHEN turned < 0 THEN turned + 360 ELSE turned END AS wm FROM t) SELECT runcat, xtrsrc, ROUND(r, 4) AS r, ROUND(wm, 6) AS new_wm_ra, ROUND(wm * (w0 + w) / (n + 1), 2) AS new_avg_wra FROM u")
def association_over_zero(spark, sf_dir):
    """Sources and measurements on both sides of right ascension 0. Many share a place; a pair of places is judged once."""
    m = fx.measurements(spark, sf_dir)
    at = lambda c: ((359996 + (F.col(c) % 5) * 2) % 360000).cast("double") / 1000
    v = F.lit(0.003) * F.lit(0.003)
    cat = m.groupBy(F.col("source").alias("runcat")).agg(F.min("decl").alias("wm_decl")).withColumns({"datapoints": (1 + F.col("runcat") % 3).cast("long"), "wm_ra": at("runcat"), "wm_uew": F.lit(0.003), "wm_uns": F.lit(0.003), "avg_weight_ra": 1 / v, "avg_weight_decl": 1 / v, "avg_wra": at("runcat") / v, "avg_wdecl": F.col("wm_decl") / v})
    one = m.filter(F.col("day") == F.lit(fx.NEW_FROM).cast("date")).withColumn("ra", at("xtrsrc")).select("xtrsrc", "ra", "decl", "uew", "uns")
    edges = a.candidates(a.blocks(one, "xtrsrc"), a.blocks(cat, "runcat"), RADIUS, across=True)
    return a.unfolded(rounded(edges.select("runcat", "xtrsrc", "r", "new_wm_ra", "new_avg_wra"), r=4, new_wm_ra=6, new_avg_wra=2))


#: One image a week: a source's measurements of the week as one, their mean.
WEEKS = f"m AS ({M}), w AS (SELECT source, DATEDIFF('day', DATE '2024-01-01', day) // 7 AS week, MIN(xtrsrc) AS xtrsrc, AVG(ra) AS ra, AVG(decl) AS decl, AVG(f_int) AS f_int FROM m GROUP BY ALL)"


#: Places repeat after as many sources (MEASUREMENT); SQL keeps sources apart by id, so each turn of ids is a dataset.
TURN_OF_IDS = 360


def by_dataset(m: DataFrame) -> DataFrame:
    return m.withColumn("dataset", F.floor(F.col("source") / TURN_OF_IDS)).drop("source")


def _means(m: DataFrame, *by) -> DataFrame:
    """Measurements of groups, as means with fixed errors."""
    return m.groupBy(*by).agg(F.min("xtrsrc").alias("xtrsrc"), F.avg("ra").alias("ra"), F.avg("decl").alias("decl"), F.avg("f_int").alias("f_int"), F.avg("f_int").alias("f_peak")).withColumns({"band": F.lit("all"), "stokes": F.lit(1), "uew": F.lit(0.005), "uns": F.lit(0.005), "f_int_err": F.lit(2.0), "f_peak_err": F.lit(2.0)})


@query(f"WITH {WEEKS} SELECT ARG_MIN(xtrsrc, week) AS runcat, COUNT(*) AS datapoints, ROUND(AVG(ra), 6) AS wm_ra, ROUND(AVG(decl), 6) AS wm_decl, COUNT(*) AS f_datapoints, ROUND(AVG(f_int), 6) AS avg_f_int FROM w GROUP BY source")
def association_loop(spark, sf_dir):
    """All weeks, one image after the other, through the whole state machine."""
    m = _means(fx.measurements(spark, sf_dir), "source", F.floor(F.datediff("day", F.lit("2024-01-01").cast("date")) / 7).alias("week"))
    state = a.State.new(spark)
    for week in range(5):
        state = a.associate(state, by_dataset(m.filter(F.col("week") == week).drop("week")), RADIUS)
    both = state.runcat.join(state.flux.select("runcat", "f_datapoints", "avg_f_int"), "runcat")
    return rounded(both.select("runcat", "datapoints", "wm_ra", "wm_decl", "f_datapoints", "avg_f_int"), wm_ra=6, wm_decl=6, avg_f_int=6)


#: A source as one measurement, and as one for even and one for odd ids, apart in declination.
HALVES = f"m AS ({M}), one AS (SELECT source, MIN(xtrsrc) * 10 AS x1, AVG(decl) AS decl, AVG(f_int) AS f FROM m GROUP BY source), two AS (SELECT source, MIN(xtrsrc) * 10 + 1 AS x2, AVG(decl) + (xtrsrc % 2) / 100.0 AS decl, AVG(f_int) AS f, COUNT(*) OVER (PARTITION BY source) AS k FROM m GROUP BY source, xtrsrc % 2)"


def _halves(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    m = fx.measurements(spark, sf_dir)
    one = _means(m, "source").withColumn("xtrsrc", F.col("xtrsrc") * 10)
    two = _means(m, "source", (F.col("xtrsrc") % 2).alias("odd")).withColumns({"xtrsrc": F.col("xtrsrc") * 10 + 1, "decl": F.col("decl") + F.col("odd") / 100.0})
    return by_dataset(one), by_dataset(two.drop("odd"))


@query(f"WITH {HALVES} SELECT CASE WHEN k = 1 THEN x1 ELSE x2 END AS runcat, x1 AS xtrsrc, CASE WHEN k = 1 THEN 4 ELSE 6 END AS type FROM one JOIN two USING (source) UNION ALL SELECT CASE WHEN k = 1 THEN x1 ELSE x2 END, x2, CASE WHEN k = 1 THEN 3 ELSE 2 END FROM one JOIN two USING (source)")
def association_forks(spark, sf_dir):
    """One source, then two measurements of it: both become sources of their own, with its history."""
    one, two = _halves(spark, sf_dir)
    return a.associate(a.associate(a.State.new(spark), one, RADIUS), two, RADIUS).assoc.select("runcat", "xtrsrc", "type")


@query(f"WITH {HALVES} SELECT CASE WHEN k = 1 THEN x1 ELSE x2 END AS runcat, CAST(2 AS BIGINT) AS datapoints, ROUND((one.decl + two.decl) / 2, 6) AS wm_decl, CAST(2 AS BIGINT) AS f_datapoints, ROUND((one.f + two.f) / 2, 6) AS avg_f_int FROM one JOIN two USING (source)")
def association_forked_catalogue(spark, sf_dir):
    one, two = _halves(spark, sf_dir)
    state = a.associate(a.associate(a.State.new(spark), one, RADIUS), two, RADIUS)
    return rounded(state.runcat.join(state.flux.select("runcat", "f_datapoints", "avg_f_int"), "runcat").select("runcat", "datapoints", "wm_decl", "f_datapoints", "avg_f_int"), wm_decl=6, avg_f_int=6)


@query(f"WITH {HALVES} SELECT x2 AS runcat, x2 AS xtrsrc, 4 AS type FROM two UNION ALL SELECT x2, x1, 3 FROM one JOIN two USING (source)")
def association_merges(spark, sf_dir):
    """Two sources, then one measurement of both: each takes it."""
    one, two = _halves(spark, sf_dir)
    return a.associate(a.associate(a.State.new(spark), two, RADIUS), one, RADIUS).assoc.select("runcat", "xtrsrc", "type")


@query(f"WITH {HALVES} SELECT x1 AS runcat, CAST(1 AS BIGINT) AS datapoints, CAST(CASE WHEN source % 2 = 0 THEN 1 ELSE 0 END AS BIGINT) AS forcedfits_count, CAST(CASE WHEN source % 2 = 0 THEN 2 ELSE 1 END AS BIGINT) AS f_datapoints, ROUND(CASE WHEN source % 2 = 0 THEN (f + 1.5) / 2 ELSE f END, 6) AS avg_f_int, CASE WHEN source % 2 = 0 THEN 7 ELSE 4 END AS last_type FROM one")
def forced_associations(spark, sf_dir):
    """Forced fits of half of the sources: fluxes and counts grow, positions and datapoints do not."""
    m = fx.measurements(spark, sf_dir)
    one, _ = _halves(spark, sf_dir)
    state = a.associate(a.State.new(spark), one, RADIUS)
    again = m.filter("source % 2 = 0").groupBy("source").agg((F.min("xtrsrc") * 10).alias("runcat")).drop("source")
    fits_ = again.select("runcat", (F.col("runcat") + 5).alias("xtrsrc"), F.lit("all").alias("band"), F.lit(1).alias("stokes"), *(F.lit(v).alias(c) for c, v in (("f_peak", 1.5), ("f_int", 1.5), ("f_peak_err", 2.0), ("f_int_err", 2.0))))
    state = a.associate_forced(state, fits_)
    last = state.assoc.groupBy("runcat").agg(F.max_by("type", "xtrsrc").alias("last_type"))
    rows = state.runcat.select("runcat", "datapoints", "forcedfits_count").join(state.flux.select("runcat", "f_datapoints", "avg_f_int"), "runcat").join(last, "runcat")
    return rounded(rows, avg_f_int=6)


@query("SELECT CAST(c_custkey AS BIGINT) AS id, c_custkey * 10 AS runcat, CAST(2 AS BIGINT) AS datapoints, TRUE AS mon_src, ROUND(c_acctbal + 0.5, 6) AS avg_f_int, 8 AS first_type, 9 AS last_type FROM customer")
def monitored_associations(spark, sf_dir):
    """Two fits at every customer's place: the first founds the source and is linked back, the second extends it."""
    c = fx.read(spark, sf_dir, "customer")
    monitors = c.select(F.col("c_custkey").alias("id"), F.lit(None).cast("long").alias("runcat"))
    at = lambda k: c.select((F.col("c_custkey") * 10 + k).alias("xtrsrc"), F.col("c_custkey").alias("ff_monitor"), (F.col("c_nationkey") * 10.0).alias("ra"), F.lit(10.0).alias("decl"), F.lit(0.01).alias("uew"), F.lit(0.01).alias("uns"), F.lit("all").alias("band"), F.lit(1).alias("stokes"), *((F.col("c_acctbal") + k).alias(x) for x in ("f_peak", "f_int")), F.lit(1.0).alias("f_peak_err"), F.lit(1.0).alias("f_int_err"))
    state, first = a.State.new(spark), at(0)
    state = a.associate_monitored(state, first.join(monitors.select(F.col("id").alias("ff_monitor"), "runcat"), "ff_monitor"))
    monitors = a.linked_back(monitors, first)
    state = a.associate_monitored(state, at(1).join(monitors.select(F.col("id").alias("ff_monitor"), "runcat"), "ff_monitor"))
    ends = state.assoc.groupBy("runcat").agg(F.min_by("type", "xtrsrc").alias("first_type"), F.max_by("type", "xtrsrc").alias("last_type"))
    rows = monitors.join(state.runcat.select("runcat", "datapoints", "mon_src"), "runcat").join(state.flux.select("runcat", "avg_f_int"), "runcat").join(ends, "runcat")
    return rounded(rows, avg_f_int=6)


FIELDS = f"""{SPOTS}, w AS (SELECT source AS runcat, MIN(xtrsrc) AS xtrsrc, AVG(ra) AS ra, AVG(decl) AS decl, AVG(f_int) AS f_peak FROM m GROUP BY ALL),
 l AS (SELECT xtrsrc, f_peak, 3 AS skyrgn FROM w UNION ALL SELECT xtrsrc, f_peak, skyrgn FROM w, s WHERE skyrgn <> 3 AND DEGREES(2 * ASIN({CHORD} / 2)) < xtr_radius),
 g AS (SELECT n_nationkey * 10 + r_regionkey AS image, n_nationkey AS skyrgn, CAST(r_regionkey * 40 + n_nationkey % 3 AS DOUBLE) AS low, CAST(r_regionkey * 40 + 60 AS DOUBLE) AS high FROM nation, region),
 b AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY xtrsrc ORDER BY low, high, image) AS k FROM l JOIN g USING (skyrgn))"""


@query(f"WITH {FIELDS} SELECT xtrsrc AS runcat, xtrsrc AS trigger_xtrsrc, CAST(image AS BIGINT) AS previous_limits_image, CAST(CASE WHEN f_peak > high THEN 1 ELSE 0 END AS INTEGER) AS newsource_type FROM b WHERE k = 1 AND f_peak > low")
def new_sources_by_field(spark, sf_dir):
    """Sources that are not matched, against earlier images of every field that covers them, in the state machine."""
    m = _means(fx.measurements(spark, sf_dir), "source").drop("source")
    n, region = fx.read(spark, sf_dir, "nation"), fx.read(spark, sf_dir, "region")
    limits = n.crossJoin(region).select((F.col("n_nationkey") * 10 + F.col("r_regionkey")).cast("long").alias("image"), F.col("n_nationkey").cast("long").alias("skyrgn"), (F.col("r_regionkey") * 40 + F.col("n_nationkey") % 3).cast("double").alias("low"), (F.col("r_regionkey") * 40 + 60).cast("double").alias("high"))  # 25 by 5 rows
    return a.associate(a.State.new(spark), m, RADIUS, skyrgn=3, regions=fx.skyregions(spark, sf_dir), limits=limits).newsource.select("runcat", "trigger_xtrsrc", "previous_limits_image", "newsource_type")
