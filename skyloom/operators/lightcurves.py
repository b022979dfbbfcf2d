"""Lightcurves and variability metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyloom.functions import statistics as st


def lightcurve(assoc: DataFrame, measured: DataFrame, runcats: DataFrame | None = None) -> DataFrame:
    """Measurements of each source in time order, of the given sources only if there are any."""
    if runcats is not None:
        assoc = assoc.join(runcats, "runcat", "left_semi")
    return assoc.select("runcat", "xtrsrc").join(measured, "xtrsrc").select("runcat", "ts", "band", "stokes", "xtrsrc", "f_int", "f_int_err").orderBy("runcat", "ts", "xtrsrc")


def running_metrics(measured: DataFrame, by=("source", "band")) -> DataFrame:
    """V and eta of each lightcurve as of every datapoint: the averages are those of a prefix, so nothing is iterated."""
    so_far = Window.partitionBy(*by).orderBy("ts", "xtrsrc").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    means = measured.withColumns({"n": F.count("*").over(so_far), **st.flux_means(F.col("f_int"), F.col("f_int_err"), "f_int", so_far)})
    return means.withColumns({"v_int": st.v_int(F.col("n"), F.col("avg_f_int"), F.col("avg_f_int_sq")), "eta_int": st.eta_int(F.col("n"), F.col("avg_f_int_weight"), F.col("avg_weighted_f_int"), F.col("avg_weighted_f_int_sq"))})


def last_by_band(rows: DataFrame, key: str = "source", strict: bool = False) -> DataFrame:
    """Each source's last row in each band. strict: rows at any band's last time, as a join on (source, time) gives them."""
    if strict:
        last = rows.groupBy(key, "band").agg(F.max("ts").alias("ts")).select(key, "ts").distinct()
        return rows.join(last, [key, "ts"], "left_semi")
    last = rows.groupBy(key, "band").agg(F.max("ts").alias("ts"))
    return rows.join(last, [key, "band", "ts"], "left_semi")


def variability(rows: DataFrame, newsource: DataFrame | None = None, key: str = "source", strict: bool = False) -> DataFrame:
    """One row a source: the metrics of the band that is brightest at the last step, and that band's lightcurve summary.

    strict: every row with that flux in the source's history, which may give a source more than one row.
    """
    last = last_by_band(rows, key, strict)
    if strict:
        brightest = rows.join(last.groupBy(key).agg(F.max("f_int").alias("f_int")), [key, "f_int"], "left_semi").select(key, "band", "v_int", "eta_int")
    else:
        brightest = last.groupBy(key).agg(F.max_by(F.struct("band", "v_int", "eta_int"), F.struct("f_int", "xtrsrc")).alias("b")).select(key, "b.*")
    curve = rows.groupBy(key, "band").agg(F.max("f_int").alias("lightcurve_max"), F.avg("f_int").alias("lightcurve_avg"), F.median("f_int").alias("lightcurve_median"))
    out = brightest.join(curve, [key, "band"])
    if newsource is not None:
        out = out.join(newsource, key, "left")
    return out


def select_variables(metrics: DataFrame, ra_range=None, decl_range=None, v_int_min=None, eta_int_min=None, sigma_rms_min_range=None, sigma_rms_max_range=None, new_only: bool = False) -> DataFrame:
    """Composable filter; the two position ranges apply together or not at all."""
    tests = []
    if ra_range and decl_range:
        tests += [F.col("wm_ra").between(*ra_range), F.col("wm_decl").between(*decl_range)]
    tests += [F.col(c) >= least for c, least in (("v_int", v_int_min), ("eta_int", eta_int_min)) if least is not None]
    tests += [F.col(c).between(*r) for c, r in (("sigma_rms_min", sigma_rms_min_range), ("sigma_rms_max", sigma_rms_max_range)) if r]
    if new_only:
        tests.append(F.col("newsource").isNotNull())
    for t in tests:
        metrics = metrics.filter(t)
    return metrics


def trigger_significance(events: DataFrame, measured: DataFrame, images: DataFrame) -> DataFrame:
    """New-source events(source, trigger_xtrsrc, image) with the trigger's flux over the limit image's noise."""
    return events.join(measured.select(F.col("xtrsrc").alias("trigger_xtrsrc"), "f_int"), "trigger_xtrsrc").join(images, "image").withColumns({"sigma_rms_min": F.col("f_int") / F.nullif("rms_min", F.lit(0.0)), "sigma_rms_max": F.col("f_int") / F.nullif("rms_max", F.lit(0.0))}).select("source", F.col("trigger_xtrsrc").alias("newsource"), "sigma_rms_min", "sigma_rms_max")
