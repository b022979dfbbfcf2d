"""Images to catalogue, time step by time step: read, check, extract, associate, force fits, summarise, commit.

A Survey keeps its catalogue in a store of changes (plans/catalogue.py). A time step reads the cells of the sky that its
images cover, takes the images through in order of frequency, and commits what changed in one version, so that it can be
stopped at any time and go on from there. `run` is the batch mode over files; streaming/steps.py is the stream mode.
"""

from __future__ import annotations

import logging
import uuid
from functools import cache

from pyspark.errors import PythonException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyloom.functions import geometry as g
from skyloom.imaging import frames
from skyloom.operators import association as a
from skyloom.operators import detections
from skyloom.operators import images as im
from skyloom.operators import lightcurves as lc
from skyloom.plans import catalogue as c
from skyloom.plans.catalogue import Catalogue
from skyloom.plans.schemas import schema
from skyloom.plans.state import cut, cut_all, shared_folder
from skyloom.sources import fits, tables

log = logging.getLogger(__name__)
#: Defaults of a job.
DEFAULTS = {
    "detection": 8.0, "analysis": 3.0, "tile": (32, 32), "margin": 0, "radius": 0.1, "de_ruiter": a.DE_RUITER, "sys_err_arcsec": 10.0, "rms_low": 0.0, "rms_high": 100.0, "force_beam": False, "new_source_sigma": 3.0,
    "expiration": 10, "box_in_beams": 4.0, "bandwidth_max": 0.0, "history": 100, "history_sigma": 5.0, "bright_radius": 10.0, "noise_low": 1.0, "noise_high": 80.0, "monitors": (), "dataset": 1, "description": "", "copy_images": False, "compaction": c.EVERY,
}
#: Where the numbers of an image's measurements begin, by how they were made: blind, at null detections, at monitors.
BLIND, NULL, MONITOR, IMAGE = 0, 500_000, 900_000, 1_000_000
WCS = ("crpix1", "crpix2", "crval1", "crval2", "deltax", "deltay", "crota2", "projection")
#: What an image may bring on by what it holds; anything else is an error of the program and stops it.
OF_DATA = (ValueError, ArithmeticError, PythonException)


def images_of(spark: SparkSession, path: str) -> DataFrame:
    """Rows of metadata and pixels, numbered by time and frequency. Only metadata are ordered; pixels stay where they are."""
    read = cut(fits.read_images(spark, path))
    meta = fits.metadata(read)
    order = Window.orderBy("taustart_ts", "freq_eff", "path")  # a short row an image
    numbered = cut(meta.withColumn("image", F.row_number().over(order).cast("long")))
    return cut(read.select("path", "nx", "ny", "pixels").join(F.broadcast(numbered) if im._few(numbered) else numbered, "path"))


def reason(low: float, high: float, bright_radius: float, noise_low: float = 1.0, noise_high: float = 80.0) -> Column:
    """Why to set an image(flat, nan, rms_qc, beam_*_pix, tau_time, taustart_ts, centre_*, telescope, antenna_set, n*) aside, or null.

    All: flat. AARTFAAC and unknown telescopes: NaN. LOFAR and unknown ones: noise, beam. LOFAR: integration time, noise against
    the theoretical one (where the header tells high-band stations), bright sources, the Sun and Jupiter at the image's time.
    """
    telescope = F.upper(F.coalesce("telescope", F.lit("")))
    lofar, other = telescope == "LOFAR", telescope != "AARTFAAC"
    stations = tuple(F.coalesce(k, F.lit(0.0)) for k in ("ncore", "nremote", "nintl"))
    noise = F.when(lofar & (stations[0] + stations[1] + stations[2] > 1), im.high_band_noise(F.col("freq_eff"), F.col("freq_bw"), F.col("tau_time"), F.col("antenna_set"), stations))
    return im.first_reason(
        F.when(F.col("flat"), F.lit("flat image")), F.when(~lofar & F.col("nan"), F.lit("contains nan")), F.when(lofar & (F.col("tau_time") == 0), F.lit("tau_time is 0")),
        F.when(noise.isNotNull(), im.noise_reason(F.col("rms_qc"), noise, noise_low, noise_high)), F.when(other & noise.isNull(), im.rms_reason(F.col("rms_qc"), low, high)),
        F.when(other, im.beam_reason(F.col("beam_smaj_pix"), F.col("beam_smin_pix"))), F.when(lofar, im.bright_reason(F.col("centre_ra"), F.col("centre_decl"), bright_radius, F.col("taustart_ts"))),
    )


def _wcs() -> dict:
    """Pixels are counted from 0 in arrays and from 1 in headers."""
    return {"crpix1": F.col("crpix1") - 1, "crpix2": F.col("crpix2") - 1, "crval1": F.col("crval1"), "crval2": F.col("crval2"), "cdelt1": F.col("deltax"), "cdelt2": F.col("deltay"), "crota2": F.col("crota2")}


def on_sky(found: DataFrame, images: DataFrame, sys_err_arcsec: float, first: int = BLIND, room: int = NULL, kind: str = "blind", projection: str | None = None) -> DataFrame:
    """Found sources as rows of extractedsource: the fit on the sky, with a systematic error beside its own.

    projection: the images' own, where all have the same; else each has its own in a column.

    An image's measurements take numbers from `first` on; more than fit below `room` are an error.
    """
    band = F.col("band") if "band" in images.columns else F.format_string("%.0f", "freq_eff")
    rows = found.join(images.select("image", "taustart_ts", band.alias("band"), *WCS), "image")
    number = F.when(F.col("n") + first < room, F.col("image") * IMAGE + F.col("n") + first).otherwise(F.raise_error(F.lit("an image has more measurements than numbers")).cast("double").cast("long"))
    sky = detections.on_sky(rows, _wcs(), projection or F.col("projection")).select(
        number.alias("xtrsrc"), "image", F.col("taustart_ts").alias("ts"), F.col("band").cast("string").alias("band"), F.lit(1).alias("stokes"), *(F.col(k) if k in rows.columns else F.lit(None).cast("long").alias(k) for k in ("ff_runcat", "ff_monitor")),
        "ra", "decl", "ra_fit_err", "decl_fit_err", "error_radius", "semimajor", "semiminor", "pa", F.lit(sys_err_arcsec).alias("ew_sys_err"), F.lit(sys_err_arcsec).alias("ns_sys_err"), F.col("significance").alias("det_sigma"),
        F.col("peak").alias("f_peak"), F.col("peak_err").alias("f_peak_err"), F.col("flux").alias("f_int"), F.col("flux_err").alias("f_int_err"), "chisq", "reduced_chisq", F.when(F.col("fitted"), 0).otherwise(1).alias("fit_type"),
    )
    return tables.prepared(sky, kind).select(*(f.name for f in schema("extractedsource")))


@cache
def _pixel(projection: str) -> Column:
    x, y = g.pixel_of_sky(F.col("ra"), F.col("decl"), _wcs(), projection)
    return F.struct(x.alias("x"), y.alias("y"))


def requests_at(positions: DataFrame, image) -> DataFrame:
    """positions(key, ra, decl) as fits to ask for: image, n, x, y, key. image: a row of metadata. One order numbers an image's positions."""
    rows = positions.selectExpr("key", "ra", "decl", f"{image['image']}L AS image", *(f"{image[k]!r}D AS {k}" for k in WCS if k != "projection")).withColumn("at", _pixel(image["projection"]))
    return rows.selectExpr("image", "key", "at.x AS x", "at.y AS y", "CAST(ROW_NUMBER() OVER (ORDER BY key) AS INT) AS n").filter("NOT isnan(x) AND NOT isnan(y)")


class Survey:
    """A catalogue under `root` that takes images, time step after time step; opened again, it goes on where it was.

    settings are kept with the catalogue, and ones that differ from those are an error.
    """

    def __init__(self, spark: SparkSession, root: str, **settings):
        self.spark, self.p = spark, DEFAULTS | settings
        self.store = Catalogue(spark, root, self.p["compaction"])
        self.beyond = self.p["detection"] + self.p["new_source_sigma"]
        plain = {k: v if type(v).__name__ in tables.TYPES else repr(v) for k, v in self.p.items()}
        if not self.store.log()["version"]:
            config = self.spark.createDataFrame(tables.store_config({"job": plain}, self.p["dataset"]), schema("config"))
            dataset = tables.with_reruns(self.spark.range(1).select(F.lit(self.p["dataset"]).cast("long").alias("id"), F.current_timestamp().alias("process_start_ts"), F.lit(None).cast("timestamp").alias("process_end_ts"), F.lit(self.p["description"]).alias("description")))
            monitors = tables.monitor_rows(self.spark.createDataFrame([tuple(map(float, m)) for m in self.p["monitors"]], "ra double, decl double"), self.p["dataset"])
            self.store.commit({"config": config, "dataset": dataset.select(*(f.name for f in schema("dataset"))), "monitor": monitors.withColumn("cell", c.cell_of("ra", "decl"))}, {"batch": -1, "step": -1})
        else:
            stored = tables.fetch_config(self.store.read("config").collect())["job"]
            differ = sorted(k for k in plain if stored.get(k) != plain[k])
            if differ:
                raise ValueError(f"the catalogue was made with other settings: {', '.join(differ)}")

    # -- images -----------------------------------------------------------------------------------------------------

    def _numbered(self, read: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Rows with pixels and their image number; metadata with band, skyrgn, noise and reason, and what is new of bands and fields."""
        p, store = self.p, self.store
        last = store.read("image").agg(F.max("id")).first()[0] or 0
        read = cut(read.withColumn("row", F.monotonically_increasing_id()))
        order = Window.orderBy("taustart_ts", "freq_eff", "path", "row")  # a short row an image
        meta = cut(fits.metadata(read, "row").withColumn("image", (F.row_number().over(order) + last).cast("long")))
        images = read.select("row", "header", "nx", "ny", "pixels").join(F.broadcast(meta), "row")  # images of a time step
        noise = frames.noise(images, p["tile"], p["margin"])
        flags = images.select("image", (F.array_min("pixels") == F.array_max("pixels")).alias("flat"), F.exists("pixels", F.isnan).alias("nan"))
        noise, flags = cut_all(noise, flags)
        meta = meta.join(flags, "image").join(noise, "image").withColumn("reason", reason(p["rms_low"], p["rms_high"], p["bright_radius"], p["noise_low"], p["noise_high"]))
        return images, cut(meta)

    def _placed(self, meta: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
        """meta with skyrgn and band, all fields, and what is new of fields and bands. Bands are made in order, so frequencies, a pair an image, are dealt on the driver."""
        old = self.store.read("skyregion")
        key = ["skyrgn", "centre_ra", "centre_decl", "xtr_radius"]
        meta, regions = im.sky_fields(meta, cut(old.withColumnRenamed("id", "skyrgn").select(*key)))
        ordered = meta.select("image", "freq_eff", "freq_bw").orderBy("image").collect()
        known = [(r["id"], r["freq_low"], r["freq_high"]) for r in self.store.read("frequencyband").orderBy("id").collect()]  # bands are few
        bands, own = im.get_or_create_bands(self.spark, known, [(r["freq_eff"], r["freq_bw"] or 0.0) for r in ordered], self.p["bandwidth_max"])
        meta = meta.join(F.broadcast(self.spark.createDataFrame([(r["image"], b) for r, b in zip(ordered, own, strict=True)], "image long, band long")), "image")
        meta, regions = cut_all(meta, regions)
        x, y, z = g.cartesian(F.col("centre_ra"), F.col("centre_decl"))
        new = regions.join(old.selectExpr("id AS skyrgn"), "skyrgn", "left_anti").select(F.col("skyrgn").alias("id"), F.lit(self.p["dataset"]).cast("long").alias("dataset"), "centre_ra", "centre_decl", "xtr_radius", x.alias("x"), y.alias("y"), z.alias("z"))
        made = self.spark.createDataFrame([(i, self.p["dataset"], (lo + hi) / 2, lo, hi) for i, lo, hi in bands[len(known) :]], schema("frequencyband"))
        return meta, regions, new, made

    def _history(self, meta: DataFrame) -> DataFrame:
        """meta with the reason of images unlike their band's history, judged as each comes."""
        p = self.p
        before = im.newest_by_band(self.store.read("image").selectExpr("id AS image", "band", "taustart_ts AS ts", "rms_qc"), p["history"])
        both = before.unionByName(meta.selectExpr("image", "band", "taustart_ts AS ts", "rms_qc"))
        odd = im.judged_by_history(both, p["history"], p["history_sigma"]).filter("rejected").select("image", F.lit("rms unlike the band's history").alias("odd"))
        return cut(meta.join(odd, "image", "left").withColumn("reason", F.coalesce("reason", "odd")).drop("odd"))

    def _limits(self) -> DataFrame:
        """band, skyrgn, low, high, image: of all earlier good images of a band and field, the most sensitive's flux limits."""
        good = self.store.read("image").filter("reason IS NULL AND rms_min IS NOT NULL")
        own = F.struct((F.col("rms_min") * self.beyond).alias("low"), (F.col("rms_max") * self.beyond).alias("high"), F.col("id").alias("image"), F.col("taustart_ts").alias("ts"))
        return cut(good.groupBy("band", "skyrgn").agg(F.min(own).alias("l")).select("band", "skyrgn", "l.*"))

    # -- one time step ------------------------------------------------------------------------------------------------

    def take(self, read: DataFrame, note: dict | None = None) -> int:
        """One time step of images, rows of the FITS reader, all the way; the version in which it is committed, with the note.

        Images set aside, and ones at which a step failed, are stored with the reason.
        """
        p, store = self.p, self.store
        images, meta = self._numbered(read)
        meta, regions, new_fields, new_bands = self._placed(meta)
        meta = self._history(meta)
        good = meta.filter("reason IS NULL").withColumn("across", a.crosses_meridian(F.col("centre_ra"), F.col("centre_decl"), F.col("xtr_radius")))
        ordered = good.select("image", "band", "skyrgn", "taustart_ts", "across", "beam_smaj_pix", *WCS).orderBy("image").collect()  # a short row an image
        failed: dict[int, str] = {}
        cells = c.cells_of(meta, p["radius"] + 0.01)
        usable = images.join(F.broadcast(good.select("image")), "image", "left_semi")
        found = frames.extract(usable, None, p["detection"], p["analysis"], p["tile"], p["margin"], force_beam=p["force_beam"])
        names = {r["projection"] for r in ordered}
        projection = names.pop() if len(names) == 1 else None
        before, made = store.state(cells), on_sky(found, good, p["sys_err_arcsec"], projection=projection)
        *state, made, monitors = cut_all(*(getattr(before, k) for k in a.TABLES), made, store.read("monitor", cells, celled=True))
        before = a.State(*state)
        linked = a.memberships(before.runcat.selectExpr("runcat", "wm_ra AS ra", "wm_decl AS decl"), new_fields.selectExpr("id AS skyrgn", "centre_ra", "centre_decl", "xtr_radius"))
        after = a.State(before.runcat, before.flux, before.assoc, cut(before.skyrgn.unionByName(linked)), before.newsource)
        regions = regions if regions.count() > 1 else None
        first_id = min((r["image"] for r in ordered), default=1 << 40)
        times = store.read("image").selectExpr("id AS image", "taustart_ts AS ts")
        founded = before.assoc.groupBy("runcat").agg(F.min("xtrsrc").alias("x")).selectExpr("runcat", f"x DIV {IMAGE} AS image").join(times, "image").select("runcat", "ts")
        limits, founded = cut_all(self._limits(), founded)

        rows, wanted, columns = made, None, ["xtrsrc", "ra", "decl", "uew", "uns", "band", "stokes", "f_peak", "f_peak_err", "f_int", "f_int_err"]
        for one in ordered:
            image = one["image"]
            own = rows.filter(F.col("image") == image).select(*columns)
            earlier = limits.filter((F.col("band") == one["band"]) & (F.col("ts") < F.lit(one["taustart_ts"]))).drop("band", "ts")
            try:
                after = a.associate(after, own, p["radius"], p["de_ruiter"], p["dataset"], bool(one["across"]), one["skyrgn"], regions, earlier)
            except OF_DATA as e:
                log.exception("image %s failed", image)
                failed[image] = f"failed: {type(e).__name__}: {e}"[:500]
                continue
            seen = after.assoc.join(own.select("xtrsrc"), "xtrsrc", "left_semi").select("runcat").distinct()
            lost = a.null_detections(after.runcat, seen, after.skyrgn, one["skyrgn"], p["expiration"], founded, one["taustart_ts"])
            ask = requests_at(lost.selectExpr("runcat AS key", "wm_ra AS ra", "wm_decl AS decl"), one).withColumn("kind", F.lit("ff_nd"))
            if p["monitors"]:
                watch = requests_at(monitors.selectExpr("id AS key", "ra", "decl"), one).withColumn("kind", F.lit("ff_ms"))
                ask = ask.unionByName(watch.withColumn("n", F.col("n") + MONITOR))
            wanted = ask if wanted is None else wanted.unionByName(ask)
        if wanted is not None:
            rows, after, monitors = self._forced(images, good, cut(wanted), rows, after, monitors, ordered, failed, projection)
        if failed:
            rows = rows.filter(~F.col("image").isin(list(failed)))
            meta = meta.withColumn("reason", F.coalesce("reason", F.element_at(F.create_map(*(F.lit(x) for kv in failed.items() for x in kv)), F.col("image"))))
        return self._commit(cells, before, after, rows, monitors, meta, new_fields, new_bands, first_id, note, images)

    def _forced(self, images, good, wanted, rows, after, monitors, ordered, failed, projection):
        """All forced fits of the step in one pass over its pixels, then each image's taken into the state."""
        p = self.p
        box = p["box_in_beams"] * max((r["beam_smaj_pix"] or 1.0 for r in ordered), default=1.0)
        fitted = frames.forced(images.join(wanted.select("image").distinct(), "image", "left_semi"), wanted.select("image", "n", "x", "y"), None, box, p["tile"])
        keyed = fitted.join(wanted.select("image", "n", "key", "kind"), ["image", "n"]).withColumns({"ff_runcat": F.expr("CASE WHEN kind = 'ff_nd' THEN key END"), "ff_monitor": F.expr("CASE WHEN kind = 'ff_ms' THEN key END")})
        nulls = on_sky(keyed.filter("kind = 'ff_nd'"), good, p["sys_err_arcsec"], NULL, MONITOR, "ff_nd", projection)
        watched = on_sky(keyed.filter("kind = 'ff_ms'"), good, p["sys_err_arcsec"], 0, IMAGE, "ff_ms", projection)
        fits_ = cut(nulls.unionByName(watched))
        asked = {(r["image"], r["extract_type"]) for r in fits_.select("image", "extract_type").distinct().collect()}  # two for an image at most
        for one in ordered:
            own = fits_.filter(F.col("image") == one["image"])
            if one["image"] in failed:
                continue
            if (one["image"], 1) in asked:
                after = a.associate_forced(after, own.filter("extract_type = 1").withColumn("runcat", F.col("ff_runcat")))
            if (one["image"], 2) in asked:
                at = own.filter("extract_type = 2").join(monitors.select(F.col("id").alias("ff_monitor"), "runcat"), "ff_monitor")
                after = a.associate_monitored(after, at, p["dataset"], one["skyrgn"])
                monitors = cut(a.linked_back(monitors, at.filter("runcat is null")))
        return rows.unionByName(fits_), after, monitors

    def _commit(self, cells, before, after, rows, monitors, meta, new_fields, new_bands, first_id, note, images) -> int:
        store = self.store
        rows = rows.withColumn("cell", c.cell_of("ra", "decl"))
        changes = c.state_changes(before, after)
        touched = after.assoc.filter(F.col("xtrsrc") >= first_id * IMAGE).select("runcat").distinct()
        where = after.runcat.select("runcat", c.cell_of("wm_ra", "wm_decl").alias("cell"))
        kept = store.read("varmetric", cells, celled=True)
        curves = after.assoc.join(touched, "runcat", "left_semi")
        measured = store.read("extractedsource", cells).unionByName(rows.drop("cell"))
        times = meta.selectExpr("image AS id", "rms_min", "rms_max").unionByName(store.read("image").select("id", "rms_min", "rms_max"))
        metrics = variability(a.State(after.runcat, after.flux, curves, after.skyrgn, after.newsource), measured, times)
        own = [f.name for f in schema("varmetric")]
        metrics = metrics.select(*own).unionByName(kept.drop("cell").join(touched, "runcat", "left_anti")).join(where, "runcat")
        changes["varmetric"] = c.difference("varmetric", kept, metrics)
        changes |= {"extractedsource": rows, "image": tables.image_rows(meta, self.p["dataset"], self.p["detection"], self.p["analysis"]), "skyregion": new_fields, "frequencyband": new_bands}
        if self.p["monitors"]:
            changes["monitor"] = c.difference("monitor", store.read("monitor", cells, celled=True), monitors)
        if self.p["copy_images"]:
            changes["imagedata"] = fits.blobs(images)
        return store.commit(changes, note)

    def ended(self) -> None:
        """The time at which a run ended, stored with the dataset."""
        self.store.commit({"dataset": tables.ended(self.store.read("dataset"), self.p["dataset"], F.current_timestamp())})


def run(spark: SparkSession, path: str, snapshots: str | None = None, **settings) -> tuple[a.State, DataFrame]:
    """The catalogue after all images that path names, and the measurements; kept under `snapshots`, or a folder of its own.

    Images that a catalogue there has are not taken again, so a run that was stopped goes on.
    """
    root = snapshots or f"{shared_folder(spark)}/survey-{uuid.uuid4()}"
    survey = Survey(spark, root, **settings)
    done = survey.store.read("image").select(F.col("url").alias("path"))
    meta = fits.metadata(fits.read_images(spark, path, pixels=False)).join(done, "path", "left_anti")
    steps = meta.groupBy("taustart_ts").agg(F.sort_array(F.collect_list("path")).alias("paths")).orderBy("taustart_ts").collect()  # a path an image
    for step in steps:
        survey.take(fits.read_images(spark, step["paths"]))
    survey.ended()
    return survey.store.state(), survey.store.read("extractedsource")


def variability(state: a.State, measured: DataFrame, images: DataFrame | None = None) -> DataFrame:
    """A row a source: variability of its brightest last band, and its first measurement's new-source event, if any.

    images(id, rms_min, rms_max): with these, rows of varmetric, the trigger's flux over the limit image's noise with it.
    """
    rows = state.assoc.select(F.col("runcat").alias("source"), "xtrsrc", "v_int", "eta_int").join(measured.select("xtrsrc", "ts", "band", "f_int"), "xtrsrc")
    first = state.newsource.groupBy(F.col("runcat").alias("source")).agg(F.min_by(F.struct("trigger_xtrsrc", F.col("previous_limits_image").alias("image")), "trigger_xtrsrc").alias("e")).select("source", "e.*")
    if images is None:
        return lc.variability(rows, first.select("source", F.col("trigger_xtrsrc").alias("newsource")))
    return lc.variability(rows, lc.trigger_significance(first, measured, images.withColumnRenamed("id", "image"))).withColumnsRenamed({"source": "runcat", "sigma_rms_min": "sigma_rms_min", "sigma_rms_max": "sigma_rms_max"})


__all__ = ["DEFAULTS", "Survey", "images_of", "on_sky", "reason", "run", "variability"]
