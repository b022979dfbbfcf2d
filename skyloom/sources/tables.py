"""Reading helpers and text sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def columns_from_table(df: DataFrame, keywords=None, alias: dict[str, str] | None = None, where: dict | None = None, order: str | None = None) -> DataFrame:
    """Chosen columns, renamed, of rows that equal all of `where`, in order."""
    for k, v in (where or {}).items():
        df = df.filter(F.col(k).eqNullSafe(F.lit(v)))
    if order:
        df = df.orderBy(order)
    return df.select(*(F.col(c).alias((alias or {}).get(c, c)) for c in keywords or df.columns))


def set_columns(df: DataFrame, values: dict, where: dict) -> DataFrame:
    """df with columns set in the rows that equal all of `where`."""
    hit = F.lit(True)
    for k, v in where.items():
        hit = hit & F.col(k).eqNullSafe(F.lit(v))
    return df.withColumns({k: F.when(hit, F.lit(v)).otherwise(F.col(k)) for k, v in values.items()})


# Configuration types that are read back.
TYPES = {"str": str, "int": int, "float": float, "bool": lambda v: v == "True"}


def store_config(config: dict[str, dict], dataset: int = 1) -> list[tuple]:
    """(dataset, section, key, value, type) rows; passwords are left out, other types than TYPES' are an error."""
    rows = []
    for section, items in config.items():
        for key, value in items.items():
            if key == "password":
                continue
            if type(value).__name__ not in TYPES:
                raise TypeError(f"{section}.{key} has a type that cannot be stored")
            rows.append((dataset, section, key, str(value), type(value).__name__))
    return rows


def fetch_config(rows) -> dict[str, dict]:
    out: dict[str, dict] = {}
    for r in rows:
        out.setdefault(r["section"], {})[r["key"]] = TYPES[r["type"]](r["value"])
    return out


def parse_config(text: str) -> dict[str, dict]:
    """INI text as nested dicts of literals, timestamps, else strings."""
    import ast
    import configparser
    from datetime import datetime

    parser = configparser.ConfigParser(interpolation=None)
    parser.read_string(text)
    out: dict[str, dict] = {}
    for section in parser.sections():
        for key, raw in parser.items(section):
            try:
                value = ast.literal_eval(raw)
            except (ValueError, SyntaxError):
                try:
                    value = datetime.fromisoformat(raw)
                except ValueError:
                    value = raw
            out.setdefault(section, {})[key] = value
    return out


def parse_positions(text: Column) -> Column:
    """A JSON list of [right ascension, declination] pairs."""
    return F.from_json(text, "array<array<double>>")


def prepared(measured: DataFrame, extract_type: str = "blind") -> DataFrame:
    """Measurements ready to store: infinite flux errors go, infinite error radii become 360, derived columns are added."""
    from skyloom.functions import geometry as g

    codes = {"blind": 0, "ff_nd": 1, "ff_ms": 2}
    if extract_type not in codes:
        raise ValueError(f"unknown extract type {extract_type}")
    inf = float("inf")
    rows = measured.filter((F.abs("f_peak_err") != inf) & (F.abs("f_int_err") != inf))
    radius = F.when(F.abs("error_radius") == inf, 360.0).otherwise(F.col("error_radius"))
    x, y, z = g.cartesian(F.col("ra"), F.col("decl"))
    ew, ns = F.sqrt(F.pow("ew_sys_err", 2) + F.pow(radius, 2)) / 3600, F.sqrt(F.pow("ns_sys_err", 2) + F.pow(radius, 2)) / 3600
    return rows.withColumns({
        "error_radius": radius, "uew": ew, "uns": ns, "ra_err": F.sqrt(F.pow("ra_fit_err", 2) + F.pow(g.alpha_inflate(F.col("ew_sys_err") / 3600, F.col("decl")), 2)),
        "decl_err": F.sqrt(F.pow("decl_fit_err", 2) + F.pow(F.col("ns_sys_err") / 3600, 2)), "zone": g.zone(F.col("decl")), "x": x, "y": y, "z": z, "racosdecl": F.col("ra") * F.cos(F.radians("decl")), "extract_type": F.lit(codes[extract_type]),
    })


def region_lines(found: DataFrame) -> DataFrame:
    """DS9 ellipse regions."""
    return found.select(F.format_string("ellipse(%.6f, %.6f, %.4f\", %.4f\", %.2f)", "ra", "decl", "semimajor", "semiminor", "pa").alias("value"))


def sky_model_lines(found: DataFrame) -> DataFrame:
    return found.select(F.format_string("%s, POINT, %.6f, %.6f, %.4e", F.col("xtrsrc").cast("string"), "ra", "decl", "f_int").alias("value"))


def csv_lines(found: DataFrame, columns=("ra", "decl", "f_peak", "f_int")) -> DataFrame:
    return found.select(F.concat_ws(", ", *(F.format_string("%.6f", c) for c in columns)).alias("value"))


def closest(found: DataFrame, x: float, y: float) -> DataFrame:
    """The object nearest to a position, as one row; the least id of equals."""
    d = F.sqrt(F.pow(F.col("x") - x, 2) + F.pow(F.col("y") - y, 2))
    return found.agg(F.min_by(F.struct("xtrsrc", "x", "y"), F.struct(d, "xtrsrc")).alias("o")).select("o.*")


def summary_lines(found: DataFrame) -> DataFrame:
    """A line for people for each source: position, peak and total flux with errors, significance."""
    return found.select(F.format_string("%s: RA %.5f Dec %.5f, peak %.4f +- %.4f, flux %.4f +- %.4f, %.1f sigma", F.col("xtrsrc").cast("string"), "ra", "decl", "f_peak", "f_peak_err", "f_int", "f_int_err", "det_sigma").alias("value"))


# -- datasets, images, monitors -----------------------------------------------------------------------------------------


def with_reruns(datasets: DataFrame, by=("description",), order=("process_start_ts", "id")) -> DataFrame:
    """datasets with rerun: how many of the same description came before."""
    from pyspark.sql import Window

    return datasets.withColumn("rerun", (F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1).cast("int"))


def ended(datasets: DataFrame, dataset: int, ts: Column) -> DataFrame:
    """datasets with the end time of one set."""
    return datasets.withColumn("process_end_ts", F.when(F.col("id") == dataset, ts).otherwise(F.col("process_end_ts")))


def image_rows(meta: DataFrame, dataset: int = 1, detection: float | None = None, analysis: float | None = None) -> DataFrame:
    """Rows to store of images(image, band, skyrgn, metadata): beam axes from pixels to degrees, its angle from radians.

    With thresholds, whole rows of the table `image`, the range of the noise and the reason to set it aside included.
    """
    step = F.abs("deltax")
    more = [] if detection is None else ["rms_min", "rms_max", F.lit(detection).alias("detection_thresh"), F.lit(analysis).alias("analysis_thresh"), F.lit(1).alias("stokes"), "reason"]
    return meta.select(F.col("image").alias("id"), F.lit(dataset).cast("long").alias("dataset"), "band", "skyrgn", "tau_time", "freq_eff", "freq_bw", "taustart_ts", (F.col("beam_smaj_pix") * step).alias("rb_smaj"), (F.col("beam_smin_pix") * step).alias("rb_smin"), F.degrees("beam_pa_rad").alias("rb_pa"), "deltax", "deltay", "rms_qc", "url", *more)


def monitor_rows(positions: DataFrame, dataset: int = 1, first: int = 1) -> DataFrame:
    """Monitors to store of positions(ra, decl), each position once, numbered by it."""
    from pyspark.sql import Window

    place = Window.orderBy("ra", "decl")  # a list that a user writes
    return positions.select("ra", "decl").distinct().select((F.row_number().over(place) + (first - 1)).cast("long").alias("id"), F.lit(dataset).cast("long").alias("dataset"), F.lit(None).cast("long").alias("runcat"), "ra", "decl", F.lit(None).cast("string").alias("name"))


def without_dataset(tables: dict[str, DataFrame], dataset: int) -> dict[str, DataFrame]:
    """The tables without a dataset: its own rows, and those of its images and sources. Tables without such a column stay."""
    images = tables["image"].filter(F.col("dataset") == dataset).select(F.col("id").alias("image")) if "image" in tables else None
    runcats = tables["runningcatalog"].filter(F.col("dataset") == dataset).select("runcat") if "runningcatalog" in tables else None
    out = {}
    for name, df in tables.items():
        if name == "dataset":
            df = df.filter(F.col("id") != dataset)
        elif "dataset" in df.columns:
            df = df.filter(F.col("dataset") != dataset)
        elif "image" in df.columns and images is not None:
            df = df.join(images, "image", "left_anti")
        elif "runcat" in df.columns and runcats is not None:
            df = df.join(runcats, "runcat", "left_anti")
        out[name] = df
    return out


# -- rejections -------------------------------------------------------------------------------------------------------


def reject(rejections: DataFrame, images: DataFrame, reason: int, comment: str) -> DataFrame:
    return rejections.unionByName(images.select("image", F.lit(reason).alias("rejectreason"), F.lit(comment).alias("comment")))


def unreject(rejections: DataFrame, images: DataFrame) -> DataFrame:
    return rejections.join(images.select("image"), "image", "left_anti")


def good_images(images: DataFrame, rejections: DataFrame) -> DataFrame:
    return images.join(rejections.filter(F.col("image").isNotNull()), "image", "left_anti")


def missing_reasons(reasons: DataFrame, wanted: DataFrame) -> DataFrame:
    """Reasons to insert so that all wanted ids are there."""
    return wanted.join(reasons.select("id"), "id", "left_anti")
