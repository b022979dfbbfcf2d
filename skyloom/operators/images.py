"""Image metadata: bands, fields of view, time steps, quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyloom.functions import clock, ephemeris
from skyloom.functions import geometry as g


def group_per_timestep(images: DataFrame) -> DataFrame:
    """ts, urls: the images of each time in order of frequency (then url), times ascending."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("freq_eff", "url"))), lambda x: x["url"])
    return images.groupBy("ts").agg(ordered.alias("urls")).orderBy("ts")


def union_length(ranges: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """Total length that each key's ranges cover, overlaps once: islands begin where a range starts past all before it."""
    order = Window.partitionBy(key).orderBy(start, end)
    before = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = ranges.withColumn("__reach", before)
    gain = F.greatest(F.lit(0), F.col(end) - F.greatest(F.col(start), F.coalesce("__reach", F.col(start))))
    return marked.groupBy(key).agg(F.sum(gain).alias("covered"))


def overlapping_band(images: DataFrame, bands: DataFrame, width: float | None = None) -> DataFrame:
    """For each image(freq_eff, freq_bw) the least id of bands(band, freq_low, freq_high) that it overlaps, or null.

    Bands are few; intervals overlap where they span together less than both widths.
    """
    half = (F.lit(width) if width else F.col("freq_bw")) / 2
    low, high = F.col("freq_eff") - half, F.col("freq_eff") + half
    spans = F.greatest(high, F.col("freq_high")) - F.least(low, F.col("freq_low")) < (high - low) + (F.col("freq_high") - F.col("freq_low"))
    return images.join(bands.hint("broadcast") if _few(bands) else bands, spans, "left").groupBy(*images.columns).agg(F.min("band").alias("band"))


def _few(df: DataFrame, most: int = 10_000) -> bool:
    return df.limit(most + 1).count() <= most


def get_or_create_bands(spark: SparkSession, bands: list[tuple], images: list[tuple[float, float]], width: float = 0.0) -> tuple[list[tuple], list[int]]:
    """Bands (id, low, high) after images (freq, bandwidth) in turn, and each image's band. The order decides, so this is driver code."""
    out, found = list(bands), []
    for freq, bw in images:
        w = width or bw
        low, high = freq - w / 2, freq + w / 2
        hit = [b for b, lo, hi in out if max(high, hi) - min(low, lo) < (high - low) + (hi - lo)]
        if not hit:
            out.append((max([b for b, *_ in out], default=0) + 1, low, high))
            hit = [out[-1][0]]
        found.append(min(hit))
    return out, found


def get_or_create_regions(images: DataFrame, regions: DataFrame) -> DataFrame:
    """regions(skyrgn, centre_ra, centre_decl, xtr_radius) and those that images ask for and are not there, by exact equality."""
    key = ["centre_ra", "centre_decl", "xtr_radius"]
    new = images.select(*key).distinct().join(regions, key, "left_anti")
    top = regions.agg(F.coalesce(F.max("skyrgn"), F.lit(0))).first()[0]
    return regions.unionByName(new.withColumn("skyrgn", (F.row_number().over(Window.orderBy(*key)) + top).cast("long")).select("skyrgn", *key))


def sky_fields(images: DataFrame, regions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """images(centre_ra, centre_decl, xtr_radius, ...) with skyrgn, and the regions, new ones included."""
    key = ["centre_ra", "centre_decl", "xtr_radius"]
    after = get_or_create_regions(images.select(*key), regions.select("skyrgn", *key))
    return images.join(after, key), after


def newest_by_band(images: DataFrame, n: int) -> DataFrame:
    """Each band's last n images."""
    order = Window.partitionBy("band").orderBy(F.col("ts").desc(), F.col("image").desc())
    return images.withColumn("__n", F.row_number().over(order)).filter(F.col("__n") <= n).drop("__n")


def historical_rms(images: DataFrame, history: int, sigma: float) -> DataFrame:
    """band, image, rejected: the newest image against mean and population deviation of the last `history`; fewer accept."""
    last = newest_by_band(images, history)
    stats = last.groupBy("band").agg(F.count("*").alias("n"), F.avg("rms_qc").alias("mu"), F.stddev_pop("rms_qc").alias("sd"))
    newest = newest_by_band(images, 1).select("band", "image", "rms_qc")
    return newest.join(stats, "band").select("band", "image", ((F.col("n") >= history) & (F.abs(F.col("rms_qc") - F.col("mu")) > sigma * F.col("sd"))).alias("rejected"))


def judged_by_history(images: DataFrame, history: int, sigma: float) -> DataFrame:
    """images(image, band, ts, rms_qc) with `rejected`: each against mean and population deviation of its band's last `history`.

    Every image is judged as it comes, from those up to it, itself and rejected ones included; fewer than `history` accept.
    An image must lie strictly within sigma deviations of the mean, so where all are alike none does. Null where rms_qc is.
    """
    last = Window.partitionBy("band").orderBy("ts", "image").rowsBetween(1 - history, 0)
    own = images.withColumns({"__n": F.count("rms_qc").over(last), "__mu": F.avg("rms_qc").over(last), "__sd": F.stddev_pop("rms_qc").over(last)})
    return own.withColumn("rejected", (F.col("__n") >= history) & ~(F.abs(F.col("rms_qc") - F.col("__mu")) < sigma * F.col("__sd"))).drop("__n", "__mu", "__sd")


def rms_reason(rms: Column, low: float, high: float) -> Column:
    return F.when(~((rms > low) & (rms < high)), F.lit("rms outside range"))


def noise_reason(rms: Column, noise: Column, low: float, high: float) -> Column:
    return F.when(rms < noise * low, F.lit("rms too low")).when(rms > noise * high, F.lit("rms too high"))


def beam_reason(smaj: Column, smin: Column, oversampled: float = 30, elliptical: float = 2.0) -> Column:
    infinite = (F.abs(smaj) == float("inf")) | (F.abs(smin) == float("inf")) | F.isnan(smaj) | F.isnan(smin)
    return F.when(infinite, F.lit("beam infinite")).when((smaj * 2 <= 1) | (smin * 2 <= 1), F.lit("beam undersampled")).when((smaj > oversampled) | (smin > oversampled), F.lit("beam oversampled")).when(smaj / F.nullif(smin, F.lit(0.0)) > elliptical, F.lit("beam elliptical"))


def nan_reason(pixels: Column) -> Column:
    return F.when(F.exists(pixels, lambda p: F.isnan(p)), F.lit("contains nan"))


def flat_reason(pixels: Column) -> Column:
    return F.when(F.array_min(pixels) == F.array_max(pixels), F.lit("flat image"))


def first_reason(*reasons: Column) -> Column:
    return F.coalesce(*reasons)


# Bright radio sources (name, right ascension, declination in degrees, J2000).
BRIGHT = (("CasA", 350.85, 58.815), ("CygA", 299.868153, 40.733916), ("VirA", 187.705930, 12.391123), ("TauA", 83.633083, 22.014500), ("HerA", 252.783433, 4.992561))


def bright_reason(ra: Column, decl: Column, radius: float = 10.0, ts: Column | None = None) -> Column:
    """A fixed bright source within the radius, or the Sun or Jupiter at a time, if one is given; the first of them, or null."""
    known = ra.isNotNull() & decl.isNotNull()
    near = [F.when(known & (g.distance_deg(ra, decl, F.lit(a), F.lit(d)) < radius), F.lit(f"{name} near")) for name, a, d in BRIGHT]
    for name, of in (ephemeris.BODIES if ts is not None else {}).items():
        close = ephemeris.bound({"p": of(clock.mjd(ts))}, lambda k: g.distance_deg(ra, decl, k["p"]["ra"], k["p"]["decl"]) < radius)
        near.append(F.when(known & ts.isNotNull() & close, F.lit(f"{name} near")))
    return F.coalesce(*near)


def fwhm(wavelength: Column, diameter: Column, taper: float = 1.3) -> Column:
    return taper * wavelength / diameter


def field_of_view(width: Column) -> Column:
    return F.pi() * (width / 2) * (width / 2)


C, BOLTZMANN = 299792458.0, 1.380649e-23
# Instrumental noise by frequency (Hz), as a share of the sky's temperature, and in kelvin.
SHARE = ((10e6, 0.1), (40e6, 0.7), (50e6, 0.85), (55e6, 0.9), (60e6, 0.85), (70e6, 0.6), (80e6, 0.3), (90e6, 0.0), (110e6, 0.0))
KELVIN = ((110e6, 0.0), (120e6, 200.0), (300e6, 200.0))


def _linear(x: Column, table) -> Column:
    out = F.lit(None).cast("double")
    for (a, p), (b, q) in zip(table, table[1:], strict=False):
        out = F.when((x >= a) & (x <= b), p + (x - a) * ((q - p) / (b - a))).otherwise(out)
    return out


def dipole_area(freq: Column, distance: Column | None = None) -> Column:
    """Effective area of a dipole; below 100 MHz or so its neighbour's distance bounds it."""
    w = C / freq
    d = F.lit(1.0) if distance is None else distance
    return F.when(w > 3, F.least(w * w / 3, F.pi() * d * d / 4)).otherwise(F.least(w * w / 3, F.lit(1.5625)))


def system_sensitivity(freq: Column, area: Column) -> Column:
    """System equivalent flux density in jansky. Null above 300 MHz, where no instrumental noise is tabulated."""
    sky = 60 * F.pow(C / freq, F.lit(2.55))
    instrument = F.coalesce(_linear(freq, ((0.0, 0.0), SHARE[0])) * sky, _linear(freq, SHARE) * sky, _linear(freq, KELVIN))
    return 2 * BOLTZMANN / area * (sky + instrument) * 1e26


def noise_level(freq: Column, bandwidth: Column, tau: Column, counts: tuple[Column, Column, Column], areas: tuple[Column, Column, Column]) -> Column:
    """Theoretical image noise in jansky, from numbers and areas of core, remote and international stations."""
    s = [system_sensitivity(freq, a) for a in areas]
    total = F.lit(0.0)
    for i in range(3):
        total = total + counts[i] * (counts[i] - 1) / 2 / (s[i] * s[i])
        for j in range(i):
            total = total + counts[i] * counts[j] / (s[i] * s[j])
    return 1 / F.sqrt(4 * bandwidth * tau * total)


#: Aerials of a tile, and tiles of a core, remote and international station.
TILE, TILES = 16, (24, 48, 96)


def high_band_noise(freq: Column, bandwidth: Column, tau: Column, antenna: Column, counts: tuple[Column, Column, Column]) -> Column:
    """Theoretical noise in jansky of an image by high-band stations (core, remote, international); null for other aerials.

    Low-band aerials need their distances (`nearest_neighbour`, `dipole_area`), which an image's header does not have.
    """
    areas = tuple(dipole_area(freq) * TILE * n for n in TILES)
    return F.when(F.upper(antenna).startswith("HBA"), noise_level(freq, bandwidth, tau, counts, areas))


def nearest_neighbour(antennas: DataFrame) -> DataFrame:
    """station, antenna, distance to its station's nearest other antenna. A station has at most a few hundred."""
    a, b = antennas.alias("a"), antennas.alias("b")
    d = F.sqrt(sum((F.pow(F.col(f"a.{c}") - F.col(f"b.{c}"), 2) for c in ("y", "z")), F.pow(F.col("a.x") - F.col("b.x"), 2)))
    return a.join(b, (F.col("a.station") == F.col("b.station")) & (F.col("a.antenna") != F.col("b.antenna"))).groupBy("a.station", "a.antenna").agg(F.min(d).alias("distance"))
