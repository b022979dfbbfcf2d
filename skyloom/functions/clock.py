"""Angles in sexagesimal form, Julian dates and sidereal time, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: MJD of the Unix epoch, in days.
EPOCH = 40587


def mjd(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp")) / 86400e6 + EPOCH


def julian_date(ts: Column) -> Column:
    return mjd(ts) + 2400000.5


def of_mjd(days: Column) -> Column:
    return F.timestamp_micros(F.round((days - EPOCH) * 86400e6).cast("long"))


def unix_to_mjd_seconds(s: Column) -> Column:
    return s + float(EPOCH * 86400)


def mjd_seconds_to_unix(s: Column) -> Column:
    return s - float(EPOCH * 86400)


def seconds_to_degrees(s: Column) -> Column:
    return s * 15.0 / 3600.0


def seconds_to_days(s: Column) -> Column:
    return s / 86400.0


def hms(hours: Column) -> Column:
    """struct(h, m, s) of decimal hours >= 0."""
    m = (hours - F.floor(hours)) * 60
    return F.struct(F.floor(hours).cast("int").alias("h"), F.floor(m).cast("int").alias("m"), ((m - F.floor(m)) * 60).alias("s"))


def ra_to_hms(ra: Column) -> Column:
    return hms(F.pmod(ra, F.lit(360.0)) / 15)


def seconds_to_hms(s: Column) -> Column:
    return F.struct(F.floor(s / 3600).cast("int").alias("h"), F.floor(F.pmod(s, F.lit(3600.0)) / 60).cast("int").alias("m"), F.pmod(s, F.lit(60.0)).alias("s"))


def decl_to_dms(decl: Column) -> Column:
    """struct(sign, d, m, s): the sign goes with the first part that is not zero in text, so it is kept apart here."""
    x = F.abs(decl)
    m = (x - F.floor(x)) * 60
    checked = F.when(x > 90, F.raise_error(F.lit("a declination lies within 90 degrees"))).otherwise(F.floor(x).cast("int"))
    return F.struct(F.when(decl < 0, -1).otherwise(1).alias("sign"), checked.alias("d"), F.floor(m).cast("int").alias("m"), ((m - F.floor(m)) * 60).alias("s"))


def hms_to_ra(h: Column, m: Column, s: Column) -> Column:
    """Degrees. A leading negative part makes all negative; a negative part after a positive one is an error."""
    return _joined(h, m, s) * 15


def dms_to_decl(d: Column, m: Column, s: Column) -> Column:
    return _joined(d, m, s)


def _joined(a: Column, b: Column, c: Column) -> Column:
    minus = (a < 0) | (b < 0) | (c < 0)
    mixed = minus & ((a > 0) | ((b > 0) & (a >= 0)) | ((c > 0) & (a >= 0) & (b >= 0)))
    size = F.abs(a) + F.abs(b) / 60.0 + F.abs(c) / 3600.0
    return F.when(mixed, F.raise_error(F.lit("parts of different sign")).cast("double")).when(minus, -size).otherwise(size)


def sidereal_degrees(days: Column, longitude: Column) -> Column:
    """Local mean sidereal time of an MJD (UT), by the IAU 1982 polynomial; the equation of the equinoxes (to 1.2 s) is left out."""
    t = (days - 51544.5) / 36525
    gmst = 280.46061837 + 360.98564736629 * (days - 51544.5) + 0.000387933 * t * t - t * t * t / 38710000
    return F.pmod(gmst + longitude, F.lit(360.0))


def altaz(days: Column, ra: Column, decl: Column, latitude: Column, longitude: Column) -> tuple[Column, Column]:
    """Altitude and azimuth from north through east, all in degrees."""
    h = F.radians(sidereal_degrees(days, longitude) - ra)
    d, p = F.radians(decl), F.radians(latitude)
    alt = F.asin(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), F.sin(d) * F.sin(p) + F.cos(d) * F.cos(p) * F.cos(h))))
    az = F.atan2(-F.cos(d) * F.sin(h), F.sin(d) * F.cos(p) - F.cos(d) * F.sin(p) * F.cos(h))
    return F.degrees(alt), F.pmod(F.degrees(az), F.lit(360.0))
