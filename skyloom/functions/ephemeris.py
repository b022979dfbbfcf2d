"""The Sun, Jupiter, nutation and apparent sidereal time by public low-precision series, as column expressions.

The Sun is good to about 0.01 degrees and Jupiter to about 0.15 between 1800 and 2050, in the equinox of J2000 and without
light time and aberration; sidereal time to 0.03 s beside the difference of UT1 and UTC, which is below a second.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyloom.functions import clock

# Mean Keplerian elements and their change a century at J2000 (ecliptic of J2000): half axis in astronomical
# units, eccentricity, inclination, mean longitude, longitudes of perihelion and of the ascending node in degrees.
EARTH = ((1.00000261, 0.00000562), (0.01671123, -0.00004392), (-0.00001531, -0.01294668), (100.46457166, 35999.37244981), (102.93768193, 0.32327364), (0.0, 0.0))
JUPITER = ((5.20288700, -0.00011607), (0.04838624, -0.00013253), (1.30439695, -0.00183714), (34.39644051, 3034.74612775), (14.72847983, 0.21252668), (100.47390909, 0.20469106))
# Obliquity of the ecliptic at J2000 in degrees, and its change a century.
OBLIQUITY = (23.4392911, -0.0130042)
# Nutation, by multiples of the node, the Sun's and the Moon's mean longitude: arcseconds in longitude (sine)
# and in obliquity (cosine).
NUTATION = (((1, 0, 0), -17.20, 9.20), ((0, 2, 0), -1.32, 0.57), ((0, 0, 2), -0.23, 0.10), ((2, 0, 0), 0.21, -0.09))
# Mean longitudes in degrees and their change a century: the Moon's node, the Sun, the Moon.
LONGITUDES = ((125.04452, -1934.136261), (280.4665, 36000.7698), (218.3165, 481267.8813))
#: Rounds of Kepler's equation; each is right to another power of the eccentricity.
ROUNDS = 6
#: Longitude in degrees of the place that sidereal time is given for where none is named (the core of an array in Europe).
REFERENCE_LONGITUDE = 6.869837


def centuries(days: Column) -> Column:
    """Julian centuries from J2000 of an MJD."""
    return (days - 51544.5) / 36525


def bound(values: dict[str, Column], of) -> Column:
    """of(struct of values), with each value computed once however often it is used."""
    return F.transform(F.array(F.struct(*(v.alias(k) for k, v in values.items()))), of)[0]


def heliocentric(t: Column, elements) -> Column:
    """struct(x, y, z) on the ecliptic of J2000, in astronomical units."""
    a, e, i, mean, perihelion, node = (p + q * t for p, q in elements)
    orbit = {"a": a, "e": e, "i": F.radians(i), "m": F.radians(mean - perihelion), "w": F.radians(perihelion - node), "o": F.radians(node)}

    def anomaly(k: Column) -> Column:
        v = k["m"]
        for _ in range(ROUNDS):
            v = k["m"] + k["e"] * F.sin(v)
        return v

    def turned(k: Column, s: Column) -> Column:
        return bound({"l": F.cos(k["w"]) * s["p"] - F.sin(k["w"]) * s["q"], "c": F.sin(k["w"]) * s["p"] + F.cos(k["w"]) * s["q"]}, lambda v: F.struct(
            (F.cos(k["o"]) * v["l"] - F.sin(k["o"]) * F.cos(k["i"]) * v["c"]).alias("x"), (F.sin(k["o"]) * v["l"] + F.cos(k["o"]) * F.cos(k["i"]) * v["c"]).alias("y"), (F.sin(k["i"]) * v["c"]).alias("z"),
        ))

    def placed(k: Column, v: Column) -> Column:
        return bound({"p": k["a"] * (F.cos(v) - k["e"]), "q": k["a"] * F.sqrt(1 - k["e"] * k["e"]) * F.sin(v)}, lambda s: turned(k, s))

    return bound(orbit, lambda k: bound({"v": anomaly(k)}, lambda v: placed(k, v["v"])))


def _equatorial(x: Column, y: Column, z: Column) -> Column:
    """struct(ra, decl) in degrees."""
    c, s = F.cos(F.radians(F.lit(OBLIQUITY[0]))), F.sin(F.radians(F.lit(OBLIQUITY[0])))
    return bound({"x": x, "u": c * y - s * z, "v": s * y + c * z}, lambda p: F.struct(
        F.pmod(F.degrees(F.atan2(p["u"], p["x"])), F.lit(360.0)).alias("ra"), F.degrees(F.atan2(p["v"], F.sqrt(p["x"] * p["x"] + p["u"] * p["u"]))).alias("decl"),
    ))


def sun(days: Column) -> Column:
    """struct(ra, decl) in degrees (J2000) of the Sun at an MJD; null parts at null."""
    return bound({"e": heliocentric(centuries(days), EARTH)}, lambda k: _equatorial(-k["e"]["x"], -k["e"]["y"], -k["e"]["z"]))


def jupiter(days: Column) -> Column:
    """struct(ra, decl) in degrees (J2000) of Jupiter at an MJD, seen from Earth; null parts at null."""
    t = centuries(days)
    return bound({"j": heliocentric(t, JUPITER), "e": heliocentric(t, EARTH)}, lambda k: _equatorial(*(k["j"][c] - k["e"][c] for c in "xyz")))


def nutation(days: Column) -> tuple[Column, Column, Column]:
    """Nutation in longitude and in obliquity, in arcseconds, and the true obliquity in degrees."""
    t = centuries(days)
    angles = [F.radians(p + q * t) for p, q in LONGITUDES]
    longitude, obliquity = F.lit(0.0), F.lit(0.0)
    for multiples, psi, eps in NUTATION:
        a = sum((n * v for n, v in zip(multiples, angles, strict=True) if n), F.lit(0.0))
        longitude, obliquity = longitude + psi * F.sin(a), obliquity + eps * F.cos(a)
    return longitude, obliquity, OBLIQUITY[0] + OBLIQUITY[1] * t + obliquity / 3600


def apparent_sidereal_degrees(days: Column, longitude: Column | None = None) -> Column:
    """Local apparent sidereal time of an MJD (UT): the mean one and the equation of the equinoxes."""
    psi, _, eps = nutation(days)
    mean = clock.sidereal_degrees(days, F.lit(REFERENCE_LONGITUDE) if longitude is None else longitude)
    return F.pmod(mean + psi * F.cos(F.radians(eps)) / 3600, F.lit(360.0))


def apparent_sidereal_seconds(days: Column, longitude: Column | None = None) -> Column:
    return apparent_sidereal_degrees(days, longitude) * 240


#: Bodies that move, by name.
BODIES = {"Sun": sun, "Jupiter": jupiter}
