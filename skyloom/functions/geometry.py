"""Sky geometry as column expressions. Angles are degrees unless a name says otherwise."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def clamp(c: Column, low: float = -1.0, high: float = 1.0) -> Column:
    return F.least(F.lit(high), F.greatest(F.lit(low), c))


def zone(decl: Column) -> Column:
    """The one-degree declination strip."""
    return F.floor(decl).cast("int")


def cartesian(ra: Column, decl: Column) -> tuple[Column, Column, Column]:
    d = F.radians(decl)
    return F.cos(d) * F.cos(F.radians(ra)), F.cos(d) * F.sin(F.radians(ra)), F.sin(d)


def alpha_inflate(theta: Column, decl: Column) -> Column:
    """How far right ascension spreads over a radius theta; 180 near a pole."""
    root = F.sqrt(F.abs(F.cos(F.radians(decl - theta)) * F.cos(F.radians(decl + theta))))
    near_pole = F.abs(decl) + theta > 89.9
    return F.when(near_pole, 180.0).otherwise(F.degrees(F.abs(F.atan(F.sin(F.radians(theta)) / F.when(near_pole, 1.0).otherwise(root)))))


def chord_deg(dx: Column, dy: Column, dz: Column) -> Column:
    """The angle that a chord of the unit sphere spans."""
    return F.degrees(2 * F.asin(clamp(F.sqrt(dx * dx + dy * dy + dz * dz) / 2, 0.0)))


def distance_deg(ra1: Column, d1: Column, ra2: Column, d2: Column) -> Column:
    a, b = cartesian(ra1, d1), cartesian(ra2, d2)
    return chord_deg(*(p - q for p, q in zip(a, b, strict=True)))


def angsep_arcsec(ra1: Column, d1: Column, ra2: Column, d2: Column) -> Column:
    """Spherical law of cosines, clamped."""
    c = F.sin(F.radians(d1)) * F.sin(F.radians(d2)) + F.cos(F.radians(d1)) * F.cos(F.radians(d2)) * F.cos(F.radians(ra1 - ra2))
    return 3600 * F.degrees(F.acos(clamp(c)))


def alphasep_arcsec(ra1: Column, ra2: Column, d1: Column, d2: Column) -> Column:
    return 3600 * (ra1 - ra2) * F.cos(F.radians((d1 + d2) / 2))


def deltasep_arcsec(d1: Column, d2: Column) -> Column:
    return 3600 * (d1 - d2)


def wrapped(ra: Column) -> Column:
    """Right ascension turned half round, with the eight decimals at which the catalogue compares near the meridian."""
    return ((ra + 180).cast("decimal(11,8)") % F.lit(360)).cast("double")


def ra_difference(ra1: Column, ra2: Column, across: Column | bool = False) -> Column:
    """ra1 - ra2, on the turned scale where the field crosses the meridian and ra2 is within 90 degrees of it."""
    plain = ra1 - ra2
    if across is False:
        return plain
    return F.when(F.lit(across) & ((ra2 < 90) | (ra2 > 270)), wrapped(ra1) - wrapped(ra2)).otherwise(plain)


def de_ruiter(dra: Column, d1: Column, d2: Column, uew1: Column, uew2: Column, uns1: Column, uns2: Column) -> Column:
    """Position difference in units of its uncertainty."""
    east = dra * F.cos(F.radians((d1 + d2) / 2))
    return F.sqrt(east * east / (uew1 * uew1 + uew2 * uew2) + (d1 - d2) * (d1 - d2) / (uns1 * uns1 + uns2 * uns2))


def lm_alpha(l: Column, m: Column, ra0: Column, d0: Column) -> Column:
    n = F.sqrt(1 - l * l - m * m)
    return ra0 + F.degrees(F.atan2(l, n * F.cos(F.radians(d0)) - m * F.sin(F.radians(d0))))


def lm_delta(l: Column, m: Column, d0: Column) -> Column:
    return F.degrees(F.asin(clamp(m * F.cos(F.radians(d0)) + F.sqrt(1 - l * l - m * m) * F.sin(F.radians(d0)))))


def radec_to_lmn(ra0: Column, d0: Column, ra: Column, d: Column) -> tuple[Column, Column, Column]:
    """Direction cosines; all arguments in radians. On the equator m is sin(d), the limit of the general form."""
    l = F.cos(d) * F.sin(ra - ra0)
    m = F.sin(d) * F.cos(d0) - F.cos(d) * F.sin(d0) * F.cos(ra - ra0)
    return l, m, F.sqrt(F.greatest(F.lit(0.0), 1 - l * l - m * m))


def l_pixels(ra: Column, d: Column, ra0: Column, step: Column) -> Column:
    return F.cos(F.radians(d)) * F.sin(F.radians(ra - ra0)) / F.radians(step)


def m_pixels(ra: Column, d: Column, ra0: Column, d0: Column, step: Column) -> Column:
    return (F.sin(F.radians(d)) * F.cos(F.radians(d0)) - F.cos(F.radians(d)) * F.sin(F.radians(d0)) * F.cos(F.radians(ra - ra0))) / F.radians(step)


def gaussian(height: Column, x0: Column, y0: Column, major: Column, minor: Column, theta: Column, x: Column, y: Column) -> Column:
    """An elliptical Gaussian of half-width axes; theta in radians, from the y axis."""
    a = (F.cos(theta) * (x - x0) + F.sin(theta) * (y - y0)) / minor
    b = (F.cos(theta) * (y - y0) - F.sin(theta) * (x - x0)) / major
    return height * F.exp(-F.log(F.lit(2.0)) * (a * a + b * b))


# IAU rotation of J2000 equatorial to galactic axes.
TO_GALACTIC = (
    (-0.0548755604162154, -0.8734370902348850, -0.4838350155487132),
    (0.4941094278755837, -0.4448296299600112, 0.7469822444972189),
    (-0.8676661490190047, -0.1980763734312015, 0.4559837761750669),
)
# Precession of FK4 B1950 axes to FK5 J2000.
TO_J2000 = (
    (0.9999256782, -0.0111820611, -0.0048579477),
    (0.0111820610, 0.9999374784, -0.0000271765),
    (0.0048579479, -0.0000271474, 0.9999881997),
)


def transposed(m):
    return tuple(zip(*m, strict=True))


def rotated(lon: Column, lat: Column, m) -> tuple[Column, Column]:
    """Longitude in [0, 360) and latitude after a rotation of the axes."""
    v = cartesian(lon, lat)
    x, y, z = (sum((v[j] * m[i][j] for j in range(1, 3)), v[0] * m[i][0]) for i in range(3))
    a = F.degrees(F.atan2(y, x))
    return F.when(a < 0, a + 360).otherwise(a), F.degrees(F.asin(clamp(z)))


def eq_to_gal(ra: Column, decl: Column) -> tuple[Column, Column]:
    return rotated(ra, decl, TO_GALACTIC)


def gal_to_eq(lon: Column, lat: Column) -> tuple[Column, Column]:
    return rotated(lon, lat, transposed(TO_GALACTIC))


def b1950_to_j2000(ra: Column, decl: Column) -> tuple[Column, Column]:
    return rotated(ra, decl, TO_J2000)


def j2000_to_b1950(ra: Column, decl: Column) -> tuple[Column, Column]:
    return rotated(ra, decl, transposed(TO_J2000))


def _angle(name: str, r: Column) -> Column:
    """The angle from the reference position that a distance on the plane of a zenithal projection stands for, in radians."""
    return {"SIN": lambda: F.asin(clamp(r)), "TAN": lambda: F.atan(r), "ARC": lambda: r, "STG": lambda: 2 * F.atan(r / 2), "ZEA": lambda: 2 * F.asin(clamp(r / 2))}[name]()


def _plane(name: str, t: Column) -> Column:
    """The distance on the plane for an angle."""
    return {"SIN": lambda: F.sin(t), "TAN": lambda: F.tan(t), "ARC": lambda: t, "STG": lambda: 2 * F.tan(t / 2), "ZEA": lambda: 2 * F.sin(t / 2)}[name]()


ZENITHAL = ("SIN", "TAN", "ARC", "STG", "ZEA")
PROJECTIONS = (*ZENITHAL, "NCP")


def _by_name(projection: str | Column, of) -> Column:
    """of(name) for a projection's name, or for that in a column; another name is an error, not a silent choice."""
    if isinstance(projection, str):
        if projection not in PROJECTIONS:
            raise ValueError(f"no projection {projection}")
        return of(projection)
    out = F.raise_error(F.concat(F.lit("no projection "), F.coalesce(projection, F.lit("null")))).cast("double")
    for name in reversed(PROJECTIONS):
        out = F.when(projection == name, of(name)).otherwise(out)
    return out


def _turned(x: Column, y: Column, w: dict[str, Column]) -> tuple[Column, Column]:
    dx, dy = (x - w["crpix1"]) * w["cdelt1"], (y - w["crpix2"]) * w["cdelt2"]
    r = F.radians(w["crota2"])
    return F.radians(dx * F.cos(r) - dy * F.sin(r)), F.radians(dx * F.sin(r) + dy * F.cos(r))


def sky_of_pixel(x: Column, y: Column, w: dict[str, Column], projection: str | Column = "SIN") -> tuple[Column, Column]:
    """WCS pixel (from 1) to sky, with reference pixel crpix1/2, value crval1/2, step cdelt1/2 and crota2.

    projection: one of PROJECTIONS, or a column of such names. Where a projection has no such position (outside its disc), NaN.
    """
    u, v = _turned(x, y, w)
    d0 = F.radians(w["crval2"])
    r = F.sqrt(u * u + v * v)
    nan = F.lit(float("nan"))

    def lmn(name: str) -> tuple[Column, Column, Column]:
        if name == "SIN":
            n = F.sqrt(1 - u * u - v * v)
            return u, v, n
        if name == "TAN":
            n = 1 / F.sqrt(1 + u * u + v * v)
            return u * n, v * n, n
        t = _angle(name, r)
        k = F.when(r == 0, 1.0).otherwise(F.sin(t) / r)
        return u * k, v * k, F.when(r > (2.0 if name == "ZEA" else math.pi if name == "ARC" else float("inf")), nan).otherwise(F.cos(t))

    def decl(name: str) -> Column:
        if name == "NCP":
            # the cosine of the declination is a length, sound also at a right angle from the reference
            q = F.cos(d0) - v * F.sin(d0)
            c = F.sqrt(u * u + q * q)
            return F.when(c > 1, nan).otherwise(F.degrees(F.acos(clamp(c))) * F.signum(d0))
        l, m, n = lmn(name)
        return F.when(F.isnan(n), nan).otherwise(F.degrees(F.asin(clamp(m * F.cos(d0) + n * F.sin(d0)))))

    def ra(name: str) -> Column:
        if name == "NCP":
            return F.degrees(F.atan2(u, F.cos(d0) - v * F.sin(d0)))
        l, m, n = lmn(name)
        return F.degrees(F.atan2(l, n * F.cos(d0) - m * F.sin(d0)))

    return F.pmod(w["crval1"] + _by_name(projection, ra), F.lit(360.0)), _by_name(projection, decl)


def pixel_of_sky(ra: Column, decl: Column, w: dict[str, Column], projection: str | Column = "SIN") -> tuple[Column, Column]:
    """The inverse of sky_of_pixel. Positions on the far side of the sky have no pixel in SIN and TAN: NaN."""
    l, m, n = radec_to_lmn(F.radians(w["crval1"]), F.radians(w["crval2"]), F.radians(ra), F.radians(decl))
    d0 = F.radians(w["crval2"])
    # the angle from the reference position, from 0 to pi, and its cosine with a sign
    c = F.sin(F.radians(decl)) * F.sin(d0) + F.cos(F.radians(decl)) * F.cos(d0) * F.cos(F.radians(ra) - F.radians(w["crval1"]))
    s = F.sqrt(l * l + m * m)
    t = F.atan2(s, c)

    def plane(name: str, own: Column, other: bool) -> Column:
        if name == "NCP":
            return F.degrees(l) if not other else F.degrees((F.cos(d0) - F.cos(F.radians(decl)) * F.cos(F.radians(ra) - F.radians(w["crval1"]))) / F.sin(d0))
        if name == "SIN":
            return F.degrees(own)
        if name == "TAN":
            return F.degrees(own / n)
        return F.degrees(own * F.when(s == 0, 1.0).otherwise(_plane(name, t) / s))

    def seen(name: str, value: Column) -> Column:
        return F.when(c < 0, F.lit(float("nan"))).otherwise(value) if name in ("SIN", "TAN") else value

    u, v = (_by_name(projection, lambda name, own=own, other=other: seen(name, plane(name, own, other))) for own, other in ((l, False), (m, True)))
    r = F.radians(w["crota2"])
    return (u * F.cos(r) + v * F.sin(r)) / w["cdelt1"] + w["crpix1"], (v * F.cos(r) - u * F.sin(r)) / w["cdelt2"] + w["crpix2"]


def bearing(ra1: Column, d1: Column, ra2: Column, d2: Column) -> Column:
    """Degrees from north through east in which the second position lies, seen from the first."""
    a, b, turn = F.radians(d1), F.radians(d2), F.radians(ra2 - ra1)
    return F.degrees(F.atan2(F.sin(turn) * F.cos(b), F.cos(a) * F.sin(b) - F.sin(a) * F.cos(b) * F.cos(turn)))
