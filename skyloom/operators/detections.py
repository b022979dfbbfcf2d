"""Detections of an image on the sky: position, errors, axes and angle from pixels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.functions import geometry as g

#: Pixels from a detection at which the direction of the y axis on the sky is taken.
STEP = 0.5


def on_sky(found: DataFrame, w: dict[str, Column], projection: str | Column = "SIN") -> DataFrame:
    """found(x, y, x_err, y_err, major, minor, theta, and errors of the axes; pixels, radians) with its place on the sky.

    ra, decl, their fit errors, pa (degrees from local north through east), north (that of the y axis) in degrees; semimajor,
    semiminor, their errors and error_radius in arcseconds. The errors of x and y are turned to local east and north
    before they are taken over to the sky; the error radius is the farthest corner of the box that they span. Where a
    corner has no place on the sky, errors and radius are infinite.
    """
    x, y, ex, ey = F.col("x"), F.col("y"), F.col("x_err"), F.col("y_err")

    def places(*at: tuple[Column, Column]) -> Column:
        """Sky positions of pixels: one function over an array, so that the projection is compiled once."""
        pixels = F.array(*(F.struct(i.alias("x"), j.alias("y")) for i, j in at))
        return F.transform(pixels, lambda p: F.struct(*(c.alias(n) for c, n in zip(g.sky_of_pixel(p["x"], p["y"], w, projection), ("ra", "decl"), strict=True))))

    at = found.withColumn("__p", places((x, y), (x, y + STEP)))
    at = at.withColumns({"ra": F.col("__p")[0]["ra"], "decl": F.col("__p")[0]["decl"]})
    at = at.withColumn("north", g.bearing(F.col("ra"), F.col("decl"), F.col("__p")[1]["ra"], F.col("__p")[1]["decl"]))
    t, s, c = F.radians("north"), F.sin("theta"), F.cos("theta")
    east = F.sqrt(F.pow(ex * F.cos(t), 2) + F.pow(ey * F.sin(t), 2))
    north = F.sqrt(F.pow(ex * F.sin(t), 2) + F.pow(ey * F.cos(t), 2))
    corners = ((x + i * ex, y + j * ey) for i in (1, -1) for j in (1, -1))
    ends = (x + east, y), (x, y + north), (x - s * F.col("major"), y + c * F.col("major")), (x + c * F.col("minor"), y + s * F.col("minor"))
    at = at.withColumn("__p", places(*ends, *corners))

    def of(p: Column) -> Column:
        """Degrees from the detection, along the sky, in right ascension and in declination; NaN where there is no such place."""
        off = F.isnan(p["ra"]) | F.isnan(p["decl"])
        apart = F.when(off, float("nan")).otherwise(g.distance_deg(F.col("ra"), F.col("decl"), p["ra"], p["decl"]))
        return F.struct(apart.alias("apart"), F.abs(F.pmod(p["ra"] - F.col("ra") + 180, F.lit(360.0)) - 180).alias("turn"), F.abs(p["decl"] - F.col("decl")).alias("rise"))

    at = at.withColumn("__d", F.transform("__p", of))
    d = lambda i, what: F.col("__d")[i][what]
    sure = lambda v: F.when(F.isnan(v) | v.isNull(), float("inf")).otherwise(v)
    out = at.withColumns({
        "ra_fit_err": sure(F.greatest(d(0, "turn"), d(1, "turn"))), "decl_fit_err": sure(F.greatest(d(0, "rise"), d(1, "rise"))), "error_radius": sure(3600 * F.greatest(*(d(i, "apart") for i in range(4, 8)))),
        "semimajor": 3600 * d(2, "apart"), "semiminor": 3600 * d(3, "apart"), "pa": F.pmod(F.degrees("theta") + F.col("north"), F.lit(180.0)),
    })
    out = out.withColumns({"semimajor_err": F.col("semimajor") / F.col("major") * F.col("major_err"), "semiminor_err": F.col("semiminor") / F.col("minor") * F.col("minor_err")})
    return out.drop("__p", "__d")
