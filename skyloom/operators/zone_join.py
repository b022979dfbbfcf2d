"""Positional joins: a theta join on the sky as an equi-join on cells of about a degree, with residual predicates."""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.functions import geometry as g

#: Degrees by which a reach is widened against rounding.
SLACK = 1e-6


def strips(decl: Column, radius: Column, size: float = 1) -> Column:
    """Every strip of `size` degrees that a cap of this radius touches."""
    return F.sequence(F.floor((decl - radius) / size).cast("int"), F.floor((decl + radius) / size).cast("int"))


def cells(strip: Column, size: float = 1) -> Column:
    """How many cells of right ascension a strip has: as many as its longer edge has degrees, or sizes."""
    edge = F.when(strip < 0, strip + 1).otherwise(strip) * size
    return F.greatest(F.lit(1), F.ceil(360 / size * F.cos(F.radians(F.least(F.abs(edge), F.lit(90)))))).cast("int")


def cell(strip: Column, ra: Column, size: float = 1) -> Column:
    n = cells(strip, size)
    return F.pmod(F.floor(ra / 360 * n).cast("int"), n)


def reached(strip: Column, ra: Column, decl: Column, radius: Column, size: float = 1) -> Column:
    """The cells of a strip that a cap may touch, once each, over right ascension 0 if need be."""
    n, reach = cells(strip, size), g.alpha_inflate(radius + SLACK, decl) + SLACK
    low = F.floor((ra - reach) / 360 * n).cast("int")
    high = F.least(F.floor((ra + reach) / 360 * n).cast("int"), low + n - 1)
    return F.transform(F.sequence(low, high), lambda c: F.pmod(c, n))


@cache
def _columns(decl: str, radius: float | str, zone: str, ra: str, far_ra: str) -> tuple[Column, Column, Column, Column]:
    """Strips and cells that a near row touches, the cell of a far row, and equality of both; made once."""
    reach = F.col(radius) if isinstance(radius, str) else F.lit(radius)
    return F.explode(strips(F.col(decl), reach)), F.explode(reached(F.col("__strip"), F.col(ra), F.col(decl), reach)), cell(F.col(zone), F.col(far_ra)), (F.col("__strip") == F.col(zone)) & (F.col("__cell") == F.col("__far_cell"))


def zone_join(near: DataFrame, far: DataFrame, decl: str, radius: float | str, zone: str, residual: Column, how: str = "inner", ra: str = "ra", far_ra: str = "wm_ra") -> DataFrame:
    """near rows with the far rows in reach. A far row lies in one cell, so a pair meets once and needs no distinct.

    near is the side that is exploded over strips and cells; the residual is part of the join. radius: degrees, or near's
    column of them. Without cells Spark would plan a product of both sides; with strips alone all pairs of a strip, of which
    there are 180, would meet.
    """
    strip, cells_, own, same = _columns(decl, radius, zone, ra, far_ra)
    spread = near.withColumn("__strip", strip).withColumn("__cell", cells_)
    return spread.join(far.withColumn("__far_cell", own), same & residual, how).drop("__strip", "__cell", "__far_cell")
