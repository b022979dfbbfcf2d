"""False-discovery threshold over pixels that no single task holds."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Pixels of like signal-to-noise ratio are ranked together, in steps of 1 / STEPS.
STEPS = 256


def tail(z: Column) -> Column:
    """Share of a normal distribution above z, by a continued fraction's rational form (Hastings; error below 7.5e-8)."""
    t = 1 / (1 + 0.2316419 * F.abs(z))
    # Coefficients of the published approximation.
    series = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    half = F.exp(-z * z / 2) / math.sqrt(2 * math.pi) * series
    return F.when(z >= 0, half).otherwise(1 - half)


def correlated(beam_area: float) -> float:
    """The harmonic sum that eases the line's slope for the pixels which a beam's area correlates."""
    return sum(1 / i for i in range(1, max(1, round(beam_area)) + 1))


def fdr_threshold(pixels: DataFrame, alpha: float, beam_area: float = 1.0, by: str = "image") -> DataFrame:
    """pixels(by, snr) -> by, threshold, accepted: the least ratio whose tail lies under alpha * rank / (pixels * correlated).

    Ranks descend in snr; equal ratios count as ranked one after the other, so the last of them decides. Only the upper
    half is looked at. Ranks are found in two steps: counts of classes of like ratio, which are short tables summed before
    the shuffle, and then the place of a value among its class. No task has more than the distinct values of one class.
    Without a pixel under the line there is no row; null and NaN ratios count as no pixels.
    """
    own = pixels.filter(F.col("snr").isNotNull() & ~F.isnan("snr")).groupBy(by, "snr").agg(F.count("*").alias("c")).withColumn("step", F.floor(F.col("snr") * STEPS))
    classes = own.groupBy(by, "step").agg(F.sum("c").alias("c"))
    whole = Window.partitionBy(by)  # a row for each class of an image
    above = classes.select(by, "step", (F.sum("c").over(whole.orderBy(F.col("step").desc())) - F.col("c")).alias("above"), F.sum("c").over(whole).alias("n"))
    within = Window.partitionBy(by, "step").orderBy(F.col("snr").desc())
    ranked = own.withColumn("place", F.sum("c").over(within)).join(above, [by, "step"]).withColumn("rank", F.col("above") + F.col("place"))
    # of equal ratios the last rank that is in the upper half and under the line
    last = F.least(F.col("rank"), F.greatest(F.lit(1), F.floor(F.col("n") / 2)))
    under = ranked.filter((last > F.col("rank") - F.col("c")) & (tail(F.col("snr")) < alpha * last / (F.col("n") * correlated(beam_area)))).withColumn("last", last)
    return under.groupBy(by).agg(F.min("snr").alias("threshold"), F.max("last").alias("accepted"))
