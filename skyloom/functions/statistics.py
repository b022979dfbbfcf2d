"""Running and weighted statistics of lightcurves as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

#: Below this the variance is rounding noise.
FLOOR = 8e-14


def weight(error: Column) -> Column:
    return 1 / (error * error)


def flux_means(flux: Column, error: Column, name: str, over: WindowSpec | None = None) -> dict[str, Column]:
    """The five averages kept of a flux: of f, f**2, w, w*f and w*f**2, with w = 1/error**2."""
    w = weight(error)
    terms = {f"avg_{name}": flux, f"avg_{name}_sq": flux * flux, f"avg_{name}_weight": w, f"avg_weighted_{name}": w * flux, f"avg_weighted_{name}_sq": w * flux * flux}
    return {k: F.avg(v).over(over) if over is not None else F.avg(v) for k, v in terms.items()}


def grown(n: Column, mean: Column, x: Column) -> Column:
    """The average of n + 1 values, from that of n (none: n is null) and one more."""
    k = F.coalesce(n, F.lit(0))
    return (k * F.coalesce(mean, F.lit(0.0)) + x) / (k + 1)


def v_int(n: Column, mean: Column, mean_sq: Column) -> Column:
    """Coefficient of variation: sample deviation over mean."""
    spread = mean_sq - mean * mean
    root = F.when(F.abs(spread) < FLOOR, 0.0).otherwise(F.sqrt(F.greatest(F.lit(0.0), n * spread / F.greatest(n - 1, F.lit(1)))))
    return F.when(n == 1, 0.0).otherwise(root / F.when(mean == 0, 1e-6).otherwise(mean))


def eta_int(n: Column, w: Column, wf: Column, wf2: Column) -> Column:
    """Reduced chi-square of a constant flux."""
    return F.when(n == 1, 0.0).otherwise(n / F.greatest(n - 1, F.lit(1)) * (w * wf2 - wf * wf) / w)


def weighted_mean(x: Column, w: Column) -> Column:
    return F.sum(x * w) / F.sum(w)


def weighted_mean_sigma(w: Column) -> Column:
    return F.sqrt(1 / F.sum(w))


def weighted_sigma(x: Column, w: Column) -> Column:
    """Sample deviation of weighted values: sum w (x - m)**2 * V1 / (V1**2 - V2)."""
    v1, v2 = F.sum(w), F.sum(w * w)
    scatter = F.sum(w * x * x) - F.sum(w * x) * F.sum(w * x) / v1
    return F.sqrt(F.greatest(F.lit(0.0), scatter * v1 / F.nullif(v1 * v1 - v2, F.lit(0.0))))


def substitute_inf(c: Column, value="Infinity") -> Column:
    """A string form with text for infinite values; NaN stays."""
    return F.when(F.abs(c) == float("inf"), F.lit(value)).otherwise(c.cast("string"))


def substitute_nan(c: Column, value: float = 0.0) -> Column:
    return F.nanvl(c, F.lit(value))


def nice(c: Column) -> Column:
    return F.format_string("%.2e", c)
