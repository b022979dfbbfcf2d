"""Values with errors, as struct<value,error> columns with first-order propagation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def uncertain(value, error=0.0) -> Column:
    lift = lambda x: x if isinstance(x, Column) else F.lit(float(x))
    return F.struct(lift(value).cast("double").alias("value"), lift(error).cast("double").alias("error"))


def _of(value: Column, variance: Column) -> Column:
    return uncertain(value, F.sqrt(variance))


def add(a: Column, b: Column) -> Column:
    return _of(a["value"] + b["value"], a["error"] * a["error"] + b["error"] * b["error"])


def subtract(a: Column, b: Column) -> Column:
    return _of(a["value"] - b["value"], a["error"] * a["error"] + b["error"] * b["error"])


def multiply(a: Column, b: Column) -> Column:
    return _of(a["value"] * b["value"], F.pow(a["error"] * b["value"], 2) + F.pow(b["error"] * a["value"], 2))


def divide(a: Column, b: Column) -> Column:
    """Null where the divisor is 0."""
    d = F.nullif(b["value"], F.lit(0.0))
    return _of(a["value"] / d, F.pow(a["error"] / d, 2) + F.pow(b["error"] * a["value"] / (d * d), 2))


def power(a: Column, n: float) -> Column:
    return uncertain(F.pow(a["value"], F.lit(float(n))), F.abs(n * F.pow(a["value"], F.lit(n - 1.0)) * a["error"]))


def negative(a: Column) -> Column:
    return uncertain(-a["value"], a["error"])


def absolute(a: Column) -> Column:
    return uncertain(F.abs(a["value"]), a["error"])


def exp(a: Column) -> Column:
    return uncertain(F.exp(a["value"]), F.exp(a["value"]) * a["error"])


def log(a: Column) -> Column:
    return uncertain(F.log(a["value"]), F.abs(a["error"] / a["value"]))


def rounded(a: Column, digits: int = 0) -> Column:
    return uncertain(F.round(a["value"], digits), F.round(a["error"], digits))


def upper(a: Column) -> Column:
    return a["value"] + a["error"]


def lower(a: Column) -> Column:
    return a["value"] - a["error"]


def surely_less(a: Column, b: Column) -> Column:
    """Below beyond the joint error."""
    return b["value"] - a["value"] > F.sqrt(a["error"] * a["error"] + b["error"] * b["error"])


def surely_greater(a: Column, b: Column) -> Column:
    return surely_less(b, a)
