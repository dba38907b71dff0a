"""Column helpers for IEEE edge cases: internally an undefined number is NULL, never NaN."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")


def is_finite(x: Column) -> Column:
    return F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(INF)), F.lit(False))


def defined(x: Column) -> Column:
    """NaN becomes NULL, so that aggregates and comparisons pass over it."""
    return F.when(~F.isnan(x), x)


def clip100(x: Column) -> Column:
    return F.when(x < 0, 0.0).when(x > 100, 100.0).otherwise(x)


def log(x: Column) -> Column:
    """Natural logarithm: minus infinity at zero, NULL below."""
    return F.when(x > 0, F.ln(x)).when(x == 0, F.lit(-INF))


def ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)
