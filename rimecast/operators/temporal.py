"""Hourly amounts from accumulated ones, along the forecast steps of each column."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def deaccumulate(acc: DataFrame, keys: list[str], *, value: str = "tot_prec", out: str = "total_precip_mm") -> DataFrame:
    """Difference to the step before; the first step of a column keeps its own value. A predecessor
    that is NULL or NaN makes the difference undefined, not the first step."""
    order = Window.partitionBy(*keys).orderBy("step")
    before, first = F.lag(value).over(order), F.row_number().over(order) == 1
    return acc.withColumn(out, F.when(first, F.col(value)).otherwise(F.col(value) - before))


def step_chunks(steps: DataFrame, size: int) -> DataFrame:
    """Runs of ``size`` steps (the last may be shorter): chunk, first, last, n, range text."""
    from ..functions.tokens import step_range

    if size <= 0:
        raise ValueError(f"the chunk size must be positive, got {size}")
    out = steps.select("step").distinct().groupBy(F.floor(F.col("step") / size).alias("chunk")).agg(F.min("step").alias("first"), F.max("step").alias("last"), F.count("*").alias("n"))
    return out.withColumn("steps", step_range(F.col("first"), F.col("last"), F.col("n")))
