"""The synthetic benchmark grid: closed-form columns, made on the executors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _line(a: float, b: float, n: int, k: Column) -> Column:
    return a + k * ((b - a) / max(1, n - 1))


def synthetic_levels(spark: SparkSession, n_columns: int = 20_000, n_levels: int = 80) -> DataFrame:
    """Levels (cell_id, lev, height_m, temperature_k, ...): half the columns at 1.5 mm, a quarter at 0.2, a quarter dry.

    Even columns have a warm nose of eight levels from the middle down; every fourth (from the second)
    is colder in its lowest eight levels.
    """
    c, k = F.col("cell_id"), F.col("lev")
    grid = spark.range(n_columns).select(F.col("id").alias("cell_id"), F.explode(F.sequence(F.lit(0), F.lit(n_levels - 1))).alias("lev"))
    half = lambda i: 10000.0 - i * (10000.0 / n_levels)
    nose = F.when((c % 2 == 0) & (k >= n_levels // 2) & (k < min(n_levels // 2 + 8, n_levels)), 8.0).otherwise(0.0)
    cold = F.when((c % 4 == 1) & (k >= n_levels - 8), 4.0).otherwise(0.0)
    return grid.select(
        "cell_id", "lev",
        (0.5 * (half(k) + half(k + 1))).alias("height_m"),
        (_line(253.15, 279.15, n_levels, k) + nose - cold).alias("temperature_k"),
        _line(30000.0, 100000.0, n_levels, k).alias("pressure_pa"),
        _line(0.0004, 0.0040, n_levels, k).alias("specific_humidity"),
        F.when(c < n_columns // 2, 1.5).when(c < 3 * n_columns // 4, 0.2).otherwise(0.0).alias("total_precip_mm"),
        F.when(c % 3 == 0, -4.0).otherwise(2.0).alias("ground_temperature_c"),
    )


def synthetic_arrays(spark: SparkSession, n_columns: int = 20_000, n_levels: int = 80) -> DataFrame:
    """The same grid with one array per quantity, row by row."""
    k = F.sequence(F.lit(0), F.lit(n_levels - 1))
    c = F.col("cell_id")
    nose = lambda i: F.when((c % 2 == 0) & (i >= n_levels // 2) & (i < min(n_levels // 2 + 8, n_levels)), 8.0).otherwise(0.0)
    cold = lambda i: F.when((c % 4 == 1) & (i >= n_levels - 8), 4.0).otherwise(0.0)
    half = lambda i: 10000.0 - i * (10000.0 / n_levels)
    return spark.range(n_columns).select(F.col("id").alias("cell_id")).select(
        "cell_id",
        F.transform(k, lambda i: 0.5 * (half(i) + half(i + 1))).alias("height_m"),
        F.transform(k, lambda i: _line(253.15, 279.15, n_levels, i) + nose(i) - cold(i)).alias("temperature_k"),
        F.transform(k, lambda i: _line(30000.0, 100000.0, n_levels, i)).alias("pressure_pa"),
        F.transform(k, lambda i: _line(0.0004, 0.0040, n_levels, i)).alias("specific_humidity"),
        F.when(c < n_columns // 2, 1.5).when(c < 3 * n_columns // 4, 0.2).otherwise(0.0).alias("total_precip_mm"),
        F.when(c % 3 == 0, -4.0).otherwise(2.0).alias("ground_temperature_c"),
    )
