"""Data quality of columns: counters, merging, and the gate before diagnosis."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as C
from ..functions.guards import is_finite

PROFILE = ("temperature_k", "pressure_pa", "specific_humidity", "height_m")


class DataQualityError(ValueError):
    """Columns that would be diagnosed hold undefined values."""


def column_flags(levels: DataFrame, keys: list[str], *, threshold: float = 0.0) -> DataFrame:
    """One row per column: active and the three validity flags."""
    whole = None
    for name in PROFILE:
        whole = is_finite(F.col(name)) if whole is None else whole & is_finite(F.col(name))
    rain, ground = is_finite(F.col("total_precip_mm")), is_finite(F.col("ground_temperature_c"))
    return levels.groupBy(*keys).agg(
        F.bool_and(rain & (F.col("total_precip_mm") > threshold)).alias("active"), F.bool_and(rain).alias("rain_ok"), F.bool_and(ground).alias("ground_ok"), F.bool_and(whole).alias("profile_ok")
    )


def counters(flags: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The seven counters, over all columns or per group."""
    bad = {
        "total_columns": F.count("*"),
        "active_columns": F.count_if("active"),
        "invalid_total_precip_columns": F.count_if(~F.col("rain_ok")),
        "invalid_ground_temperature_columns": F.count_if(~F.col("ground_ok")),
        "invalid_profile_columns": F.count_if(~F.col("profile_ok")),
        "invalid_active_ground_temperature_columns": F.count_if(F.col("active") & ~F.col("ground_ok")),
        "invalid_active_profile_columns": F.count_if(F.col("active") & ~F.col("profile_ok")),
    }
    cols = [v.alias(k) for k, v in bad.items()]
    return flags.groupBy(*by).agg(*cols) if by else flags.agg(*cols)


def merge(counted: DataFrame, by: list[str]) -> DataFrame:
    """Sums of counters; a missing one counts as 0."""
    return counted.groupBy(*by).agg(*[F.sum(F.coalesce(F.col(c), F.lit(0))).alias(c) for c in C.QUALITY_COUNTERS])


def preview(flags: DataFrame, bad, key: str, limit: int = 5) -> DataFrame:
    """One row: the first keys of bad columns as text, with ``,...`` if there are more."""
    few = flags.where(bad).select(key).orderBy(key).limit(limit + 1).agg(F.sort_array(F.collect_list(key)).alias("k"))
    text = F.concat_ws(",", F.transform(F.slice("k", 1, limit), lambda x: x.cast("string")))
    return few.select(F.concat(text, F.when(F.size("k") > limit, ",...").otherwise("")).alias("preview"))


def gate(flags: DataFrame, key: str) -> dict[str, int]:
    """Counters as a dict; raises DataQualityError in the order precipitation, ground, profile."""
    found = counters(flags).first().asDict()
    if found["invalid_total_precip_columns"]:
        raise DataQualityError(f"precipitation is not finite in {found['invalid_total_precip_columns']} column(s)")
    for counter, flag, what in (("invalid_active_ground_temperature_columns", "ground_ok", "ground temperature"), ("invalid_active_profile_columns", "profile_ok", "temperature, pressure, humidity or height")):
        if found[counter]:
            where = preview(flags, F.col("active") & ~F.col(flag), key).first()[0]
            raise DataQualityError(f"{what} is not finite in active column(s): {where}")
    return found


def level_shape(levels: DataFrame, keys: list[str], expected: int) -> DataFrame:
    """Columns whose number of levels isn't the expected one (or has repeated levels)."""
    return levels.groupBy(*keys).agg(F.count("*").alias("n_levels"), F.countDistinct("lev").alias("n_distinct")).where((F.col("n_levels") != expected) | (F.col("n_distinct") != expected))
