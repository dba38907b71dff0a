"""Moist and dry layers of a column, and the probability that its precipitation is ice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as C
from ..functions.classify import ice_probability


def mark_layers(levels: DataFrame, keys: list[str]) -> DataFrame:
    """Adds moist (RH over ice above the threshold) and layer (a running number from the top)."""
    down = Window.partitionBy(*keys).orderBy("lev")
    out = levels.withColumn("moist", F.coalesce(F.col("rh_ice_pct") > C.RH_ICE_PRECIP, F.lit(False)))
    new = F.when(F.col("moist") != F.lag("moist").over(down), 1).otherwise(0)
    return out.withColumn("_new", new).withColumn("layer", F.sum("_new").over(down)).drop("_new")


def layers(marked: DataFrame, keys: list[str], *more: Column) -> DataFrame:
    """One row per layer: moist, first_lev, n_levels, depth_m, coldest_c, and further aggregates."""
    h = F.nanvl("height_m", F.lit(None).cast("double"))
    return marked.groupBy(*keys, "layer").agg(
        F.first("moist").alias("moist"), F.min("lev").alias("first_lev"), F.count("*").alias("n_levels"), (F.max(h) - F.min(h)).alias("depth_m"), F.min("temperature_c").alias("coldest_c"), *more
    )


def ice_probabilities(rows: DataFrame, keys: list[str], **more: Column) -> DataFrame:
    """Per column: generated and ice for the strict rule (deep moist layers only) and the relaxed one,
    and further aggregates over its layers.

    A moist layer counts only if no deep dry layer lies below it. Relaxed, any moist layer may
    generate, and if none counts the lowest one does.
    """
    every = Window.partitionBy(*keys)
    dry_start = F.max(F.when(~F.col("moist") & (F.col("depth_m") > C.SUBLIMATION_DEPTH), F.col("first_lev"))).over(every)
    t = rows.withColumn("_clear", F.col("moist") & (F.col("first_lev") > F.coalesce(dry_start, F.lit(-1))))
    strict = F.col("_clear") & (F.col("depth_m") > C.GENERATION_DEPTH)
    agg = t.groupBy(*keys).agg(
        F.max(strict).alias("generated"),
        F.min(F.when(strict, F.col("coldest_c"))).alias("_strict"),
        F.max("moist").alias("relaxed_generated"),
        F.min(F.when(F.col("_clear"), F.col("coldest_c"))).alias("_clear"),
        F.max_by(F.col("coldest_c"), F.when(F.col("moist"), F.col("first_lev"))).alias("_lowest"),
        *[v.alias(k) for k, v in more.items()],
    )
    agg = agg.withColumn("_relaxed", F.coalesce("_clear", "_lowest"))
    return agg.select(
        *keys, "generated", F.when(F.col("generated"), ice_probability(F.col("_strict"))).otherwise(0.0).alias("ice"),
        "relaxed_generated", F.when(F.col("relaxed_generated"), ice_probability(F.col("_relaxed"))).otherwise(0.0).alias("relaxed_ice"), *more,
    )
