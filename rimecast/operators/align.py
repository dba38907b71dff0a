"""Putting fields (one value per parameter, step, level and cell) side by side as levels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as C
from ..functions.thermo import celsius

LEVEL_PARAMS = ("T", "P", "QV")


def last_of_each(fields: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Of repeated fields the last one counts."""
    rank, latest = "rank_of_repeated", Window.partitionBy(*keys).orderBy(F.desc(order))
    return fields.withColumn(rank, F.row_number().over(latest)).where(F.col(rank) == 1).drop(rank)


def align_levels(fields: DataFrame, keys: list[str]) -> DataFrame:
    """Pivot level parameters (param_id, value) to temperature_k, pressure_pa, specific_humidity.

    One conditional aggregate over the keys and the level: no join of three scans. A level that lacks a
    parameter, or has it twice, is an error that names it.
    """
    pick = {"temperature_k": "T", "pressure_pa": "P", "specific_humidity": "QV"}
    cols = [F.max(F.when(F.col("param_id") == C.PARAMS[p], F.col("value"))).alias(n) for n, p in pick.items()]
    used = fields.where(F.col("param_id").isin(*[C.PARAMS[p] for p in LEVEL_PARAMS]))
    counted = [F.count_if(F.col("param_id") == C.PARAMS[p]).alias(f"n_{p}") for p in LEVEL_PARAMS]
    out = used.groupBy(*keys, "lev").agg(*cols, *counted)
    where = F.concat_ws(", ", *[F.concat(F.lit(f"{k} "), F.col(k).cast("string")) for k in [*keys, "lev"]])
    said = [F.when(F.col(f"n_{p}") != 1, F.concat(F.lit(f"{p}: expected 1 value, got "), F.col(f"n_{p}").cast("string"), F.lit(" at "), where)) for p in LEVEL_PARAMS]
    wrong = F.coalesce(*said)
    # the check hangs on a column that is used, so that it can't be pruned away
    first = next(iter(pick))
    return out.withColumn(first, F.when(wrong.isNotNull(), F.raise_error(wrong).cast("double")).otherwise(F.col(first))).select(*keys, "lev", *pick)


def attach_surface(levels: DataFrame, surface: DataFrame, keys: list[str]) -> DataFrame:
    """Add total_precip_mm and the ground temperature (K in, deg C out) of each column and step."""
    ground = surface.select(*keys, "total_precip_mm", celsius(F.col("ground_temperature_k")).alias("ground_temperature_c"))
    return levels.join(ground, keys)


def attach_heights(levels: DataFrame, heights: DataFrame, on: list[str], *, rows_for_broadcast: int = 2_000_000) -> DataFrame:
    """Add the static heights, which have no step; they are broadcast only if their count allows it."""
    small = heights.limit(rows_for_broadcast + 1).count() <= rows_for_broadcast
    return levels.join(F.broadcast(heights) if small else heights, on)


def param_names(fields: DataFrame) -> DataFrame:
    """Adds param, the name of param_id; an unknown id is an error."""
    known = F.create_map(*[F.lit(x) for n, i in C.PARAMS.items() for x in (i, n)])
    name = known[F.col("param_id")]
    return fields.withColumn("param", F.when(name.isNull(), F.raise_error(F.concat(F.lit("unknown parameter "), F.col("param_id").cast("string")))).otherwise(name))
