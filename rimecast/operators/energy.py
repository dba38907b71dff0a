"""Melting and freezing areas of the wet-bulb curve.

Levels run from the top (lowest ``lev``) to the surface. Zero or undefined values take the sign
above, leading ones the first sign below, a column without any sign is warm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as C


def fill_signs(levels: DataFrame, keys: list[str]) -> DataFrame:
    """Adds sign (-1 or 1) of wet_bulb_c."""
    down = Window.partitionBy(*keys).orderBy("lev")
    own = F.when(F.isnan("wet_bulb_c"), None).when(F.col("wet_bulb_c") > 0, 1).when(F.col("wet_bulb_c") < 0, -1)
    out = levels.withColumn("_own", own)
    above = F.last("_own", ignorenulls=True).over(down.rowsBetween(Window.unboundedPreceding, 0))
    below = F.first("_own", ignorenulls=True).over(down.rowsBetween(0, Window.unboundedFollowing))
    return out.withColumn("sign", F.coalesce(above, below, F.lit(1))).drop("_own")


def mark_segments(signed: DataFrame, keys: list[str]) -> DataFrame:
    """Adds segment (a running number) and term, the energy between a level and the next of its segment."""
    down = Window.partitionBy(*keys).orderBy("lev")
    new = F.when(F.col("sign") != F.lag("sign").over(down), 1).otherwise(0)
    mean = 0.5 * (F.col("wet_bulb_c") + F.lead("wet_bulb_c").over(down))
    drop = F.col("height_m") - F.lead("height_m").over(down)
    term = F.when(F.lead("sign").over(down) == F.col("sign"), mean / C.KELVIN * drop * C.GRAVITY)
    return signed.withColumns({"_new": new, "term": F.nanvl(term, F.lit(None).cast("double"))}).withColumn("segment", F.sum("_new").over(down)).drop("_new")


def segments(marked: DataFrame, keys: list[str]) -> DataFrame:
    """One row per segment: sign, first_lev, n_levels, energy (J/kg)."""
    return marked.groupBy(*keys, "segment").agg(F.first("sign").alias("sign"), F.min("lev").alias("first_lev"), F.count("*").alias("n_levels"), F.coalesce(F.sum("term"), F.lit(0.0)).alias("energy"))


def merged_areas(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Areas that count: the topmost segment is left out, then small ones; what then adjoins
    with equal sign is added up. Columns without an area have no row. rank: 1 is nearest the surface."""
    order = Window.partitionBy(*keys).orderBy("segment")
    big = rows.where((F.col("segment") > 0) & (F.abs("energy") >= C.LEAST_AREA)).withColumn("_s", F.signum("energy"))
    new = F.when(F.col("_s") != F.lag("_s").over(order), 1).otherwise(0)
    grouped = big.withColumn("_new", new).withColumn("area", F.sum("_new").over(order)).groupBy(*keys, "area").agg(F.sum("energy").alias("energy"))
    return grouped.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("area"))))


def surface_up(areas: DataFrame, keys: list[str]) -> DataFrame:
    """Per column with areas: n_all and the three energies nearest the surface, e0 to e2."""
    e = [F.max(F.when(F.col("rank") == i + 1, F.col("energy"))).alias(f"e{i}") for i in range(3)]
    return areas.groupBy(*keys).agg(F.count("*").alias("n_all"), *e)


def kept_areas(n_all, surface_tw):
    """Areas that the decision looks at: two above a cold surface, else three."""
    return F.least(F.coalesce(n_all, F.lit(0)), F.when(surface_tw < 0, 2).otherwise(3)).cast("int")
