"""Thermodynamics of a level: temperature, dew point, humidity over ice, wet bulb."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import constants as C
from .guards import defined, ratio


def celsius(kelvin: Column) -> Column:
    return kelvin - C.KELVIN


def dew_point_k(humidity: Column, pressure: Column) -> Column:
    vapour = humidity * pressure
    # no vapour: the logarithm is infinite and the dew point absolute zero
    return F.when(vapour > 0, ratio(F.lit(C.DEW_TEMPERATURE), F.ln(F.lit(C.DEW_PRESSURE * C.VAPOUR_RATIO) / vapour))).when(vapour == 0, 0.0)


def ice_vapour_pressure(kelvin: Column) -> Column:
    return C.ICE_VAPOUR_PA * F.exp(ratio(C.ICE_VAPOUR_RATE * (kelvin - C.TRIPLE_POINT), kelvin - C.ICE_VAPOUR_OFFSET))


def wet_bulb_c(temperature_c: Column, dew_k: Column, pressure: Column) -> Column:
    dew = (dew_k - C.KELVIN) * 10.0
    spread = temperature_c * 10.0 - dew
    z = dew + C.WB_HALF_STEP * spread * (C.WB_DEW_WEIGHT - dew / C.WB_DEW_SCALE)
    growth = F.exp(ratio(C.WB_GROWTH_RATE * z, C.WB_GROWTH_OFFSET + z))
    return C.WB_TENTHS * (dew + ratio(spread, 1.0 + ratio(10.0 * C.WB_PRESSURE_GROWTH * growth, pressure)))


def with_thermodynamics(levels: DataFrame) -> DataFrame:
    """Adds temperature_c, dew_point_k, rh_ice_pct, wet_bulb_c; all row by row, within code generation."""
    t = defined(F.col("temperature_k"))
    out = levels.withColumns({"temperature_c": celsius(t), "dew_point_k": dew_point_k(defined(F.col("specific_humidity")), defined(F.col("pressure_pa")))})
    out = out.withColumn("rh_ice_pct", ratio(ice_vapour_pressure(F.col("dew_point_k")), ice_vapour_pressure(t)) * 100.0)
    return out.withColumn("wet_bulb_c", wet_bulb_c(F.col("temperature_c"), F.col("dew_point_k"), F.col("pressure_pa")))


def full_level_heights(half: DataFrame, keys: list[str]) -> DataFrame:
    """Full levels between half levels (keys, lev, hhl_m): height_m by the mean, and by the offset form."""
    below = F.lead("hhl_m").over(Window.partitionBy(*keys).orderBy("lev"))
    out = half.withColumn("_below", below).where("_below is not null")
    return out.select(*keys, "lev", (0.5 * (F.col("hhl_m") + F.col("_below"))).alias("height_m"), (F.col("_below") + (F.col("hhl_m") - F.col("_below")) / 2.0).alias("height_offset_m"))
