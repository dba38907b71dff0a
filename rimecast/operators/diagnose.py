"""The column diagnostic over long tables: one row per level in, one row per column out.

All windows and aggregates share the hash partitioning of the column keys, so the levels are
exchanged once; dry columns never reach the thermodynamics.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as C
from ..functions.classify import categorical_code, total, with_type_probabilities
from ..functions.guards import is_finite
from ..functions.thermo import with_thermodynamics
from . import energy, layers


def is_active(threshold: float = 0.0):
    p = F.col("total_precip_mm")
    return is_finite(p) & (p > threshold)


def column_state(levels: DataFrame, keys: list[str]) -> DataFrame:
    """Per column of levels with thermodynamics: ice probabilities, area energies, surface values.

    Two branches over the same partitioning, layers (which carry the surface values along) and areas.
    """
    same = ("ground_temperature_c", "total_precip_mm")
    rows = layers.layers(layers.mark_layers(levels, keys), keys, F.max_by("wet_bulb_c", "lev").alias("lowest_tw"), *[F.first(c).alias(c) for c in same])
    ice = layers.ice_probabilities(rows, keys, surface_tw=F.max_by("lowest_tw", "first_lev"), **{c: F.first(c) for c in same})
    marked = energy.mark_segments(energy.fill_signs(levels, keys), keys)
    areas = energy.surface_up(energy.merged_areas(energy.segments(marked, keys), keys), keys)
    return ice.join(areas, keys, "left").withColumn("n_areas", energy.kept_areas(F.col("n_all"), F.col("surface_tw"))).drop("n_all")


def _named(prefix: str) -> dict[str, Column]:
    return {k: F.col(f"{prefix}{k}") for k in C.TYPES}


def with_probabilities(state: DataFrame) -> DataFrame:
    """Adds p_ (strict rule) and r_ (relaxed rule) columns for each type."""
    return with_type_probabilities(with_type_probabilities(state, "ice", "generated", "p_"), "relaxed_ice", "relaxed_generated", "r_")


def _settled(df: DataFrame, keys: list[str]) -> DataFrame:
    """The same rows (one per key), as an aggregate on the partitioning they have: no exchange, and
    a filter on a result isn't rewritten into the whole chain of formulas by the optimiser."""
    return df.groupBy(*keys).agg(*[F.first(c).alias(c) for c in df.columns if c not in keys])


def diagnose_levels(levels: DataFrame, keys: list[str], *, threshold: float = 0.0) -> DataFrame:
    """All columns, ungated: pure and microphysics-consistent probabilities and the code.

    An undefined total keeps the pure result; the relaxed rule is only for a total of zero.
    """
    state = with_probabilities(column_state(with_thermodynamics(levels), keys))
    pure, relaxed, dry = _named("p_"), _named("r_"), F.col("total_precip_mm") <= threshold
    state = state.withColumn("fall", ~dry & F.coalesce(total(pure) == 0, F.lit(False)))
    mixed = {k: F.when(dry, 0.0).when(F.col("fall"), relaxed[k]).otherwise(pure[k]) for k in pure}
    out = state.select(*keys, F.col("ice").alias("pure_ice"), F.when(F.col("fall"), F.col("relaxed_ice")).otherwise(F.col("ice")).alias("ice"), *[v.alias(f"pure_{k}") for k, v in pure.items()], *[v.alias(k) for k, v in mixed.items()])
    return _settled(out.withColumn("ptype", categorical_code(_named(""))), keys)


def categorical(levels: DataFrame, keys: list[str], *, threshold: float = 0.0) -> DataFrame:
    """The code of every column (keys, ptype): dry columns are 0; the relaxed rule is used where the pure code is 0."""
    wet = with_probabilities(column_state(with_thermodynamics(levels.where(is_active(threshold))), keys))
    wet = wet.withColumns({"pure": categorical_code(_named("p_")), "relaxed": categorical_code(_named("r_"))})
    dry = levels.where(~is_active(threshold)).select(*keys).distinct().withColumn("ptype", F.lit(0))
    code = F.when(F.col("pure") != 0, F.col("pure")).otherwise(F.col("relaxed"))
    return _settled(wet.select(*keys, code.alias("ptype")), keys).unionByName(dry)
