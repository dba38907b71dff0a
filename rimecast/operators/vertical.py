"""Cutting a grid's upper levels off, by the lowest height that each level has anywhere."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as C


def level_selection(full: DataFrame, cutoff: float | None = C.VERTICAL_CUTOFF) -> DataFrame:
    """One row: first_lev (index of the first kept level), n_levels, kept_levels.

    Kept are all levels from the first whose smallest height is at or below the cutoff; if there is
    none, or no cutoff, all are. ``full``: rows with lev (0 at the top) and height_m.
    """
    if cutoff is not None and not math.isfinite(cutoff):
        raise ValueError(f"the vertical cutoff must be finite, got {cutoff!r}")
    low = full.groupBy("lev").agg(F.min(F.nanvl("height_m", F.lit(None).cast("double"))).alias("low"))
    first = F.min(F.when(F.col("low") <= (math.inf if cutoff is None else cutoff), F.col("lev")))
    top, n = F.min("lev"), F.count("*")
    if cutoff is None:
        first = top
    return low.agg(F.coalesce(first, top).alias("first_lev"), n.alias("n_levels")).select("first_lev", "n_levels", (F.col("n_levels") - F.col("first_lev")).alias("kept_levels"))


def prune_levels(levels: DataFrame, full: DataFrame, cutoff: float | None = C.VERTICAL_CUTOFF) -> DataFrame:
    """Levels from the first kept one on; the start is read first and pushed into the scan as a literal."""
    start = level_selection(full, cutoff).first()["first_lev"]
    return levels.where(F.col("lev") >= F.lit(start))
