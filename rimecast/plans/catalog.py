"""Which runs are complete, from the store's catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as C

RUN = ["model", "run_date", "run_time", "member"]


def expectations(spark: SparkSession, max_step: int, full: int = C.FULL_LEVELS, half: int = C.HALF_LEVELS) -> DataFrame:
    """What each required parameter must have: param_id, levtype, timespan, steps, levels (NULL: any)."""
    every, levels = list(range(max_step + 1)), lambda n: list(range(1, n + 1))
    rows = [("HHL", "ml", "none", [0], levels(half))] + [(p, "ml", "none", every, levels(full)) for p in ("T", "P", "QV")]
    rows += [("TOT_PREC", "sfc", "fs", every, None), ("T_G", "sfc", "none", every, None)]
    return spark.createDataFrame([(C.PARAMS[p], p, a, b, s, n) for p, a, b, s, n in rows], "param_id int, param string, levtype string, timespan string, steps array<int>, levels array<int>")


def completeness(catalogue: DataFrame, expected: DataFrame, keys: list[str] = RUN) -> DataFrame:
    """Per run and expected parameter: complete, and how many steps and levels are missing.

    Steps and levels are tested as two sets, not as pairs, and the time span only has to occur.
    """
    have = catalogue.groupBy(*keys, "param_id", "levtype").agg(F.collect_set("timespan").alias("spans"), F.collect_set("step").alias("have_steps"), F.collect_set("lev").alias("have_levels"))
    runs = catalogue.select(*keys).distinct()
    asked = runs.join(F.broadcast(expected))  # six rows
    t = asked.join(have, [*keys, "param_id", "levtype"], "left")
    empty = F.array().cast("array<int>")
    short = F.size(F.array_except("steps", F.coalesce("have_steps", empty)))
    low = F.when(F.col("levels").isNull(), 0).otherwise(F.size(F.array_except("levels", F.coalesce("have_levels", empty))))
    span = F.coalesce(F.array_contains("spans", F.col("timespan")), F.lit(False))
    return t.select(*keys, "param", "param_id", span.alias("has_span"), short.alias("missing_steps"), low.alias("missing_levels"), (span & (short == 0) & (low == 0)).alias("complete"))


def complete_runs(checked: DataFrame, keys: list[str] = RUN) -> DataFrame:
    """Runs in which every parameter is complete."""
    return checked.groupBy(*keys).agg(F.bool_and("complete").alias("complete"), F.sort_array(F.collect_set(F.when(~F.col("complete"), F.col("param")))).alias("missing"))


def newest(runs: DataFrame, keys: list[str]) -> DataFrame:
    """Per keys the latest (run_date, run_time) of complete runs, compared as text."""
    return runs.where("complete").groupBy(*keys).agg(F.max(F.struct("run_date", "run_time")).alias("r")).select(*keys, "r.run_date", "r.run_time")


def lookback_dates(days: int) -> Column:
    """Today (UTC) and the ``days`` days before as yyyyMMdd, newest first."""
    return F.transform(F.sequence(F.lit(0), F.lit(days)), lambda k: F.date_format(F.date_sub(F.current_date(), k), "yyyyMMdd"))


def discover(catalogue: DataFrame, *, model: str, member: str, max_step: int, lookback_days: int, full: int = C.FULL_LEVELS, half: int = C.HALF_LEVELS) -> tuple[str, str]:
    """Newest complete run of one member in the last days; RuntimeError if there is none."""
    recent = catalogue.where((F.col("model") == model) & (F.col("member") == member) & F.array_contains(lookback_dates(lookback_days), F.col("run_date")))
    checked = completeness(recent, expectations(catalogue.sparkSession, max_step, full, half))
    found = newest(complete_runs(checked), ["model", "member"]).first()
    if found is None:
        raise RuntimeError(f"no complete run of {model} member {member} with steps 0..{max_step} in the last {lookback_days} day(s)")
    return found["run_date"], found["run_time"]


def check_complete(catalogue: DataFrame, *, model: str, run_date: str, run_time: str, member: str, max_step: int, full: int = C.FULL_LEVELS, half: int = C.HALF_LEVELS) -> None:
    """RuntimeError naming the parameters that a run lacks."""
    one = catalogue.where((F.col("model") == model) & (F.col("run_date") == run_date) & (F.col("run_time") == run_time) & (F.col("member") == member))
    found = complete_runs(completeness(one, expectations(catalogue.sparkSession, max_step, full, half))).first()
    missing = list(C.REQUIRED_PARAMS) if found is None else found["missing"]
    if missing:
        raise RuntimeError(f"incomplete run {model} {run_date} {run_time} member {member}: {', '.join(missing)}")
