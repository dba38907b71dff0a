"""A whole run: fields of every member in, categorical fields, summary and monitoring out.

A member is one plan over all its steps: its fields are counted by their keys, cut into blocks, exchanged once and
diagnosed in one pass, whose results (codes and quality counters) are written beside the outputs. The counters gate the
member; only then its codes take the place of what it had before. Members run at the same time, each into a folder of its own, and
one that fails leaves its outputs as they were and doesn't stop the others.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as C
from ..operators import align, blocks, vertical
from ..operators.quality import DataQualityError
from ..sources.field_source import MessageStore
from ..sources.field_store import PARTITIONS, FieldStore
from ..sources.sinks import commit_codes, staging, write_categorical, write_json
from . import catalog, monitoring
from .config import RunConfig
from .provenance import snapshot

LOG = logging.getLogger(__name__)
TIMINGS = ("discovery_s", "request_s", "diagnose_s", "quality_s", "write_s")
_PREVIEW = 5


def run_record(config: RunConfig, member: str, run_date: str, run_time: str) -> dict:
    """What identifies a member's run: the control member has no number."""
    control = int(member) == 0
    return {"date": run_date, "time": run_time, "model": config.model, "member": member, "type": "cf" if control else "pf", "number": None if control else int(member), "max_step": config.max_step}


def _wanted(request: Callable[..., DataFrame], config: RunConfig, member: str, run_date: str, run_time: str, first: int) -> DataFrame:
    """What a member needs from its first level kept on."""
    ask = {"model": config.model, "run_date": run_date, "run_time": run_time, "member": member}
    steps, last = (0, config.max_step), config.full_levels
    heights = request(**ask, params=["HHL"], steps=(0, 0), levels=(first, last + 1))
    levels = request(**ask, params=list(blocks.LEVEL_PARAMS), steps=steps, levels=(first, last))
    flat = request(**ask, params=["TOT_PREC"], steps=steps, timespan="fs").unionByName(request(**ask, params=["T_G"], steps=steps))
    return heights.unionByName(levels).unionByName(flat)


def member_fields(store: FieldStore, config: RunConfig, member: str, run_date: str, run_time: str) -> tuple[DataFrame, int]:
    """All fields that a member needs, in the parts and form that the store has, and its first level kept (numbered from 1)."""
    heights = store.stored(model=config.model, run_date=run_date, run_time=run_time, member=member, params=["HHL"], steps=(0, 0))
    first = vertical.level_selection(blocks.lowest_heights(heights), config.cutoff_m).first()["first_lev"]
    first = 1 if first is None else first + 1
    return _wanted(store.stored, config, member, run_date, run_time, first), first


def member_keys(store: FieldStore, config: RunConfig, member: str, run_date: str, run_time: str, first: int) -> DataFrame:
    """The same without values: a row for each field."""
    return _wanted(store.keys, config, member, run_date, run_time, first)


def expected_fields(spark: SparkSession, config: RunConfig, first: int) -> DataFrame:
    """(param_id, step, lev): what has to be there once."""
    rows = [("HHL", 0, first, config.full_levels + 1)] + [(p, config.max_step, first, config.full_levels) for p in blocks.LEVEL_PARAMS] + [(p, config.max_step, 0, 0) for p in ("TOT_PREC", "T_G")]
    t = spark.createDataFrame([(C.PARAMS[p], s, a, z) for p, s, a, z in rows], "param_id int, last int, low int, high int")
    t = t.select("param_id", F.explode(F.sequence(F.lit(0), "last")).alias("step"), "low", "high")
    return t.select("param_id", "step", F.explode(F.sequence("low", "high")).alias("lev"))


def check_fields(fields: DataFrame, keys: DataFrame, config: RunConfig, first: int) -> DataFrame:
    """The fields, each exactly once by their ``keys``: of repeated single-level fields the last written counts, what else is missing or repeated is an error."""
    names = {i: n for n, i in C.PARAMS.items()}
    flat = {C.PARAMS[p] for p in ("TOT_PREC", "T_G")}
    allowed = F.col("param_id").isin(*flat) & (F.col("n") > 0)
    # errors come first, so that allowed repeats can't hide them
    odd = blocks.field_counts(keys, expected_fields(fields.sparkSession, config, first)).orderBy(allowed, "param_id", "step", "lev").limit(_PREVIEW + 1).collect()
    wrong = [r for r in odd if r["n"] == 0 or r["param_id"] not in flat]
    if wrong:
        said = [f"{names[r['param_id']]} step {r['step']} level {r['lev']}: expected 1 field, got {r['n']}" for r in wrong[:_PREVIEW]]
        raise RuntimeError("; ".join(said) + ("; ..." if len(wrong) > _PREVIEW else ""))
    if not odd:
        return fields
    single = F.col("param_id").isin(*flat)
    return fields.where(~single).unionByName(align.last_of_each(fields.where(single), [*PARTITIONS, "step", "lev", "at"], "written"))


def gate(results: DataFrame, config: RunConfig) -> dict[str, int]:
    """Quality counters of all steps; RuntimeError for broken fields, DataQualityError in the order precipitation, ground, profile."""
    problems = [f"step {r['step']}: {r['problem']}" for r in results.where("problem is not null").select("step", "problem").distinct().orderBy("step", "problem").limit(_PREVIEW).collect()]
    if problems:
        raise RuntimeError("; ".join(problems))
    *counts, n, n_blocks = results.agg(*[F.sum(c) for c in C.QUALITY_COUNTERS], F.count("*"), F.countDistinct("block")).first()
    if n != n_blocks * (config.max_step + 1):
        raise RuntimeError(f"{n} results of {n_blocks} block(s), expected {n_blocks * (config.max_step + 1)}")
    found = dict(zip(C.QUALITY_COUNTERS, (int(x or 0) for x in counts), strict=True))
    if found["invalid_total_precip_columns"]:
        raise DataQualityError(f"precipitation is not finite in {found['invalid_total_precip_columns']} column(s)")
    for counter, column, what in (("invalid_active_ground_temperature_columns", "bad_ground", "ground temperature"), ("invalid_active_profile_columns", "bad_profile", "temperature, pressure, humidity or height")):
        if found[counter]:
            few = results.select("step", F.explode(column).alias("cell")).orderBy("step", "cell").limit(_PREVIEW + 1).collect()
            where = ",".join(f"{r['step']}/{r['cell']}" for r in few[:_PREVIEW]) + (",..." if len(few) > _PREVIEW else "")
            raise DataQualityError(f"{what} is not finite in active column(s): {where}")
    return found


def run_member(store: FieldStore, config: RunConfig, member: str, run_date: str, run_time: str, output: str, *, check_inputs: bool = True, discovery_s: float = 0.0, messages: bool = False) -> dict:
    """Counts, quality counters and timings of one member."""
    times, start = {"discovery_s": discovery_s}, time.perf_counter()
    begun = start

    def lap(name: str) -> None:
        nonlocal begun
        now = time.perf_counter()
        times[name], begun = times.get(name, 0.0) + now - begun, now

    LOG.info("member %s of %s %s %s begins: steps 0 to %s", member, config.model, run_date, run_time, config.max_step)
    spark = store.spark
    if check_inputs:
        catalog.check_complete(store.catalogue(), model=config.model, run_date=run_date, run_time=run_time, member=member, max_step=config.max_step, full=config.full_levels, half=config.full_levels + 1)
        lap("discovery_s")
    fields, first = member_fields(store, config, member, run_date, run_time)
    fields = check_fields(fields, member_keys(store, config, member, run_date, run_time, first), config, first)
    lap("request_s")
    with staging(spark, output) as path:
        found = blocks.diagnose_groups(blocks.field_groups(fields), first_level=first, last_level=config.full_levels, threshold=config.threshold_mm)
        found.write.parquet(path)
        results = spark.read.schema(found.schema).parquet(path)
        lap("diagnose_s")
        counted = gate(results, config)
        lap("quality_s")
        named = {"model": config.model, "run_date": run_date, "run_time": run_time, "member": member}
        keys = {k: F.lit(v) for k, v in named.items()}
        codes = blocks.block_codes(results).withColumns(keys)
        written = write_categorical(codes, output, expected=counted["total_columns"])
        if messages:
            # each step's message is its own field of precipitation, with codes in place of values
            own = store.heads(**named, params=["TOT_PREC"], steps=(0, config.max_step), timespan="fs")
            commit_codes(codes, message_root(output), align.last_of_each(own, ["member", "step"], "written"))
        lap("write_s")
    LOG.info("member %s ends: %s step(s) written, %s of %s columns active", member, written.get(member, 0), counted["active_columns"], counted["total_columns"])
    return {
        "run": run_record(config, member, run_date, run_time), "chunk_size": config.chunk_size, "prefetch": config.prefetch, "steps": config.max_step + 1, "written": written.get(member, 0),
        "retained_full_levels": config.full_levels - first + 1, "active_columns": counted["active_columns"], "total_columns": counted["total_columns"], "data_quality": counted,
        "timings_s": {k: round(times.get(k, 0.0), 3) for k in TIMINGS}, "wall_s": round(time.perf_counter() - start, 3),
    }


def merge_counts(results: dict[str, dict], key: str, names) -> dict:
    """Sums over members; a missing entry counts as 0."""
    return {n: round(sum(r[key].get(n, 0) for r in results.values()), 3) for n in names}


def message_root(output_root: str) -> str:
    """Where a run's messages go: a folder that readers of the tables skip."""
    return f"{output_root.rstrip('/')}/_messages"


def open_store(spark: SparkSession, root: str, form: str = "tables") -> FieldStore:
    """The fields under ``root``, kept as tables or as messages."""
    if form not in ("tables", "messages"):
        raise ValueError(f"a store holds tables or messages, not {form!r}")
    return FieldStore(spark, root) if form == "tables" else MessageStore(spark, root)


def document_folder(output_root: str, model: str, run_date: str, run_time: str) -> str:
    """Where summary.json and monitoring.json of a run go by default: a folder that readers of the outputs skip."""
    return f"{output_root.rstrip('/')}/_documents/{model}/{run_date}/{run_time}"


def run(
    spark: SparkSession, store_root: str, output_root: str, config: RunConfig, *, run_date: str | None = None, run_time: str | None = None, lookback_days: int = 2,
    check_inputs: bool = True, max_wall_s: float | None = None, check_outputs: bool = False, summary_json: str | Path | None = None, monitoring_json: str | Path | None = None, document_root: str | Path | None = None, store_form: str = "tables", messages: bool = False,
) -> dict:
    """Run all members; returns the summary with its monitoring status.

    ``store_form`` says how fields are kept; with ``messages`` a store of messages also gives one message file per member and step.
    Both are also written as JSON: to ``document_folder``, or under ``document_root`` if it is given, and to the files asked for.
    """
    if (run_date is None) != (run_time is None):
        raise ValueError("give both the date and the time of a run, or neither")
    if max_wall_s is not None and max_wall_s <= 0:
        raise ValueError(f"max_wall_s must be positive, got {max_wall_s}")
    if messages and store_form != "messages":
        raise ValueError("messages are made from the messages of a store that has them")
    LOG.info("run of %s begins: member(s) %s", config.model, ", ".join(config.members))
    store, begun, discovery = open_store(spark, store_root, store_form), time.perf_counter(), 0.0
    if run_date is None:
        probe = "000" if "000" in config.members else config.members[0]
        run_date, run_time = catalog.discover(store.catalogue(), model=config.model, member=probe, max_step=config.max_step, lookback_days=lookback_days, full=config.full_levels, half=config.full_levels + 1)
        discovery = time.perf_counter() - begun
        LOG.info("newest complete run of %s: %s %s", config.model, run_date, run_time)
    begun = time.perf_counter()
    done: dict[str, dict] = {}
    failed: dict[str, str] = {}

    def one(member: str) -> None:
        try:
            done[member] = run_member(store, config, member, run_date, run_time, output_root, check_inputs=check_inputs, discovery_s=discovery, messages=messages)
        except Exception as x:  # a member's failure is a result
            failed[member] = f"{type(x).__name__}: {x}"
            LOG.exception("member %s failed", member)

    workers = min(config.workers, len(config.members))
    with ThreadPoolExecutor(workers) as pool:
        list(pool.map(one, config.members))
    ordered = {m: done[m] for m in config.members if m in done}
    summary = {
        "model": config.model, "date": run_date, "time": run_time, "members": list(config.members), "processed_members": list(ordered), "failed": failed, "max_step": config.max_step,
        "chunk_size": config.chunk_size, "prefetch": config.prefetch, "workers": workers, "output_root": str(output_root), "discovery_s": round(discovery, 3),
        "timings_s": merge_counts(ordered, "timings_s", TIMINGS), "data_quality": merge_counts(ordered, "data_quality", C.QUALITY_COUNTERS),
        "provenance": snapshot(spark), "wall_s": round(time.perf_counter() - begun, 3), "per_member": ordered,
    }
    lost = monitoring.missing_paths(spark, summary) if check_outputs else None
    summary["monitoring"] = monitoring.status(summary, max_wall_s=max_wall_s, missing_outputs=lost)
    folder = document_folder(output_root, config.model, run_date, run_time) if document_root is None else f"{str(document_root).rstrip('/')}/{config.model}/{run_date}/{run_time}"
    for payload, name, other in ((summary, "summary.json", summary_json), (summary["monitoring"], "monitoring.json", monitoring_json)):
        for place in (f"{folder}/{name}", other):
            if place is not None:
                write_json(payload, place, spark)
    LOG.info("run of %s ends: %s processed, %s failed, status %s, %.3f s", config.model, len(ordered), len(failed), summary["monitoring"]["status"], summary["wall_s"])
    return summary
