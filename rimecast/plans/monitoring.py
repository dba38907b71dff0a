"""Alerts from a run's summary: as a plain document, and as tables for many runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as C

PREVIEW = 10
MESSAGES = {
    "failed_members": "Members failed.",
    "missing_member_results": "Requested members have neither a result nor a failure.",
    "incomplete_member_outputs": "Processed members lack steps or outputs.",
    "fatal_data_quality": "Counters of fatal data quality are not zero.",
    "wall_clock_exceeded": "The run took longer than allowed.",
    "missing_output_files": "Expected outputs are missing.",
}


def _as_dict(value) -> dict:
    return value if isinstance(value, dict) else {}


def status(summary: dict, *, max_wall_s: float | None = None, missing_outputs: list[str] | None = None) -> dict:
    """Alerts and counts. ``missing_outputs``: paths found missing, or None if outputs weren't checked."""
    expected = int(summary.get("max_step", -1)) + 1
    asked, done = ([str(m) for m in summary.get(k, [])] for k in ("members", "processed_members"))
    failed = sorted(map(str, _as_dict(summary.get("failed", {}))))
    found: dict[str, dict] = {}
    if failed:
        found["failed_members"] = {"members": failed}
    if lost := [m for m in asked if m not in {*done, *failed}]:
        found["missing_member_results"] = {"members": lost}
    results = summary.get("per_member", {})
    if isinstance(results, dict):
        counts = {m: {k: int(_as_dict(results.get(m)).get(k, -1)) for k in ("steps", "written")} for m in done}
        if short := {m: c | {"expected": expected} for m, c in counts.items() if set(c.values()) != {expected}}:
            found["incomplete_member_outputs"] = {"members": short}
    quality = _as_dict(summary.get("data_quality", {}))
    if fatal := {k: n for k in C.FATAL_COUNTERS if (n := int(quality.get(k, 0)))}:
        found["fatal_data_quality"] = fatal
    wall = float(summary.get("wall_s", 0.0))
    if max_wall_s is not None and wall > max_wall_s:
        found["wall_clock_exceeded"] = {"wall_s": round(wall, 3), "max_wall_s": round(float(max_wall_s), 3)}
    lost_files = list(missing_outputs or ()) if done else []
    if lost_files:
        found["missing_output_files"] = {"count": len(lost_files), "preview": lost_files[:PREVIEW]} | ({"truncated": True} if len(lost_files) > PREVIEW else {})
    return {
        "status": "critical" if found else "ok",
        "ok": not found,
        "recommended_exit_code": int(bool(found)),
        "alerts": [{"code": code, "severity": "critical", "message": MESSAGES[code], "details": details} for code, details in found.items()],
        "expected": {"members": len(asked), "steps_per_member": expected, "output_files": len(done) * expected},
        "observed": {"processed_members": len(done), "failed_members": len(failed), "wall_s": round(wall, 3), "checked_output_files": missing_outputs is not None, "missing_output_files": len(lost_files)},
    }


def unaccounted(members: DataFrame, processed: DataFrame, failed: DataFrame) -> DataFrame:
    """Requested members that were neither processed nor failed."""
    return members.join(processed.select("member").union(failed.select("member")).distinct(), "member", "left_anti")


def missing_outputs(processed: DataFrame, max_step: int, written: DataFrame) -> DataFrame:
    """(member, step) pairs of processed members without an output."""
    wanted = processed.select("member", F.explode(F.sequence(F.lit(0), F.lit(max_step))).alias("step"))
    return wanted.join(written.select("member", "step").distinct(), ["member", "step"], "left_anti")


def missing_paths(spark, summary: dict) -> list[str]:
    """Folders of steps that processed members should have and that aren't there or hold no file; outputs aren't read."""
    from ..sources.sinks import RUN_KEYS, _Files

    root = str(summary["output_root"]).rstrip("/")
    files, lost = _Files(spark, root), []
    for m in summary["processed_members"]:
        base = "/".join([root, *(f"{k}={v}" for k, v in zip(RUN_KEYS, (summary["model"], summary["date"], summary["time"], m), strict=True))])
        there = {s.getPath().getParent().getName() for s in files.fs.globStatus(files.make(f"{base}/step=*/*.parquet")) or []}
        lost += [f"{base}/step={k}" for k in range(summary["max_step"] + 1) if f"step={k}" not in there]
    return lost


def alert_table(results: DataFrame, expected_steps: int, *, asked: DataFrame | None = None, written: DataFrame | None = None, wall: DataFrame | None = None, max_wall_s: float | None = None) -> DataFrame:
    """Alerts of many members at once: rows (code, n_members, members), members sorted and comma-joined.

    ``results``: member, failed, steps, written and, if known, the fatal quality counters (NULL: 0). With ``asked`` (member) those
    without a result are found, with ``written`` (member, step) the processed ones that lack outputs, and with ``wall`` (wall_s, one
    row a run) and ``max_wall_s`` the runs that took too long (they have no members).
    """
    short = ~F.col("failed") & ((F.coalesce("steps", F.lit(-1)) != expected_steps) | (F.coalesce("written", F.lit(-1)) != expected_steps))
    counters = [c for c in C.FATAL_COUNTERS if c in results.columns]
    fatal = [F.when(~F.col("failed") & (sum((F.coalesce(c, F.lit(0)) for c in counters), F.lit(0)) > 0), "fatal_data_quality")] if counters else []
    kinds = F.array_compact(F.array(F.when(F.col("failed"), "failed_members"), F.when(short, "incomplete_member_outputs"), *fatal))
    rows = results.select("member", F.explode(kinds).alias("code"))
    if asked is not None:
        rows = rows.unionByName(unaccounted(asked, results, results.limit(0)).select("member", F.lit("missing_member_results").alias("code")))
    if written is not None:
        lost = missing_outputs(results.where(~F.col("failed")), expected_steps - 1, written).select("member").distinct()
        rows = rows.unionByName(lost.select("member", F.lit("missing_output_files").alias("code")))
    out = rows.groupBy("code").agg(F.count("*").alias("n_members"), F.concat_ws(",", F.sort_array(F.collect_list("member"))).alias("members"))
    if wall is not None and max_wall_s is not None:
        late = wall.where(F.col("wall_s") > max_wall_s).limit(1).select(F.lit("wall_clock_exceeded").alias("code"), F.lit(0).cast("long").alias("n_members"), F.lit("").alias("members"))
        out = out.unionByName(late)
    return out
