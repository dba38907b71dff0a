"""Command line of a run; the exit code is the monitoring's recommendation.

Option names and defaults are fixed values: they are the interface that run scripts use.
"""

from __future__ import annotations

import argparse
import json

from .functions import constants as C
from .plans.config import RunConfig, parse_members


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="rimecast", description="Precipitation type of every member, step and column of a run.")
    p.add_argument("--model", choices=sorted(C.MODELS), required=True)
    p.add_argument("--store", required=True, help="root of the field store")
    p.add_argument("--store-form", choices=("tables", "messages"), default="tables", help="how the store keeps fields")
    p.add_argument("--output-root", required=True)
    p.add_argument("--messages", action="store_true", help="also write a message per member and step (from a store of messages)")
    p.add_argument("--members", default="all", help="all, or members like 000,001")
    p.add_argument("--date", help="YYYYMMDD; without it the newest complete run is taken")
    p.add_argument("--time", help="HHMM")
    p.add_argument("--max-step", type=int)
    p.add_argument("--lookback-days", type=int, default=2)
    p.add_argument("--chunk-size", type=int, default=2)
    p.add_argument("--workers", type=int, default=4)
    p.add_argument("--document-root", help="folder for summary.json and monitoring.json in place of _documents in the output root")
    p.add_argument("--summary-json")
    p.add_argument("--monitoring-json")
    p.add_argument("--max-wall-s", type=float)
    p.add_argument("--no-output-file-check", action="store_true")
    p.add_argument("--no-prefetch", action="store_true")
    p.add_argument("--skip-input-checks", action="store_true")
    p.add_argument("--precip-mask-threshold-mm", type=float, default=0.0)
    p.add_argument("--vertical-cutoff-m", type=float, default=C.VERTICAL_CUTOFF)
    return p


def main(argv: list[str] | None = None) -> int:
    p = parser()
    a = p.parse_args(argv)
    if (a.date is None) != (a.time is None):
        p.error("give both --date and --time, or neither")
    if a.max_wall_s is not None and a.max_wall_s <= 0:
        p.error("--max-wall-s must be positive")
    if a.messages and a.store_form != "messages":
        p.error("--messages needs --store-form messages")
    try:
        config = RunConfig(a.model, parse_members(a.members, a.model), a.max_step, a.precip_mask_threshold_mm, a.vertical_cutoff_m, a.chunk_size, a.workers, not a.no_prefetch)
    except ValueError as x:
        p.error(str(x))
    from pyspark.sql import SparkSession

    from .plans.run import run

    spark = SparkSession.builder.appName("rimecast").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    summary = run(
        spark, a.store, a.output_root, config, run_date=a.date, run_time=a.time, lookback_days=a.lookback_days, check_inputs=not a.skip_input_checks, max_wall_s=a.max_wall_s,
        check_outputs=not a.no_output_file_check, summary_json=a.summary_json, monitoring_json=a.monitoring_json, document_root=a.document_root, store_form=a.store_form, messages=a.messages,
    )
    print(json.dumps(summary, indent=2, sort_keys=True))
    return summary["monitoring"]["recommended_exit_code"]


if __name__ == "__main__":
    raise SystemExit(main())
