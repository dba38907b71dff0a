"""Throughput of the column diagnostic on the synthetic grid: ``python -m rimecast.throughput``.

Option names, defaults and the lines' keys are fixed values: they are what scripts call and read. ``--chunk-size`` is the number of columns of
air that a Python worker gets at once.
"""

from __future__ import annotations

import argparse
import time
from dataclasses import dataclass

from .functions.rates import columns_per_second


@dataclass(frozen=True)
class Throughput:
    """Seconds of the best repeat, and what was diagnosed in them."""

    diagnose_s: float
    active_columns: int
    total_columns: int
    retained_full_levels: int
    case: str = "synthetic_active_columns"
    backend: str = "spark"

    def lines(self) -> list[str]:
        rate = columns_per_second(self.active_columns, self.diagnose_s)
        return [
            f"case={self.case}", f"backend={self.backend}", f"diagnose_s={self.diagnose_s:.3f}", f"active_columns={self.active_columns}",
            f"total_columns={self.total_columns}", f"retained_full_levels={self.retained_full_levels}", f"columns_per_second={rate:.1f}",
        ]


def measure(spark, *, n_columns: int, n_levels: int, repeat: int, chunk_size: int) -> Throughput:
    """Best of ``repeat`` passes over the grid, held in memory, after one that isn't counted."""
    from .operators.kernel import categorical_arrays
    from .sources.synthetic import synthetic_arrays

    if min(n_columns, n_levels, repeat, chunk_size) < 1:
        raise ValueError("columns, levels, repeats and chunk size must be at least 1")
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    grid = synthetic_arrays(spark, n_columns, n_levels).persist()
    try:
        spark.conf.set(key, chunk_size)
        active, best = grid.where("total_precip_mm > 0").count(), float("inf")
        for k in range(repeat + 1):
            begun = time.perf_counter()
            categorical_arrays(grid, ["cell_id"]).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - begun) if k else best
    finally:
        spark.conf.set(key, before)
        grid.unpersist()
    return Throughput(best, active, n_columns, n_levels)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="rimecast.throughput", description="Active columns per second on the synthetic grid.")
    p.add_argument("--chunk-size", type=int, default=4096)
    p.add_argument("--repeat", type=int, default=3)
    p.add_argument("--n-levels", type=int, default=80)
    p.add_argument("--n-columns", type=int, default=20000)
    a = p.parse_args(argv)
    if min(a.chunk_size, a.repeat, a.n_levels, a.n_columns) < 1:
        p.error("all sizes must be at least 1")
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.appName("rimecast throughput").getOrCreate()
    for line in measure(spark, n_columns=a.n_columns, n_levels=a.n_levels, repeat=a.repeat, chunk_size=a.chunk_size).lines():
        print(line)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
