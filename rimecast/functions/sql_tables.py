"""Table functions for SQL: ``SELECT * FROM diagnose(TABLE(levels) PARTITION BY cell_id ORDER BY lev)``.

Spark deals the levels out by the partition's keys and sorts them; the function gathers one column of air at a time and gives its
code. All columns of the table that aren't inputs are keys and come back with the code, of the first level where they differ. An
undefined input is NULL or NaN; a second argument is the precipitation from which on a column is active.

A row may also hold one level of many columns side by side, as arrays of equal lengths (a quantity that all share can stay a number): the
code is then an array as well. That is the form for large grids: rows come to the function one by one, and one call of the kernel does a whole
block. What doesn't change down the column (precipitation, ground temperature, keys that are arrays) is needed in the first row only.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.functions import AnalyzeArgument, AnalyzeResult

from ..operators import kernel
from ..shipping import ship

#: What a row of levels holds beside its keys.
PROFILE = ("temperature_k", "specific_humidity", "pressure_pa", "height_m")
SURFACE = ("total_precip_mm", "ground_temperature_c")
INPUTS = ("lev", *PROFILE, *SURFACE)


class Diagnose:
    """Levels of one partition, top first, to its code."""

    @staticmethod
    def analyze(levels: AnalyzeArgument, threshold: AnalyzeArgument | None = None) -> AnalyzeResult:
        if not levels.isTable:
            raise ValueError("diagnose takes TABLE(...) PARTITION BY the keys of a column ORDER BY lev")
        fields = {f.name: f for f in levels.dataType.fields}
        if lost := [c for c in INPUTS if c not in fields]:
            raise ValueError(f"the table lacks {', '.join(lost)}")
        if "ptype" in fields:
            raise ValueError("a key is called like the result, ptype")
        side_by_side = isinstance(fields["total_precip_mm"].dataType, T.ArrayType)
        code = T.ArrayType(T.IntegerType()) if side_by_side else T.IntegerType()
        return AnalyzeResult(T.StructType([f for c, f in fields.items() if c not in INPUTS] + [T.StructField("ptype", code)]))

    def __init__(self):
        self.rows, self.keys, self.threshold, self.surface = [], None, 0.0, None

    def eval(self, levels: T.Row, threshold: float = 0.0):
        if self.keys is None:
            self.keys, self.threshold = tuple(levels[c] for c in levels.__fields__ if c not in INPUTS), float(threshold)
            self.surface = [levels[c] for c in SURFACE]
        self.rows.append([np.array(levels[c], np.float64) for c in PROFILE])

    def terminate(self):
        if self.keys is None:
            return
        rain, ground = (np.atleast_1d(np.array(x, np.float64)) for x in self.surface)
        n = len(rain)
        codes = np.zeros(n, np.int32)
        active = np.flatnonzero(np.isfinite(rain) & (rain > self.threshold))
        if len(active):
            matrices = (np.stack([np.broadcast_to(row[k], n)[active] for row in self.rows]) for k in range(len(PROFILE)))
            codes[active] = kernel.ptype(*matrices, np.broadcast_to(ground, n)[active])
        yield (*self.keys, codes.tolist() if isinstance(self.surface[0], list) else int(codes[0]))


def register_tables(spark: SparkSession) -> None:
    """Make the functions known to the session's SQL."""
    from pyspark.sql.functions import udtf

    ship(spark)
    spark.udtf.register("diagnose", udtf(Diagnose))
