"""A catalogue that grows as fields arrive: which steps and levels each run and parameter has, as bitmaps.

One row holds the keys of a run, a parameter and type of level, and two sets of small numbers as bitmaps. What arrives is
appended as rows of its own; reading merges them by bit-or, so a field that is told twice changes nothing, and an arrival costs what
has arrived, not what is there. A run is complete where the bits it should have are contained in those it has. Discovery reads
this table only, never the store's listing or fields.

Rows lie in generations: ``compact`` writes the merged rows as the next one and then drops those before, so that a
reader finds either. Steps and levels are whole numbers from 0 to 32,767.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.sinks import files_of
from .catalog import RUN

#: Bits of one bitmap: what Spark's functions hold in one.
BITS = 32768
_SETS = ("steps", "levels")


def _bitmap(numbers: list[int]) -> bytearray:
    bits = np.zeros(BITS, np.uint8)
    bits[numbers] = 1
    return bytearray(np.packbits(bits, bitorder="little").tobytes())


def _position(number: Column) -> Column:
    good = number.between(0, BITS - 1)
    return F.when(good, number.cast("long")).otherwise(F.raise_error(F.concat(F.lit("steps and levels are numbers from 0 to 32767, not "), F.coalesce(number.cast("string"), F.lit("null")))))


def bitmaps(fields: DataFrame, keys: list[str] = RUN) -> DataFrame:
    """Rows of the catalogue from keys of fields (keys, param_id, levtype, timespan, step, lev)."""
    sets = [F.bitmap_construct_agg(_position(F.col(c))).alias(name) for name, c in zip(_SETS, ("step", "lev"), strict=True)]
    return fields.groupBy(*keys, "param_id", "levtype").agg(*sets, F.collect_set("timespan").alias("spans"))


def merged(rows: DataFrame, keys: list[str] = RUN) -> DataFrame:
    """One row for each run, parameter and type of level."""
    sets = [F.bitmap_or_agg(c).alias(c) for c in _SETS]
    return rows.groupBy(*keys, "param_id", "levtype").agg(*sets, F.array_distinct(F.flatten(F.collect_set("spans"))).alias("spans"))


class BitmapCatalogue:
    """The catalogue under ``root``, a folder of its own."""

    def __init__(self, spark: SparkSession, root: str, keys: list[str] = RUN):
        self.spark, self.root, self.keys = spark, root.rstrip("/"), keys

    def _generations(self) -> list[str]:
        return sorted(files_of(self.spark, self.root).folders(f"{self.root}/generation-*"))

    def add(self, fields: DataFrame) -> None:
        """Append what has arrived."""
        found = self._generations()
        bitmaps(fields, self.keys).write.mode("append").parquet(found[-1] if found else f"{self.root}/generation-00000000")

    def rows(self) -> DataFrame:
        """All rows as they arrived."""
        found = self._generations()
        if not found:
            raise FileNotFoundError(f"no catalogue in {self.root}")
        return self.spark.read.parquet(found[-1])

    def table(self) -> DataFrame:
        return merged(self.rows(), self.keys)

    def compact(self) -> None:
        """Merge all rows into the next generation; nothing else may write meanwhile."""
        found = self._generations()
        files, name = files_of(self.spark, self.root), f"generation-{int(found[-1].rsplit('-', 1)[1]) + 1:08d}"
        part = f"{self.root}/_{name}"
        files.delete(part)
        self.table().write.parquet(part)
        files.move(part, f"{self.root}/{name}")
        for old in found:
            files.delete(old)


def completeness(table: DataFrame, expected: DataFrame, keys: list[str] = RUN) -> DataFrame:
    """What ``catalog.completeness`` says, from merged bitmaps: per run and expected parameter (``expected`` as there) what is missing.

    The bits that are had and expected are counted by a bit-and over two rows, one of each.
    """
    spark = table.sparkSession
    kinds = "param_id int, levtype string, param string, timespan string, steps binary, levels binary, n_steps int, n_levels int"
    asked = [(r["param_id"], r["levtype"], r["param"], r["timespan"], _bitmap(r["steps"]), None if r["levels"] is None else _bitmap(r["levels"]), len(set(r["steps"])), None if r["levels"] is None else len(set(r["levels"]))) for r in expected.collect()]
    asked = spark.createDataFrame(asked, kinds)  # a row for each required parameter
    runs = table.select(*keys).distinct().join(F.broadcast(asked))
    have = table.select(*keys, "param_id", "levtype", "spans", *_SETS, F.lit(1).alias("had"))
    both = runs.withColumns({"spans": F.lit(None).cast("array<string>"), "had": F.lit(0)}).unionByName(have, allowMissingColumns=True)
    sums = both.groupBy(*keys, "param_id", "levtype").agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in ("param", "timespan", "n_steps", "n_levels", "spans")], F.max("had").alias("had"), *[F.bitmap_count(F.bitmap_and_agg(c)).cast("int").alias(c) for c in _SETS]
    ).where("param is not null")
    lost = [F.coalesce(F.col(f"n_{c}") - F.when(F.col("had") == 1, F.col(c)).otherwise(0), F.lit(0)).cast("int").alias(f"missing_{c}") for c in _SETS]
    out = sums.select(*keys, "param", "param_id", F.coalesce(F.array_contains("spans", F.col("timespan")), F.lit(False)).alias("has_span"), *lost)
    return out.withColumn("complete", F.col("has_span") & (F.col("missing_steps") == 0) & (F.col("missing_levels") == 0))
