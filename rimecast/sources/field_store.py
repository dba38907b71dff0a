"""A store of fields on a partitioned table: one row per field, or per part of a field, its values as an array.

Layout (the folder names are partition columns, so that a request prunes folders):
``model/run_date/run_time/member/param_id`` with columns step, lev (0 for single-level fields),
levtype, timespan and values (array<double>, one per cell). Large fields come in parts, so that no task holds a whole one:
``at`` is the cell of a part's first value (0, or not there, for whole fields). A part's values may be packed: ``n`` values as ``data``, double
precision compressed, which go on as they are to where they are needed. The store's own catalogue is the
partition listing; no field is opened for it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import constants as C
from ..shipping import small_batches

PARTITIONS = ["model", "run_date", "run_time", "member", "param_id"]
SCHEMA = T.StructType(
    [
        T.StructField("step", T.IntegerType(), False),
        T.StructField("lev", T.IntegerType(), False),
        T.StructField("levtype", T.StringType()),
        T.StructField("timespan", T.StringType()),
        T.StructField("values", T.ArrayType(T.DoubleType(), False)),
        T.StructField("model", T.StringType()),
        T.StructField("run_date", T.StringType()),
        T.StructField("run_time", T.StringType()),
        T.StructField("member", T.StringType()),
        T.StructField("param_id", T.IntegerType()),
    ]
)
PACKED = [T.StructField("at", T.IntegerType()), T.StructField("n", T.IntegerType()), T.StructField("data", T.BinaryType())]
PART_SCHEMA = T.StructType([*SCHEMA.fields, *PACKED])
#: How parts are packed: fast, as they are read as often as written.
CODEC, CODEC_LEVEL = "zstd", 1
#: A task has so many files open at most; rows of more partitions are sorted.
_OPEN_FILES = 64


def unsorted_writes(spark: SparkSession) -> None:
    """Let tasks of this session keep a file open for each partition, instead of sorting large rows by partition before they write."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    if int(spark.conf.get(key)) <= 0:
        spark.conf.set(key, str(_OPEN_FILES))


def write_fields(fields: DataFrame, root: str, mode: str = "append") -> None:
    """Add fields, whole or, with a column ``at``, in parts, these with ``values`` or packed (``n``, ``data``)."""
    unsorted_writes(fields.sparkSession)
    optional = {"values", "at", "n", "data"}
    fields.select(*[f.name for f in PART_SCHEMA if f.name not in optional or f.name in fields.columns]).write.mode(mode).partitionBy(*PARTITIONS).parquet(root)


def packed(b: pa.RecordBatch) -> pa.RecordBatch:
    """A batch with ``n`` and ``data``, its last columns, in place of ``values``."""
    codec, k = pa.Codec(CODEC, CODEC_LEVEL), b.schema.get_field_index("values")
    ends, flat = b.column(k).offsets.to_numpy(), b.column(k).values.to_numpy(zero_copy_only=False)
    data = [codec.compress(np.ascontiguousarray(flat[i:j], np.float64), asbytes=True) for i, j in zip(ends[:-1], ends[1:], strict=True)]
    rest = [c for c in b.schema.names if c != "values"]
    return pa.RecordBatch.from_arrays([*[b.column(c) for c in rest], pa.array(np.diff(ends), pa.int32()), pa.array(data, pa.binary())], [*rest, "n", "data"])


def unpack(fields: DataFrame) -> DataFrame:
    """Rows of a store with ``values`` in any case."""
    small_batches(fields.sparkSession)
    plain = fields.where("data is null").drop("n", "data")
    rest = [c for c in plain.columns if c != "values"]

    def unpacked(batches):
        codec = pa.Codec(CODEC)
        for b in batches:
            n, data = b.column("n").to_pylist(), b.column("data")
            values = [np.frombuffer(codec.decompress(data[i].as_buffer(), 8 * m), np.float64) for i, m in enumerate(n)]
            whole = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *n]), pa.int32()), pa.array(np.concatenate([np.empty(0), *values])))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in rest], whole], [*rest, "values"])

    kinds = ", ".join(f"{c} {plain.schema[c].dataType.simpleString()}" for c in rest)
    return plain.unionByName(fields.where("data is not null").select(*rest, "n", "data").mapInArrow(unpacked, f"{kinds}, values array<double>"))


class FieldStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def scan(self) -> DataFrame:
        """All fields, in the parts and form they were written in; ``written`` orders repeated ones by when, and where in a file, they were written."""
        fields = self.spark.read.schema(PART_SCHEMA).parquet(self.root).withColumn("at", F.coalesce("at", F.lit(0)))
        return fields.withColumn("written", F.struct("_metadata.file_modification_time", "_metadata.file_path", "_metadata.row_index"))

    def request(self, **ask) -> DataFrame:
        """Fields of a request (see ``ask``), in parts with their values."""
        return unpack(self.stored(**ask))

    def stored(self, **ask) -> DataFrame:
        """The same in the form that the store has."""
        return self.ask(self.scan(), **ask)

    def keys(self, **ask) -> DataFrame:
        """A row for each field of a request, without values."""
        return self.stored(**ask).where("at = 0").drop("at", "values", "n", "data")

    @staticmethod
    def ask(fields: DataFrame, *, model: str, run_date: str, run_time: str, member: str | list[str], params: list[str], steps: tuple[int, int] | None = None, levels: tuple[int, int] | None = None, timespan: str | None = None) -> DataFrame:
        """Filters of a request: keys of partitions first, then step and level ranges, all pushed to the scan."""
        members = [member] if isinstance(member, str) else member
        out = fields.where(
            (F.col("model") == model) & (F.col("run_date") == run_date) & (F.col("run_time") == run_time) & F.col("member").isin(*members) & F.col("param_id").isin(*[C.PARAMS[p] for p in params])
        )
        if steps:
            out = out.where(F.col("step").between(*steps))
        if timespan:
            out = out.where(F.col("timespan") == timespan)
        return out.where(F.col("lev").between(*levels)) if levels else out

    def catalogue(self) -> DataFrame:
        """Distinct keys: partition values with steps, levels, levtype and timespan; values aren't read."""
        return self.scan().select(*PARTITIONS, "step", "lev", "levtype", "timespan").distinct()


def cells(fields: DataFrame) -> DataFrame:
    """One row per cell of each field: cell_id and value in place of values."""
    keep = [c for c in fields.columns if c != "values"]
    return fields.select(*keep, F.posexplode("values").alias("cell_id", "value"))
