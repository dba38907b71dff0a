"""Spark helpers shared by the operators: shared scratch, bounded key filters, components."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import shared_dir
from ..shipping import ship

#: A key filter has at most this many bits (32 MB), and is used for at most ``MAX_FILTER_KEYS`` keys;
#: beyond that callers join on the keys, so that no filter lets nearly everything through.
MAX_FILTER_BITS = 1 << 28
MAX_FILTER_KEYS = MAX_FILTER_BITS // 12
_SEGMENT = 32768
BATCH_BYTES = 8 << 20
#: So many edges (2 MB) are joined up in one task: dealing them out would cost more than it spreads.
FEW_EDGES = 1 << 17


def settings(spark: SparkSession) -> None:
    """What Python operators need: the package on the workers, and Arrow batches of at most ``BATCH_BYTES`` (or one row).

    The bound in bytes holds for the session's later queries too; it changes no result.
    """
    ship(spark)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if _bytes(spark.conf.get(key)) > BATCH_BYTES:
        spark.conf.set(key, f"{BATCH_BYTES}b")


def _bytes(size: str) -> int:
    """A size as Spark's settings write it: 67108864, 65536k, 64m, 64MB; what isn't understood, such as -1, counts as unbounded."""
    found = re.fullmatch(r"([0-9]+)([kmgtp]?)(?:i?b)?", size.strip().lower())
    return int(found[1]) << 10 * " kmgtp".index(found[2] or " ") if found else 1 << 62


def fresh(taken: list[str], *names: str) -> list[str]:
    """Column names like the given ones that clash with none of ``taken``, whatever the case."""
    used, out = {c.lower() for c in taken}, []
    for name in names:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage and survives lost executors."""
    path = os.path.join(_scratch(df.sparkSession), f"{label}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    _written(df.sparkSession).append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _written(spark: SparkSession) -> list[str]:
    """Folders that this application has materialized and not deleted, oldest first."""
    sc = spark.sparkContext
    if not hasattr(sc, "_rimecast_written"):
        sc._rimecast_written = []
    return sc._rimecast_written


@contextmanager
def only_last(spark: SparkSession) -> Iterator[None]:
    """Of what is materialized within, only the last table stays: what came before served to make it. If the block fails, none stays.

    Only for blocks whose other tables no plan outside still reads.
    """
    paths, before = _written(spark), len(_written(spark))
    keep = 0
    try:
        yield
        keep = 1
    finally:
        gone = paths[before : len(paths) - keep]
        for path in gone:
            _delete(spark, path)
        del paths[before : before + len(gone)]


def _delete(spark: SparkSession, folder: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _scratch(spark: SparkSession) -> str:
    return os.path.join(shared_dir(spark), "rimecast", spark.sparkContext.applicationId)


def clean(spark: SparkSession) -> bool:
    """Delete all that this application has materialized; call it when its results have been written."""
    _written(spark).clear()
    return _delete(spark, _scratch(spark))


class KeyFilter:
    """A bit set over well-mixed 64-bit keys with no false negatives; whatever passes is decided exactly afterwards."""

    def __init__(self, bits: np.ndarray, log2: int):
        self.bits, self.log2 = bits, log2

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        m = np.uint64((1 << self.log2) - 1)
        hit = np.ones(len(keys), bool)
        for shift in (0, 32):
            at = (keys >> np.uint64(shift)) & m
            hit &= (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1
        return hit


def _log2(n: int) -> int:
    return min(MAX_FILTER_BITS.bit_length() - 1, max(20, (32 * max(n, 1)).bit_length()))


def key_filter(keys: DataFrame, column: str, n: int) -> KeyFilter | None:
    """Build a KeyFilter of ``n`` keys on the executors (the driver gets bits only); None if they are too many."""
    if n > MAX_FILTER_KEYS:
        return None
    log2 = _log2(n)
    m, key = (1 << log2) - 1, F.col(column)
    at = F.explode(F.array(key.bitwiseAND(F.lit(m)), F.shiftrightunsigned(key, 32).bitwiseAND(F.lit(m)))).alias("at")
    segments = keys.select(at).groupBy(F.shiftright("at", 15).alias("segment")).agg(F.bitmap_construct_agg(F.col("at") % _SEGMENT).alias("part"))
    bits = np.zeros((1 << log2) // 8, np.uint8)
    for r in segments.collect():  # 32 MB at most
        part = np.frombuffer(r["part"], np.uint8)
        bits[r["segment"] * _SEGMENT // 8 :][: len(part)] = part
    return KeyFilter(bits, log2)


def split_rows(rows: DataFrame, key: Column, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` whose 64-bit ``key`` may be among ``keys`` (one long column, written out), and the rows whose key surely isn't.

    Built-in functions only. The bit set is a broadcast table of segments, 32 MB at most; with more
    than ``MAX_FILTER_KEYS`` keys all rows may be among them.
    """
    n, (column,) = keys.count(), keys.columns
    if n > MAX_FILTER_KEYS:
        return rows, rows.limit(0)
    m = (1 << _log2(n)) - 1
    place = F.col(column).bitwiseAND(F.lit(m)).alias("at")
    segment, part, at = fresh(rows.columns, "segment", "part", "at")
    bits = keys.select(place).groupBy(F.shiftright("at", 15).alias(segment)).agg(F.bitmap_construct_agg(F.col("at") % _SEGMENT).alias(part))
    bits = materialize(bits, "key-bits")
    tested = rows.withColumn(at, key.bitwiseAND(F.lit(m))).withColumn(segment, F.shiftright(at, 15)).join(F.broadcast(bits), segment, "left")
    byte = F.conv(F.hex(F.substring(F.col(part), F.shiftright(F.col(at) % _SEGMENT, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.coalesce(F.shiftright(byte, 0).bitwiseAND(F.pow(F.lit(2), F.col(at) % 8).cast("int")) != 0, F.lit(False))
    return tested.where(bit).select(*rows.columns), tested.where(~bit).select(*rows.columns)


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Connected components of undirected edges: rows (node, root), root the smallest node.

    Alternating large-star and small-star steps; each step is two aggregates and a join
    over edges, none gathers a node's neighbours in one place. At most ``FEW_EDGES`` edges are joined up in one task.
    """
    ship(edges.sparkSession)
    e = materialize(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "edges")
    size = _weight(e)
    if size[0] <= FEW_EDGES:
        return materialize(e.repartition(1).mapInArrow(_joined_up, "node long, root long"), "roots")
    while size[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # written, so that the join below exchanges both its sides and a hub's rows can be split
        low = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "lowest")
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = large.unionByName(low.where("m < u").select("u", F.col("m").alias("v")))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        e = materialize(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        was, size = size, _weight(e)
        if was == size:
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _joined_up(batches):
    """Roots of the nodes of a few edges, by union and find."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = x = root[up] if up in root else up
        return x

    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            u, v = find(u), find(v)
            root[max(u, v)] = min(u, v)
    found = [(x, r) for x in list(root) if (r := find(x)) != x]
    yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["node", "root"])


def _weight(e: DataFrame) -> tuple:
    r = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return int(r[0]), r[1]
