"""Outputs: categorical fields as partitioned tables or field messages, documents as JSON files.

All of a run's outputs go through Hadoop's view of the path, or, for messages, through a sink that resolves the path as Hadoop does:
a root without a scheme is on the session's default file system for every one of them.
"""

from __future__ import annotations

import json
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from math import prod
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import constants as C
from ..functions.tokens import output_path
from ..operators.validate import check_codes
from ..shipping import small_batches
from .field_source import FILES, qualified, register
from .field_store import unsorted_writes
from .messages import LongMessage, coded_message, decode_fields, refill, shape_of

RUN_KEYS = ["model", "run_date", "run_time", "member"]
OUTPUT_KEYS = [*RUN_KEYS, "step"]


#: One file of a step's outputs holds at most so many cells.
CELLS_PER_FILE = 4_000_000
OUTPUT_SCHEMA = "cell_id long, ptype int, param_id int, model string, run_date string, run_time string, member string, step int"


def read_categorical(spark: SparkSession, root: str) -> DataFrame:
    """What ``write_categorical`` has written; members stay text."""
    return spark.read.schema(OUTPUT_SCHEMA).parquet(root)


class _Files:
    """Hadoop's view of a path, whatever file system it is on."""

    def __init__(self, spark: SparkSession, root: str):
        sc = spark.sparkContext
        self.jvm, self.gateway = sc._jvm, sc._gateway
        self.make = sc._jvm.org.apache.hadoop.fs.Path
        self.fs = self.make(root).getFileSystem(sc._jsc.hadoopConfiguration())

    def folders(self, pattern: str) -> list[str]:
        return [s.getPath().toString() for s in self.fs.globStatus(self.make(pattern)) or [] if s.isDirectory()]

    def exists(self, path: str) -> bool:
        return self.fs.exists(self.make(path))

    def delete(self, path: str) -> None:
        self.fs.delete(self.make(path), True)

    def move(self, source: str, target: str) -> None:
        self.fs.mkdirs(self.make(target).getParent())
        if not self.fs.rename(self.make(source), self.make(target)):
            raise OSError(f"can't move {source} to {target}")

    def put(self, path: str, content: bytes) -> None:
        """A whole file in place of what was there: readers see the old one or the new one."""
        part = f"{path}.{uuid.uuid4().hex}.tmp"
        out = self.fs.create(self.make(part), True)
        try:
            out.write(bytearray(content))
        finally:
            out.close()
        rename = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
        how = self.gateway.new_array(rename, 1)
        how[0] = rename.OVERWRITE
        try:
            self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.fs.getConf()).rename(self.make(part), self.make(path), how)
        except Exception:
            self.delete(part)
            raise


def files_of(spark: SparkSession, root: str) -> _Files:
    """The files under a root, on whatever file system it is."""
    return _Files(spark, root)


@contextmanager
def staging(spark: SparkSession, root: str) -> Iterator[str]:
    """A folder of its own beside the outputs, which readers of ``root`` skip; it goes in any case."""
    path = f"{root.rstrip('/')}/_staging/{uuid.uuid4().hex}"
    try:
        yield path
    finally:
        _Files(spark, root).delete(path)


def write_categorical(field: DataFrame, root: str, *, expected: int | None = None) -> dict[str, int]:
    """Write cell_id and ptype under model/run_date/run_time/member/step, in place of what those members had.

    ``field`` has a row per cell, or ``codes`` of cells that follow each other and the first one's number, ``at``: these are dealt out as they
    are, and become rows where they are written.

    All is written beside the outputs and checked there (codes, and their number if ``expected`` is given); only then each
    member's folder is put in its place by renaming. A failure leaves the outputs as they were, a second write gives the same
    rows, and other members may be written meanwhile. Returns the number of steps written of each member.
    """
    spark = field.sparkSession
    unsorted_writes(spark)
    packed = "codes" in field.columns
    whole = packed or isinstance(field.schema["ptype"].dataType, T.IntegralType)
    good = field if whole else check_codes(field, expected=expected)
    with staging(spark, root) as path:
        # dealt out by step, so that the number of files follows from the number of cells, not of tasks
        if packed:
            tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))  # by their size, codes of many cells would be put into one task
            dealt = good.select(*OUTPUT_KEYS, "at", "codes").repartition(tasks, *OUTPUT_KEYS, F.floor(F.col("at") / CELLS_PER_FILE))
            good = dealt.select(*OUTPUT_KEYS, "at", F.posexplode("codes").alias("k", "ptype")).withColumn("cell_id", F.col("at") + F.col("k"))
        rows = good.select(*OUTPUT_KEYS, F.lit(C.OUTPUT_PARAM).alias("param_id"), F.col("cell_id").cast("long").alias("cell_id"), F.col("ptype").cast("int").alias("ptype"))
        dealt = rows if packed else rows.repartition(*OUTPUT_KEYS, F.floor(F.col("cell_id") / CELLS_PER_FILE))
        dealt.write.partitionBy(*OUTPUT_KEYS).option("compression", "zstd").parquet(f"{path}/new")
        files = _Files(spark, root)
        members = files.folders(f"{path}/new/" + "/".join(f"{k}=*" for k in RUN_KEYS))
        if members:
            if whole:
                check_codes(spark.read.schema(rows.schema).parquet(f"{path}/new"), expected=expected)
        elif expected:
            raise ValueError(f"the field has 0 values, expected {expected}")
        done = {}
        for k, new in enumerate(members):
            names = new.split("/")[-len(RUN_KEYS) :]
            place, old = "/".join([root.rstrip("/"), *names]), f"{path}/old-{k}"
            replaced = files.exists(place)
            if replaced:
                files.move(place, old)
            try:
                files.move(new, place)
            except Exception:
                if replaced:
                    files.move(old, place)
                raise
            done[names[-1].split("=", 1)[1]] = len(files.folders(f"{place}/step=*"))
        return done


@dataclass(frozen=True)
class Template:
    """What an encoder fills with codes: a message of one field, and the field's shape."""

    message: bytes
    shape: tuple[int, ...]


def whole_codes(field: DataFrame) -> DataFrame:
    """(OUTPUT_KEYS, codes): the codes of each member and step in the order of cells, from a row per cell."""
    return field.groupBy(*OUTPUT_KEYS).agg(F.sort_array(F.collect_list(F.struct("cell_id", "ptype")))["ptype"].alias("codes"))  # one field


def commit_messages(whole: DataFrame, root: str, templates: DataFrame, encode: Callable[[Template, list[int]], bytes] | None = None) -> int:
    """Codes of whole fields as messages, one file per member and step under ``root``; how many were committed.

    ``templates``: rows (message, and shape if the encoder needs one other than the message's own) with those of ``OUTPUT_KEYS`` that
    tell them apart, as a rule each step's own field of precipitation. ``encode`` makes a message from its template and codes; by
    default ``refill``. A step without a template is an error. All files appear, each whole, or, if anything fails before, none.
    """
    spark = whole.sparkSession
    register(spark)
    by = [k for k in OUTPUT_KEYS if k in templates.columns]
    shape = ["shape"] if "shape" in templates.columns else []
    path = output_path("", *[F.col(k) for k in OUTPUT_KEYS])
    rows = whole.select(*OUTPUT_KEYS, "codes", F.ltrim(path, F.lit("/")).alias("path")).join(templates.select(*by, *shape, "message"), by, "left")

    def encoded(batches):
        import pyarrow as pa

        for b in batches:
            done, codes = [], b.column("codes")
            for i, r in enumerate(b.drop_columns(["codes"]).to_pylist()):
                if r["message"] is None:
                    raise ValueError(f"no template for {r['path']}")
                size = tuple(r["shape"]) if shape else shape_of(r["message"])
                own = codes[i].values
                if prod(size) != len(own):
                    raise ValueError(f"{len(own)} codes don't fill the shape {list(size)} of {r['path']}")
                done.append(encode(Template(r["message"], size), own.to_pylist()) if encode else refill(r["message"], own.to_numpy(zero_copy_only=False)))
            yield pa.RecordBatch.from_arrays([b.column("path"), pa.array(done, pa.binary())], ["path", "content"])

    rows.mapInArrow(encoded, "path string, content binary").write.format(FILES).option("root", qualified(spark, root)).mode("append").save()
    return whole.count()


def commit_codes(codes: DataFrame, root: str, heads: DataFrame) -> None:
    """``commit_messages`` for codes of cells that follow each other (OUTPUT_KEYS, codes, and the first one's number, ``at``).

    ``heads``: (OUTPUT_KEYS, message), of each step's own message its first sections. A task takes the codes of one message in order and holds
    them in a byte each; codes that leave a gap or come twice are errors, as is a step without a head.
    """
    spark = codes.sparkSession
    register(spark)
    path = F.ltrim(output_path("", *[F.col(k) for k in OUTPUT_KEYS]), F.lit("/")).alias("path")
    none = F.lit(None)
    rows = codes.select(path, F.col("at").cast("long").alias("at"), "codes", none.cast("binary").alias("head"))
    rows = rows.unionByName(heads.select(path, F.lit(-1).cast("long").alias("at"), none.cast("array<int>").alias("codes"), F.col("message").alias("head")))
    dealt = rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path").sortWithinPartitions("path", "at")

    def encoded(batches):
        import numpy as np
        import pyarrow as pa

        path, head, found, n = None, None, [], 0

        def made():
            if path is None or (head is not None and not n):  # a head without codes is another step's
                return
            if head is None:
                raise ValueError(f"no template for {path}")
            message = coded_message(head, np.concatenate(found))
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([message], pa.binary())], ["path", "content"])

        for b in batches:
            codes = b.column("codes")
            for i, (name, at, first) in enumerate(zip(*[b.column(k).to_pylist() for k in ("path", "at", "head")], strict=True)):
                if name != path:
                    yield from made()
                    path, head, found, n = name, None, [], 0
                if at < 0:
                    if head is not None:
                        raise ValueError(f"more than one template for {path}")
                    head = first
                    continue
                if at != n:
                    raise ValueError(f"codes of {path} begin at cell {at}, expected {n}")
                own = codes[i].values.to_numpy(zero_copy_only=False)
                small = len(own) and 0 <= own.min() and own.max() < 256
                found.append(own.astype(np.uint8) if small else own)
                n += len(own)
        yield from made()

    dealt.mapInArrow(encoded, "path string, content binary").write.format(FILES).option("root", qualified(spark, root)).mode("append").save()


def write_messages(field: DataFrame, root: str, templates: DataFrame, encode: Callable[[Template, list[int]], bytes] | None = None) -> DataFrame:
    """A row per cell as messages (see ``commit_messages``), written when called: rows (model, run_date, run_time, member, step, path, cells)."""
    checked = check_codes(field)
    commit_messages(whole_codes(checked), root, templates, encode)
    path = output_path(root, *[F.col(k) for k in OUTPUT_KEYS]).alias("path")
    return checked.groupBy(*OUTPUT_KEYS).agg(F.count("*").alias("cells")).select(*OUTPUT_KEYS, path, "cells")


def read_messages(spark: SparkSession, root: str) -> DataFrame:
    """What ``commit_messages`` has written: (OUTPUT_KEYS, codes), keys from the paths, codes from the messages."""
    return decode_fields(_message_files(spark, root)).select(*OUTPUT_KEYS, F.col("values").cast("array<int>").alias("codes"))


def read_codes(spark: SparkSession, root: str, size: int = 1 << 17) -> DataFrame:
    """The same in parts of ``size`` cells (a multiple of 8): (OUTPUT_KEYS, at, codes), ``at`` being a part's first cell."""
    small_batches(spark)

    def decoded(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            for i in range(b.num_rows):
                content = b.column("message")[i].as_buffer()
                message = LongMessage(lambda n, at, content=content: content[at : at + n].to_pybytes(), len(content))
                keys = [b.column(k)[i] for k in OUTPUT_KEYS]
                for at, values in message.values(size):
                    codes = pa.array(values.astype(np.int32))
                    part = pa.ListArray.from_arrays(pa.array([0, len(codes)], pa.int32()), codes)
                    yield pa.RecordBatch.from_arrays([*[pa.repeat(k, 1) for k in keys], pa.array([at], pa.int32()), part], [*OUTPUT_KEYS, "at", "codes"])

    return _message_files(spark, root).mapInArrow(decoded, "model string, run_date string, run_time string, member string, step int, at int, codes array<int>")


def _message_files(spark: SparkSession, root: str) -> DataFrame:
    """(OUTPUT_KEYS, message) of the files under ``root``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.ptype.grib2").load(root)
    part = lambda k: F.regexp_extract("path", r"/([^/]+)/([^/]+)/([^/]+)/([^/]+)/lfff([0-9]{2})([0-9]{2})0000[^/]*$", k)
    keys = [part(k + 1).alias(name) for k, name in enumerate(RUN_KEYS)]
    step = (part(5).cast("int") * 24 + part(6).cast("int")).alias("step")
    return files.select(*keys, step, F.col("content").alias("message"))


def _whole_file(path: Path, content: bytes) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    fd, part = tempfile.mkstemp(dir=path.parent, prefix=f"{path.name}.", suffix=".tmp")
    try:
        with os.fdopen(fd, "wb") as f:
            f.write(content)
        os.replace(part, path)
    except BaseException:
        Path(part).unlink(missing_ok=True)
        raise


def write_json(payload: dict, destination: str | Path, spark: SparkSession | None = None) -> str | Path:
    """Indented, sorted JSON with a final newline; a reader sees the old file or the whole new one.

    With a session the destination is on whatever file system Hadoop finds for it, as the outputs are; without, a local file.
    """
    text = json.dumps(payload, indent=2, sort_keys=True) + "\n"
    if spark is not None:
        _Files(spark, str(destination)).put(str(destination), text.encode())
        return destination
    path = Path(destination)
    _whole_file(path, text.encode())
    return path
