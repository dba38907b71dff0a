"""Fields as message files: a data source that reads what a request asks for, and one that commits whole files.

Layout: ``model/run_date/run_time/member/param_id/<step>.fields``, a file with the messages of all levels of one parameter
and step, in order, as they are or in compressed frames (``write_field_parts``). A file is a partition of the source for each ``SPLIT`` bytes.
Large fields are read in parts of ``PART`` cells, ``at`` being the first of them. Filters on keys are pushed down: those on the folders and on the
step prune while folders are listed, so no other file is opened; those on the level, its type and the time span are decided by a message's
head, so of other messages no values are read. Batches leave as Arrow.

Files are written through a sink that commits: tasks write beside the outputs, each attempt into a folder of its own, and
say which files they made. Only when all tasks are done are the files moved to their places, each whole, in place of what was there. A
task or job that fails leaves everything as it was; a repeated or lost attempt's files are never named, and go with the staging folder.

Both open files through Arrow's file systems (local, hdfs, s3, gs and others it knows), in tasks, not on the driver. A root
without a scheme is taken to be on the session's default file system, as Spark takes it.
"""

from __future__ import annotations

import bisect
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F

from ..functions import constants as C
from ..shipping import small_batches
from .field_store import PARTITIONS, SCHEMA, FieldStore
from .messages import _LEVEL, END, LongMessage, MessageError, encode_fields, field_begin, keys_of, pack_bits, parameter_of

FIELDS, FILES = "rimecast_fields", "rimecast_files"
SUFFIX = ".fields"
#: A message's first bytes, enough for its keys unless its grid is described at length; a batch holds about so many bytes.
HEAD, BATCH = 512, 8 << 20
#: Cells of a part, and bytes of a file that one task reads.
PART, SPLIT = 1 << 17, 8 << 20
#: Frames and table of the seekable form of Zstandard: any program for Zstandard gives back the messages one after the other.
_CODEC, _FAST, _FRAME, _SKIPPED, _SEEKABLE = "zstd", 1, b"\x28\xb5\x2f\xfd", 0x184D2A5E, 0x8F92EAB1
_STAGING = "_staging"
_WRITTEN = "written struct<time:bigint,path:string,row:int>"
_CONTENT = {"values": "at int, values array<double>, ", "message": "message binary, ", "head": "message binary, ", "keys": ""}


def source_schema(content: str) -> str:
    if content not in _CONTENT:
        raise ValueError(f"content is {', '.join(_CONTENT)}, not {content!r}")
    return f"step int, lev int, levtype string, timespan string, {_CONTENT[content]}model string, run_date string, run_time string, member string, param_id int, {_WRITTEN}"


def qualified(spark: SparkSession, root: str) -> str:
    """``root`` with its scheme: the default file system's where it has none."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(str(root))
    return path.getFileSystem(sc._jsc.hadoopConfiguration()).makeQualified(path).toString()


def file_system(root: str) -> tuple[pafs.FileSystem, str]:
    """Arrow's file system of a root, and the root's path on it."""
    if root.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + root.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(root) if "://" in root else (pafs.LocalFileSystem(), root)


# reading

_TESTS = {
    ds.EqualTo: lambda x, v: x == v,
    ds.EqualNullSafe: lambda x, v: x == v,
    ds.In: lambda x, v: x in v,
    ds.GreaterThan: lambda x, v: x > v,
    ds.GreaterThanOrEqual: lambda x, v: x >= v,
    ds.LessThan: lambda x, v: x < v,
    ds.LessThanOrEqual: lambda x, v: x <= v,
    ds.IsNotNull: lambda x, v: x is not None,
}
_KEYS = (*PARTITIONS, "step", "lev", "levtype", "timespan")


@dataclass
class FieldFile(ds.InputPartition):
    """One file, a parameter and a step of one member, or one of several shares of it."""

    path: str
    keys: dict
    time: int
    share: int = 0
    shares: int = 1

    def __repr__(self) -> str:
        return f"FieldFile({self.path})"


class Frames:
    """A file of compressed frames as the bytes that they hold."""

    def __init__(self, f: pa.NativeFile, path: str):
        self.f, self.path, self.codec, self.last = f, path, pa.Codec(_CODEC), (-1, b"")
        n, kind, magic = struct.unpack("<IBI", f.read_at(9, f.size() - 9)) if f.size() >= 17 else (0, 0, 0)
        room = 8 * n + 17
        table = f.read_at(room, f.size() - room) if magic == _SEEKABLE and not kind and room <= f.size() else b""
        if len(table) < 17 or struct.unpack_from("<II", table) != (_SKIPPED, room - 8):
            raise MessageError(f"{path}: frames without their table")
        sizes = np.frombuffer(table, "<u4", 2 * n, 8).reshape(n, 2).astype(np.int64)
        self.packed, self.plain = (np.concatenate([[0], x.cumsum()]).tolist() for x in sizes.T)
        if self.packed[-1] + room != f.size():
            raise MessageError(f"{path}: frames of {self.packed[-1]} bytes, expected {f.size() - room}")

    def size(self) -> int:
        return self.plain[-1]

    def _frame(self, k: int) -> bytes:
        if self.last[0] != k:
            data = self.f.read_at(self.packed[k + 1] - self.packed[k], self.packed[k])
            try:
                self.last = k, self.codec.decompress(data, self.plain[k + 1] - self.plain[k], asbytes=True)
            except OSError as x:
                raise MessageError(f"{self.path}: frame {k} is broken") from x
        return self.last[1]

    def read_at(self, n: int, at: int) -> bytes:
        end, out = min(at + n, self.size()), []
        k = bisect.bisect_right(self.plain, at) - 1
        while at < end:
            out.append(self._frame(k)[at - self.plain[k] : end - self.plain[k]])
            at, k = self.plain[k + 1], k + 1
        return out[0] if len(out) == 1 else b"".join(out)


def frames_table(sizes: list[tuple[int, int]]) -> bytes:
    """The end of a file of frames, from their sizes: compressed and plain."""
    entries = np.array(sizes, "<u4").tobytes()
    return struct.pack("<II", _SKIPPED, len(entries) + 9) + entries + struct.pack("<IBI", len(sizes), 0, _SEEKABLE)


class FieldReader(ds.DataSourceReader):
    def __init__(self, options: dict):
        self.root, self.content = options["root"], options.get("content", "values")
        self.tests: list[tuple[str, type, object]] = []

    def pushFilters(self, filters):
        for f in filters:
            column = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if column in _KEYS and type(f) in _TESTS:
                self.tests.append((column, type(f), getattr(f, "value", None)))
            else:
                yield f

    def _wanted(self, keys: dict) -> bool:
        return all(_TESTS[kind](keys[column], value) for column, kind, value in self.tests if column in keys)

    def partitions(self) -> list[FieldFile]:
        store, base = file_system(self.root)
        folders = [(base, {})]
        for column in PARTITIONS:
            below = []
            for folder, keys in folders:
                for x in store.get_file_info(pafs.FileSelector(folder, allow_not_found=True)):
                    if x.type == pafs.FileType.Directory and x.base_name[0] not in "._":
                        have = keys | {column: int(x.base_name) if column == "param_id" else x.base_name}
                        if self._wanted(have):
                            below.append((x.path, have))
            folders = below
        files = []
        for folder, keys in folders:
            for x in store.get_file_info(pafs.FileSelector(folder)):
                if x.is_file and x.base_name.endswith(SUFFIX) and x.base_name[0] not in "._":
                    have = keys | {"step": int(x.base_name.removesuffix(SUFFIX))}
                    if self._wanted(have):
                        shares = -(-max(x.size, 1) // SPLIT) if self.content == "values" else 1
                        files += [FieldFile(x.path, have, (x.mtime_ns or 0) // 1000, k, shares) for k in range(shares)]
        return sorted(files, key=lambda f: (f.path, f.share))

    def read(self, partition: FieldFile | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # nothing fits the request
            return
        store, _ = file_system(self.root)
        rows, size = [], 0
        with store.open_input_file(partition.path) as f:
            for row, (keys, found) in enumerate(self._messages(f, partition)):
                for at, content in self._contents(found, partition) if found is not None else ():
                    rows.append((keys, row, at, content))
                    size += content.nbytes if self.content == "values" else len(content)
                    if size >= BATCH:
                        yield self._batch(rows, partition)
                        rows, size = [], 0
        if rows:
            yield self._batch(rows, partition)

    def _contents(self, found: tuple, partition: FieldFile) -> Iterator[tuple[int, object]]:
        """(first cell, what is asked for) of the share's parts of a message; but for values there is one."""
        read, total = found
        if self.content == "keys":
            yield 0, b""
        elif self.content == "message":
            yield 0, read(total, 0)
        elif self.content == "head":
            yield 0, LongMessage(read, total).head()
        else:
            if total <= 8 * PART:
                whole = read(total, 0)
                read = lambda n, at: whole[at : at + n]
            message = LongMessage(read, total)
            n = max(1, -(-message.points() // PART))
            begin, end = (n * k // partition.shares for k in (partition.share, partition.share + 1))
            if not message.points() and begin < end:
                yield 0, np.empty(0)
            yield from message.values(PART, begin, end)

    def _messages(self, f: pa.NativeFile, partition: FieldFile) -> Iterator[tuple[dict, tuple | None]]:
        """Keys of each message, and where it is wanted how to read it (see ``LongMessage``) and its length."""
        if f.size() >= 4 and f.read_at(4, 0) == _FRAME:
            f = Frames(f, partition.path)
        at, end = 0, f.size()
        while at < end:
            want = min(HEAD, end - at)
            head = f.read_at(want, at)
            if len(head) < 16 or head[:4] != b"GRIB":
                raise MessageError(f"{partition.path}: no message at byte {at}")
            (total,) = struct.unpack_from(">Q", head, 8)
            if total < 16 or at + total > end:
                raise MessageError(f"{partition.path}: a message of {total} bytes at byte {at} doesn't fit")
            while True:
                try:
                    keys = keys_of(head)
                    break
                except MessageError:
                    if want >= total:
                        raise
                    want = min(total, want * 8)
                    head = f.read_at(want, at)
            name = parameter_of(keys)
            if C.PARAMS.get(name) != partition.keys["param_id"] or keys["step"] != partition.keys["step"]:
                raise MessageError(f"{partition.path}: holds {name} of step {keys['step']}")
            have = partition.keys | {"lev": keys["lev"], "levtype": "ml" if keys["surface"] == _LEVEL else "sfc", "timespan": "fs" if keys["interval"] else "none"}
            wanted = self._wanted(have)
            yield have, (lambda n, k, begin=at: f.read_at(n, begin + k), total) if wanted else None
            at += total

    def _batch(self, rows: list, partition: FieldFile) -> pa.RecordBatch:
        column = lambda name, kind: pa.array([keys[name] for keys, *_ in rows], kind)
        out = [("step", column("step", pa.int32())), ("lev", column("lev", pa.int32())), ("levtype", column("levtype", pa.string())), ("timespan", column("timespan", pa.string()))]
        if self.content == "values":
            parts = [values for *_, values in rows]
            ends = np.cumsum([0, *map(len, parts)])
            out.append(("at", pa.array([at for _, _, at, _ in rows], pa.int32())))
            out.append(("values", pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(parts)))))
        elif self.content in ("message", "head"):
            out.append(("message", pa.array([m for *_, m in rows], pa.binary())))
        out += [(c, column(c, pa.int32() if c == "param_id" else pa.string())) for c in PARTITIONS]
        n = len(rows)
        written = [pa.array([partition.time] * n, pa.int64()), pa.array([partition.path] * n, pa.string()), pa.array([r for _, r, _, _ in rows], pa.int32())]
        out.append(("written", pa.StructArray.from_arrays(written, ["time", "path", "row"])))
        return pa.RecordBatch.from_arrays([a for _, a in out], [c for c, _ in out])


class FieldSource(ds.DataSource):
    @classmethod
    def name(cls) -> str:
        return FIELDS

    def schema(self) -> str:
        return source_schema(self.options.get("content", "values"))

    def reader(self, schema) -> FieldReader:
        return FieldReader(dict(self.options))


# writing


@dataclass
class Staged(ds.WriterCommitMessage):
    """What one task's successful attempt has written: paths under the root with their sizes."""

    folder: str
    files: dict[str, int]


class FileWriter(ds.DataSourceArrowWriter):
    """Rows (path, content) as files: rows of one path that follow each other are one file."""

    def __init__(self, options: dict):
        self.root, self.job = options["root"], uuid.uuid4().hex

    def _place(self) -> tuple[pafs.FileSystem, str, str]:
        store, base = file_system(self.root)
        return store, base.rstrip("/"), f"{base.rstrip('/')}/{_STAGING}/{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        store, _, staging = self._place()
        folder, files, out, path = f"{staging}/{uuid.uuid4().hex}", {}, None, None
        try:
            for batch in iterator:
                for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    if name != path:
                        if out is not None:
                            out.close()
                        if not name or name in files or name[0] == "/" or {"", ".", ".."} & set(name.split("/")):
                            raise ValueError(f"{name!r} is no path under the root, or its rows don't follow each other")
                        path, files[name] = name, 0
                        store.create_dir(f"{folder}/{name}".rsplit("/", 1)[0], recursive=True)
                        out = store.open_output_stream(f"{folder}/{name}")
                    data = content.as_buffer()
                    out.write(data)
                    files[name] += data.size
            if out is not None:
                out.close()
        except BaseException:
            if out is not None and not out.closed:
                out.close()
            if store.get_file_info(folder).type == pafs.FileType.Directory:
                store.delete_dir(folder)
            raise
        return Staged(folder, files)

    def commit(self, messages: list[Staged | None]) -> None:
        store, base, staging = self._place()
        todo = {}
        for m in messages:
            for name, size in m.files.items() if m else ():
                if name in todo:
                    raise ValueError(f"{name} was written by two tasks")
                todo[name] = (f"{m.folder}/{name}", size)
        for x, (source, size) in zip(store.get_file_info([s for s, _ in todo.values()]), todo.values(), strict=True):
            if not x.is_file or x.size != size:
                raise OSError(f"{source} has {x.size} bytes, expected {size}")
        for folder in {f"{base}/{name}".rsplit("/", 1)[0] for name in todo}:
            store.create_dir(folder, recursive=True)
        for name, (source, _) in todo.items():
            store.move(source, f"{base}/{name}")
        self._clear(store, staging)

    def abort(self, messages: list[Staged | None]) -> None:
        store, _, staging = self._place()
        self._clear(store, staging)

    def _clear(self, store: pafs.FileSystem, staging: str) -> None:
        if store.get_file_info(staging).type == pafs.FileType.Directory:
            store.delete_dir(staging)


class FileSink(ds.DataSource):
    @classmethod
    def name(cls) -> str:
        return FILES

    def writer(self, schema, overwrite: bool) -> FileWriter:
        return FileWriter(dict(self.options))


def register(spark: SparkSession) -> None:
    """Make both known to the session, and let filters reach the source."""
    small_batches(spark)
    if spark.conf.get("spark.rimecast.sources", None) is None:
        spark.dataSource.register(FieldSource)
        spark.dataSource.register(FileSink)
        spark.conf.set("spark.rimecast.sources", "registered")
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def write_files(rows: DataFrame, root: str, *, in_order: bool = False) -> None:
    """Commit rows (path, content), and any columns to sort the parts of a file by: all of a path's rows become one file.

    With ``in_order`` the rows of a path lie in one task already, one after the other, and aren't exchanged again.
    """
    register(rows.sparkSession)
    order = [c for c in rows.columns if c not in ("path", "content")]
    dealt = rows if in_order else rows.repartition("path").sortWithinPartitions("path", *order)
    dealt.select("path", "content").write.format(FILES).option("root", qualified(rows.sparkSession, root)).mode("append").save()


def write_field_files(fields: DataFrame, root: str, *, bits: int | None = None, shape: tuple[int, ...] | None = None, in_order: bool = False) -> None:
    """Encode ``fields`` and commit a file for each parameter and step, in place of what it held; with ``bits`` values are packed.

    ``in_order``: fields of one parameter and step follow each other in one task, by level.
    """
    encoded = encode_fields(fields.select(*[f.name for f in SCHEMA]), bits=bits, shape=shape)
    write_files(encoded.select(_path(), "lev", F.col("message").alias("content")), root, in_order=in_order)


def _path():
    """Where messages of a parameter and step are."""
    name = F.concat(F.lpad(F.col("step").cast("string"), 5, "0"), F.lit(SUFFIX))
    return F.concat_ws("/", *PARTITIONS, name).alias("path")


def write_field_parts(parts: DataFrame, root: str) -> None:
    """Commit fields that come in parts (``at``: the first cell) as files of compressed frames, in place of what a parameter and step had.

    A part becomes a frame where it is; frames are exchanged and put one after the other, so that no task holds a whole field. Values are
    in double precision as they are. Parts that leave a gap, overlap or come twice are errors.
    """
    spark = parts.sparkSession
    register(spark)
    names = {i: n for n, i in C.PARAMS.items()}
    keys = ["path", "param_id", "run_date", "run_time", "member", "step", "lev"]
    kinds = "path string, param_id int, run_date string, run_time string, member string, step int, lev int, at int, n int, defined int, bitmap binary, data binary"

    def packed(batches):
        codec = pa.Codec(_CODEC, _FAST)
        for b in batches:
            values = b.column("values")
            ends, flat = values.offsets.to_numpy(), values.values.to_numpy(zero_copy_only=False)
            rows = []
            for i in range(b.num_rows):
                v = np.asarray(flat[ends[i] : ends[i + 1]], np.float64)
                ok = np.isfinite(v)
                known = v if ok.all() else v[ok]
                rows.append((len(v), len(known), None if len(known) == len(v) else np.packbits(ok).tobytes(), codec.compress(known.astype(">f8"), asbytes=True) if len(known) else b""))
            n, defined, bitmap, data = zip(*rows, strict=True) if rows else ((),) * 4
            size, m = pa.array(n, pa.int32()), len(rows)
            own = [b.column(k) for k in [*keys, "at"]]
            own += [size, pa.array(defined, pa.int32())]
            # what a field's beginning says of all its parts comes before their frames
            yield pa.RecordBatch.from_arrays([*own, pa.array(bitmap, pa.binary()), pa.nulls(m, pa.binary())], [*keys, "at", "n", "defined", "bitmap", "data"])
            yield pa.RecordBatch.from_arrays([*own, pa.nulls(m, pa.binary()), pa.array(data, pa.binary())], [*keys, "at", "n", "defined", "bitmap", "data"])

    def joined(batches):
        codec = pa.Codec(_CODEC, _FAST)
        path, field, heads, sizes, out = None, None, [], [], []

        def put(data: bytes, plain: int) -> None:
            sizes.append((len(data), plain))
            out.append((path, data))

        def begin() -> None:
            _, param, date, time, member, step, lev = field
            at = 0
            for first, n, _, _ in heads:
                if first != at:
                    raise MessageError(f"{path}, level {lev}: a part begins at cell {first}, expected {at}")
                at += n
            bits = None
            if any(bitmap is not None for *_, bitmap in heads):
                bits = pack_bits(np.concatenate([np.ones(n, bool) if x is None else np.unpackbits(np.frombuffer(x, np.uint8), count=n).astype(bool) for _, n, _, x in heads]), 1)
            head = field_begin(names[param], at, sum(d for _, _, d, _ in heads), bits, run_date=date, run_time=time, member=member, step=step, lev=lev)
            put(codec.compress(head, asbytes=True), len(head))
            heads.clear()

        def close() -> None:
            if field is not None:
                put(codec.compress(END, asbytes=True), len(END))

        def end() -> None:
            if path is not None:
                close()
                out.append((path, frames_table(sizes)))
                sizes.clear()

        def batch() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), (pa.string(), pa.binary()), strict=True)], ["path", "content"])
            out.clear()
            return made

        for b in batches:
            data = b.column("data")
            for i, (*key, at, n, defined, bitmap) in enumerate(zip(*[b.column(k).to_pylist() for k in [*keys, "at", "n", "defined", "bitmap"]], strict=True)):
                if key != field:
                    if key[0] != path:
                        end()
                        path = key[0]
                    else:
                        close()
                    field = key
                if not data[i].is_valid:
                    heads.append((at, n, defined, bitmap))
                    continue
                if heads:
                    begin()
                if defined:
                    put(data[i].as_py(), 8 * defined)
                if len(out) >= 16:
                    yield batch()
        end()
        if out:
            yield batch()

    rows = parts.select(_path(), *keys[1:], "at", "values").mapInArrow(packed, kinds)
    dealt = rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path").sortWithinPartitions("path", "lev", F.col("data").isNotNull(), "at")
    write_files(dealt.mapInArrow(joined, "path string, content binary"), root, in_order=True)


class MessageStore(FieldStore):
    """The store's requests over message files."""

    def scan(self, content: str = "values") -> DataFrame:
        register(self.spark)
        return self.spark.read.format(FIELDS).option("root", qualified(self.spark, self.root)).option("content", content).load()

    def catalogue(self) -> DataFrame:
        """Distinct keys, from the heads of messages."""
        return self.scan("keys").select(*PARTITIONS, "step", "lev", "levtype", "timespan").distinct()

    def request(self, **ask) -> DataFrame:
        return self.stored(**ask)

    def keys(self, **ask) -> DataFrame:
        """A row for each message of a request, from its head."""
        return self.ask(self.scan("keys"), **ask)

    def messages(self, **ask) -> DataFrame:
        """A request's fields as the messages that they are."""
        return self.ask(self.scan("message"), **ask)

    def heads(self, **ask) -> DataFrame:
        """The first sections, up to the product, of a request's messages (``message``)."""
        return self.ask(self.scan("head"), **ask)
