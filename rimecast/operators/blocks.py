"""The column diagnostic over fields, as groups of cells: the way of a production run.

A field (one array of values per parameter, step and level, whole or in parts) is cut into groups of ``GROUP`` cells, each
compressed. All groups are exchanged once, by group, and sorted by step: heights come first, then step after step, so one pass over a
partition de-accumulates precipitation, checks that each parameter has exactly its levels, counts quality and
diagnoses whole matrices of levels by cells, holding one step of one group at a time. Results are in blocks of ``BLOCK`` cells.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as C
from ..shipping import ship, small_batches
from ..sources.field_store import CODEC, CODEC_LEVEL
from .kernel import ptype

BLOCK = 1024
#: Cells that are exchanged and sorted together, a multiple of ``BLOCK``, and those that the kernel takes at once.
GROUP, _KERNEL = 64 * BLOCK, 4 * BLOCK
_BLOCKS_PER_BATCH = 1024
LEVEL_PARAMS = ("T", "P", "QV")
#: Bad cells kept of each block and step: enough for a preview.
KEPT_BAD = 6
_STATIC = -1
_NAMES = {i: n for n, i in C.PARAMS.items()}
_RESULT = "step int, block int, ptype array<int>, " + ", ".join(f"{c} long" for c in C.QUALITY_COUNTERS) + ", bad_ground array<int>, bad_profile array<int>, problem string"


def field_blocks(fields: DataFrame, size: int = BLOCK) -> DataFrame:
    """(param_id, step, lev, block, values) from fields; heights, which hold for all steps, get a step before the first."""
    step = F.when(F.col("param_id") == C.PARAMS["HHL"], _STATIC).otherwise(F.col("step")).alias("step")
    ship(fields.sparkSession)

    def cut(batches):
        for b in batches:
            values = b.column(3)
            ends = values.offsets.to_numpy()
            for i in range(b.num_rows):
                n = int(ends[i + 1] - ends[i])
                at = np.append(np.arange(0, n, size), n)
                for k in range(0, len(at) - 1, _BLOCKS_PER_BATCH):
                    edges = at[k : k + _BLOCKS_PER_BATCH + 1]
                    parts = pa.ListArray.from_arrays(pa.array(edges - edges[0], pa.int32()), values.values.slice(int(ends[i] + edges[0]), int(edges[-1] - edges[0])))
                    m = len(parts)
                    keys = [pa.repeat(b.column(c)[i], m) for c in range(3)]
                    yield pa.RecordBatch.from_arrays([*keys, pa.array(np.arange(k, k + m), pa.int32()), parts], ["param_id", "step", "lev", "block", "values"])

    # cut in Arrow: slices of an array in an expression over all its blocks would each go through the whole array
    return fields.where(F.size("values") > 0).select("param_id", step, "lev", "values").mapInArrow(cut, "param_id int, step int, lev int, block int, values array<double>")


def whole_fields(parts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Fields from parts of them: of the rows that differ only in ``at`` and ``values``, the values one after the other by ``at``.

    Fields with the same ``by`` (all keys, if it isn't given) follow each other in one task, which holds one field at a time.
    """
    spark = parts.sparkSession
    ship(spark)
    keys = [c for c in parts.columns if c not in ("at", "values")]
    by = by or keys

    def joined(batches):
        key, found, kinds = None, [], None

        def field():
            values = pa.concat_arrays(found)
            return pa.RecordBatch.from_arrays([*[pa.array([v], t) for v, t in zip(key, kinds, strict=True)], pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)], [*keys, "values"])

        for b in batches:
            kinds = [b.schema.field(c).type for c in keys]
            values = b.column("values")
            for i, k in enumerate(zip(*[b.column(c).to_pylist() for c in keys], strict=True)):
                if k != key:
                    if found:
                        yield field()
                    key, found = k, []
                found.append(values[i].values)
        if found:
            yield field()

    # a fixed number of tasks: by their size as compressed, many fields would be put into one
    dealt = parts.select(*keys, "at", "values").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *by)
    kinds = ", ".join(f"{k} {parts.schema[k].dataType.simpleString()}" for k in keys)
    return dealt.sortWithinPartitions(*by, *[k for k in keys if k not in by], "at").mapInArrow(joined, f"{kinds}, values array<double>")


def _begin(fields: DataFrame):
    """The cell of a row's first value; fields without ``at`` are whole."""
    return F.col("at") if "at" in fields.columns else F.lit(0).alias("at")


def field_groups(fields: DataFrame, size: int = GROUP) -> DataFrame:
    """(param_id, step, lev, group, begin, n, data) from fields or their parts: compressed values of cells of one group, from its ``begin`` on.

    Packed parts that lie in one group go on as they are. Heights, which hold for all steps, get a step before the first.
    """
    step = F.when(F.col("param_id") == C.PARAMS["HHL"], _STATIC).otherwise(F.col("step")).alias("step")
    small_batches(fields.sparkSession)

    def cut(batches):
        codec = pa.Codec(CODEC, CODEC_LEVEL)
        for b in batches:
            values, ready = b.column(4), b.column(6)
            ends = values.offsets.to_numpy()
            flat = values.values.to_numpy(zero_copy_only=False)
            source, group, begin, n, data = [], [], [], [], []
            for i, (at, m) in enumerate(zip(b.column(3).to_pylist(), b.column(5).to_pylist(), strict=True)):
                own = ready[i].is_valid
                if not own:
                    part = flat[ends[i] : ends[i + 1]]
                elif at // size < (at + m - 1) // size:
                    part, own = np.frombuffer(codec.decompress(ready[i].as_buffer(), 8 * m), np.float64), False
                a, last = at, at + (m if own else len(part))
                while a < last:
                    z = min(last, a - a % size + size)
                    source.append(i)
                    group.append(a // size)
                    begin.append(a % size)
                    n.append(z - a)
                    data.append(ready[i].as_py() if own else codec.compress(np.ascontiguousarray(part[a - at : z - at], np.float64), asbytes=True))
                    a = z
            keys = [b.column(c).take(pa.array(source, pa.int64())) for c in range(3)]
            yield pa.RecordBatch.from_arrays([*keys, *[pa.array(x, pa.int32()) for x in (group, begin, n)], pa.array(data, pa.binary())], ["param_id", "step", "lev", "group", "begin", "n", "data"])

    if "data" not in fields.columns:
        fields = fields.withColumns({"n": F.lit(None).cast("int"), "data": F.lit(None).cast("binary")})
    used = fields.where((F.size("values") > 0) | (F.col("n") > 0)).select("param_id", step, "lev", _begin(fields), "values", "n", "data")
    return used.mapInArrow(cut, "param_id int, step int, lev int, group int, begin int, n int, data binary")


def _by_group(groups: DataFrame) -> DataFrame:
    """Groups dealt out, each sorted by step; a fixed number of tasks, as by their size as compressed, many would be put into one."""
    n = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return groups.repartition(n, "group").sortWithinPartitions("group", "step", "param_id", "lev", "begin")


def _steps(batches):
    """(group, step, rows) of sorted groups; rows are lists of (level, first cell within the group, values) by parameter."""
    codec, key, rows = pa.Codec(CODEC), None, {}
    for b in batches:
        param, steps, lev, group, begin, n = (b.column(k).to_numpy(zero_copy_only=False).tolist() for k in range(6))
        data = b.column(6)
        for i in range(b.num_rows):
            if (group[i], steps[i]) != key:
                if rows:
                    yield *key, rows
                key, rows = (group[i], steps[i]), {}
            values = np.frombuffer(codec.decompress(data[i].as_buffer(), 8 * n[i]), np.float64)
            rows.setdefault(param[i], []).append((lev[i], begin[i], values))
    if rows:
        yield *key, rows


def _copies(pieces: list) -> list[tuple[int, np.ndarray]]:
    """(level, values) of each field in a group, from (level, begin, values); a field that is there twice comes twice."""
    found: list[list] = []
    for lev, begin, values in sorted(pieces, key=lambda x: x[:2]):
        if begin == 0:
            found.append([lev, len(values), [values]])
            continue
        before = next((f for f in found if f[0] == lev and f[1] == begin), None)
        if before is None:
            raise LookupError(f"the parts of level {lev} don't follow each other")
        before[1] += len(values)
        before[2].append(values)
    return [(lev, v[0] if len(v) == 1 else np.concatenate(v)) for lev, _, v in found]


def lowest_heights(fields: DataFrame) -> DataFrame:
    """(lev, height_m): the lowest height of each full level (0 at the top) over all cells, from fields of half levels."""

    def lowest(batches):
        for _, _, rows in _steps(batches):
            try:
                half = _copies(rows[C.PARAMS["HHL"]])
            except LookupError:
                continue  # said when the group is diagnosed
            low: dict[int, float] = {}
            for lev, upper in half:
                for lower in (v for k, v in half if k == lev + 1):
                    n = min(len(upper), len(lower))
                    low[lev - 1] = np.fmin(low.get(lev - 1, np.nan), np.fmin.reduce(0.5 * (upper[:n] + lower[:n])))
            yield pa.RecordBatch.from_arrays([pa.array(list(low), pa.int32()), pa.array(list(low.values()), pa.float64())], ["lev", "low"])

    half = _by_group(field_groups(fields.where(F.col("param_id") == C.PARAMS["HHL"])))
    return half.mapInArrow(lowest, "lev int, low double").groupBy("lev").agg(F.min("low").alias("height_m"))


class _Group:
    """What is kept of a group of cells from step to step."""

    def __init__(self, number: int, first_level: int, last_level: int, threshold: float):
        self.number, self.levels, self.threshold = number, range(first_level, last_level + 1), threshold
        self.heights: np.ndarray | None = None
        self.before: np.ndarray | None = None

    def _stack(self, rows: dict, param: str, levels: range) -> np.ndarray:
        found = _copies(rows.get(C.PARAMS[param], []))
        have = [lev for lev, _ in found]
        if have != list(levels):
            lost, twice = sorted(set(levels) - set(have)), sorted({x for x in have if have.count(x) > 1})
            raise LookupError(f"{param}: expected {len(levels)} field(s), got {len(have)}" + (f", missing level(s) {lost[:5]}" if lost else "") + (f", repeated level(s) {twice[:5]}" if twice else ""))
        return np.stack([v for _, v in found])

    def _flat(self, rows: dict, param: str) -> np.ndarray:
        found = _copies(rows.get(C.PARAMS[param], []))
        if len(found) != 1:
            raise LookupError(f"{param}: expected 1 field(s), got {len(found)}")
        return found[0][1]

    def take(self, step: int, rows: dict) -> list[tuple]:
        """The results of one step, one for each block of cells."""
        number = self.number * (GROUP // BLOCK)
        try:
            if step == _STATIC:
                half = self._stack(rows, "HHL", range(self.levels.start, self.levels.stop + 1))
                self.heights = 0.5 * (half[:-1] + half[1:])
                return []
            if self.heights is None:
                raise LookupError("HHL: no heights")
            t, p, q = (self._stack(rows, x, self.levels) for x in LEVEL_PARAMS)
            total, ground = self._flat(rows, "TOT_PREC"), self._flat(rows, "T_G") - C.KELVIN
            rain = total if self.before is None else total - self.before
            self.before = total
            if not t.shape == p.shape == q.shape == self.heights.shape or not rain.shape == ground.shape == t.shape[1:]:
                raise LookupError("fields differ in their number of cells")
        except (LookupError, ValueError) as x:
            return [(number, step, [], [0] * len(C.QUALITY_COUNTERS), [], [], str(x).strip("'\""))]
        rain_ok, ground_ok = np.isfinite(rain), np.isfinite(ground)
        whole = np.logical_and.reduce([np.isfinite(x).all(axis=0) for x in (t, p, q, self.heights)])
        active = rain_ok & (np.where(rain_ok, rain, 0.0) > self.threshold)
        no_ground, no_profile = active & ~ground_ok, active & ~whole
        masks = (active, ~rain_ok, ~ground_ok, ~whole, no_ground, no_profile)
        codes = np.zeros(len(rain), np.int32)
        good = np.flatnonzero(active & ground_ok & whole)
        for k in range(0, len(good), _KERNEL):
            at = good[k : k + _KERNEL]
            codes[at] = ptype(*(np.ascontiguousarray(x[:, at]) for x in (t, q, p, self.heights)), ground[at])
        out = []
        for k in range(0, len(rain), BLOCK):
            cells = slice(k, k + BLOCK)
            counted = [len(rain[cells]), *(int(m[cells].sum()) for m in masks)]
            out.append((number + k // BLOCK, step, codes[cells], counted, np.flatnonzero(no_ground[cells])[:KEPT_BAD], np.flatnonzero(no_profile[cells])[:KEPT_BAD], None))
        return out


def diagnose_groups(groups: DataFrame, *, first_level: int, last_level: int, threshold: float = 0.0) -> DataFrame:
    """One row per step and block: codes, quality counters, bad active cells, and what is wrong with its fields (``problem``).

    Levels are numbered as in the fields, ``first_level`` to ``last_level``; half levels go one further.
    """
    small_batches(groups.sparkSession)

    def packed(results: list) -> pa.RecordBatch:
        at = lambda k: [r[k] for r in results]
        ints, base = pa.list_(pa.int32()), np.array(at(0)) * BLOCK
        bad = [pa.array([np.asarray(x, np.int32) + b for x, b in zip(at(k), base, strict=True)], ints) for k in (4, 5)]
        counts = [pa.array([r[3][j] for r in results], pa.int64()) for j in range(len(C.QUALITY_COUNTERS))]
        columns = [pa.array(at(1), pa.int32()), pa.array(at(0), pa.int32()), pa.array(at(2), ints), *counts, *bad, pa.array(at(6), pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["step", "block", "ptype", *C.QUALITY_COUNTERS, "bad_ground", "bad_profile", "problem"])

    def run(batches):
        group: _Group | None = None
        for number, step, rows in _steps(batches):
            if group is None or number != group.number:
                group = _Group(number, first_level, last_level, threshold)
            if done := group.take(step, rows):
                yield packed(done)

    return _by_group(groups).mapInArrow(run, _RESULT)


def field_counts(fields: DataFrame, expected: DataFrame) -> DataFrame:
    """Fields that aren't there exactly once: (param_id, step, lev, n) for each of ``expected`` (param_id, step, lev) with n <> 1. Values aren't read."""
    begun = fields.where("at = 0") if "at" in fields.columns else fields  # the first part of each
    found = begun.groupBy("param_id", "step", "lev").agg(F.count("*").alias("n"))
    return expected.join(found, ["param_id", "step", "lev"], "left").select("param_id", "step", "lev", F.coalesce("n", F.lit(0)).alias("n")).where("n <> 1")


def block_codes(results: DataFrame, size: int = BLOCK) -> DataFrame:
    """(step, at, codes): the codes of each block and the cell of its first one."""
    return results.select("step", (F.col("block").cast("long") * size).alias("at"), F.col("ptype").alias("codes"))


def step_codes(results: DataFrame) -> DataFrame:
    """(step, codes): the whole field of each step, in the order of cells."""
    blocks = F.sort_array(F.collect_list(F.struct("block", "ptype")))["ptype"]
    return results.groupBy("step").agg(F.flatten(blocks).alias("codes"))  # one field
