"""Repeated long spans, by a de Bruijn graph of token k-mers.

A window is ``k`` consecutive words of one text. A word goes when it lies in a window whose
word sequence also starts earlier (in a row with a smaller id, or earlier in the same one).

Plan. (1) Anchors: each window has a minimizer, the smallest of its hashed ``ANCHOR``-word
runs; equal windows have equal minimizers. An anchor matters when texts with different word
sequences have it, or one text has it twice. (2) A bit set of these anchors lets a second pass
emit only windows that may repeat. These are the edges of the graph: each k-mer with its
occurrences' count, its earliest source coordinate, and the edge that follows and the one that precedes all
occurrences, where there is only one. (3) Compaction by joins: an edge begins a path when nothing, or
several edges, precede it, or when the one edge before it branches; that is a join of edges with the
branching ones. Ends of paths are found likewise. Within a path all occurrences go on together, so its edges follow one
another at their earliest coordinates, and the path that begins at a coordinate ends at the next end there. (4) A
join of the heads with their occurrences (a bit set of heads lets a third pass emit little else) gives whole
spans (text, start, words); source coordinates tell the spans that start earlier elsewhere. (5) Rows that may
have spans are joined with them; all others are emitted directly.

Texts with equal words follow each other's every edge, so the graph needs none of them but for what other texts share
with them: each copy but the first is one span from its first edge to its last, told by a 128-bit digest of
the words themselves.

Bit sets err only towards too many, and whatever passes is decided exactly; with more keys than a set can
tell apart, joins take their place. k-mers are compared by two independent 64-bit hashes, which no arrangement of
words makes equal.

Ids must be whole numbers (TypeError otherwise). A row's own start matters for ties: rows that repeat an id are one
after the other in the order of their word sequences' hashes; exactly repeated rows (same id and words) are one document and get
equal results. Rows with a null id come after all others. Null texts have no words. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import U, Words, binaries, chunks, fold, inside, signed, text_buffers, windows
from .common import key_filter, materialize, settings, split_rows

ANCHOR = 6
_LAST = 0x7FFFFFFFFFFFFFFF
#: Bits of a word sequence's hash within a coordinate, and of a position.
_SEQ_BITS, _POS_BITS = 30, 32
_EDGE = "h long, c long, at decimal(38,0), next long, prev long"


def minimizers(grams: np.ndarray, span: int) -> np.ndarray:
    """For each run of ``span`` consecutive grams the position of the smallest (the first of equals)."""
    best, at = grams.copy(), np.arange(len(grams))
    width = 1
    while width < span:  # windows of doubled width, then the exact one
        step = min(width, span - width)
        n = len(best) - step
        if n <= 0:
            return np.empty(0, np.int64)
        take = best[step:] < best[:n]
        at, best = np.where(take, at[step:], at[:n]), np.where(take, best[step:], best[:n])
        width += step
    return at


def coordinates(doc: np.ndarray, sequence: np.ndarray, pos: np.ndarray) -> pa.Array:
    """Doc, sequence and position as one decimal that sorts by them in turn."""
    out = np.empty((len(doc), 2), np.uint64)
    low = _SEQ_BITS + _POS_BITS
    doc = np.ascontiguousarray(doc, np.int64)
    out[:, 0] = (doc.view(np.uint64) << U(low)) | ((sequence >> U(64 - _SEQ_BITS)) << U(_POS_BITS)) | pos.astype(np.uint64)
    out[:, 1] = (doc >> (64 - low)).view(np.uint64)
    return pa.Array.from_buffers(pa.decimal128(38, 0), len(doc), [None, pa.py_buffer(out.tobytes())])


def _places(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Doc, sequence bits and position of coordinates."""
    raw = np.frombuffer(column.buffers()[1], np.uint64)[2 * column.offset : 2 * (column.offset + len(column))].reshape(-1, 2)
    low = _SEQ_BITS + _POS_BITS
    doc = (raw[:, 1] << U(64 - low)) | (raw[:, 0] >> U(low))
    return doc.view(np.int64), ((raw[:, 0] >> U(_POS_BITS)) & U((1 << _SEQ_BITS) - 1)).astype(np.int32), (raw[:, 0] & U((1 << _POS_BITS) - 1)).astype(np.int64)


def _sequences(w: Words, h: np.ndarray) -> np.ndarray:
    """A hash of each text's word sequence."""
    cut = w.first.tolist()
    return np.array([int.from_bytes(fold(h, a, z)[:8], "little") for a, z in zip(cut[:-1], cut[1:], strict=True)], np.uint64)


def _parse(texts, k: int, anchor: int):
    """Per chunk: the first row, words, word hashes, valid windows, their anchors' positions, and hashes of anchors."""
    data, offsets = text_buffers(texts)
    for lo, hi in chunks(offsets):
        w = Words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        h = w.hashes()
        if len(h) < k:
            continue
        grams = windows(h, anchor, 1)
        at = minimizers(grams, k - anchor + 1)
        good = np.flatnonzero(inside(w.first, k))
        if len(good):
            yield lo, w, h, good, at[good], grams


def _own_anchors(k: int, anchor: int, with_doc: bool):
    """Each text's distinct anchors with the hash of its sequence; one that it has twice comes with a second hash too."""

    def run(batches):
        for b in batches:
            doc = b.column(0).to_numpy(zero_copy_only=False)
            for lo, w, h, _, at, grams in _parse(b.column(1), k, anchor):
                at = np.unique(at)
                owner = np.searchsorted(w.first, at, side="right") - 1
                value, sequence = grams[at], _sequences(w, h)
                order = np.lexsort((value, owner))
                value, owner = value[order], owner[order]
                first = np.r_[True, (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])]
                if with_doc:
                    value, owner = value[first], owner[first]
                    yield pa.RecordBatch.from_arrays([signed(value), pa.array(doc[lo + owner]), _bits(sequence[owner])], ["anchor", "doc", "seq"])
                    continue
                twice = np.add.reduceat(np.ones(len(value), np.int64), np.flatnonzero(first)) > 1
                value, s = value[first], sequence[owner[first]]
                yield pa.RecordBatch.from_arrays([signed(np.r_[value, value[twice]]), signed(np.r_[s, ~s[twice]])], ["anchor", "sequence"])

    return run


def _bits(sequence: np.ndarray) -> pa.Array:
    return pa.array((sequence >> U(64 - _SEQ_BITS)).astype(np.int32))


def _wanted(batch, lo: int, w: Words, good: np.ndarray, at: np.ndarray, grams: np.ndarray, keep) -> np.ndarray:
    """Mask over the windows: their anchors pass the filter or, without one, are in the row's own list."""
    if keep is not None:
        return keep(grams[at])
    hit, owner = np.zeros(len(good), bool), np.searchsorted(w.first, good, side="right") - 1
    for i in np.unique(owner):
        mine = owner == i
        hit[mine] = np.isin(grams[at[mine]].view(np.int64), batch.column(2)[int(lo + i)].values.to_numpy())
    return hit


def _edges(k: int, anchor: int, wanted):
    def run(batches):
        for b in batches:
            doc = b.column(0).to_numpy(zero_copy_only=False)
            for lo, w, h, good, at, grams in _parse(b.column(1), k, anchor):
                start = good[_wanted(b, lo, w, good, at, grams, wanted.value)]
                if not len(start):
                    continue
                one, two = windows(h, k)[start], windows(w.hashes(1), k)[start]
                owner = np.searchsorted(w.first, start, side="right") - 1
                joined = (start[1:] == start[:-1] + 1) & (owner[1:] == owner[:-1])  # the next row is the next window of the same text
                after, before = np.zeros(len(start), np.uint64), np.zeros(len(start), np.uint64)
                after[:-1], before[1:] = np.where(joined, one[1:], 0), np.where(joined, one[:-1], 0)
                place = coordinates(doc[lo + owner], _sequences(w, h)[owner], start - w.first[owner])
                yield pa.RecordBatch.from_arrays([signed(one), signed(two), place, signed(after), signed(before)], ["h", "c", "at", "next", "prev"])

    return run


def _occurrences(k: int, anchor: int, wanted, heads):
    """Windows that may be path heads, with their coordinates."""

    def run(batches):
        head = heads.value
        for b in batches:
            doc = b.column(0).to_numpy(zero_copy_only=False)
            for lo, w, h, good, at, grams in _parse(b.column(1), k, anchor):
                start = good[_wanted(b, lo, w, good, at, grams, wanted.value)]
                one = windows(h, k)
                start = start if head is None else start[head(one[start])]
                if len(start):
                    owner = np.searchsorted(w.first, start, side="right") - 1
                    columns = [signed(one[start]), signed(windows(w.hashes(1), k)[start]), pa.array(doc[lo + owner]), _bits(_sequences(w, h)[owner]), pa.array((start - w.first[owner]).astype(np.int64))]
                    yield pa.RecordBatch.from_arrays(columns, ["h", "c", "doc", "seq", "pos"])

    return run


def _placed(batches):
    """Coordinates taken apart."""
    for b in batches:
        doc, seq, pos = _places(b.column(2))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(doc), pa.array(seq), pa.array(pos), b.column(3)], ["h", "c", "doc", "seq", "pos", "ends"])


def _texts(docs: DataFrame) -> DataFrame:
    if not isinstance(docs.schema["doc_id"].dataType, T.IntegralType):
        raise TypeError("substring dedup needs whole numbers as doc_id: which of two repeats stays is told by the order of ids")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc"), "text")


def _listed(texts: DataFrame, shared: DataFrame, k: int, anchor: int) -> DataFrame:
    """Texts with their shared anchors as lists: the way beyond the size of a bit set."""
    own = texts.mapInArrow(_own_anchors(k, anchor, True), "anchor long, doc long, seq int").join(shared, "anchor", "left_semi")
    lists = own.groupBy("doc", "seq").agg(F.collect_set("anchor").alias("anchors"))
    return materialize(texts.mapInArrow(_tagged, "doc long, seq int, text string").join(lists, ["doc", "seq"]).select("doc", "text", "anchors"), "listed")


def _tagged(batches):
    """Texts with the bits of their sequence."""
    for b in batches:
        data, offsets = text_buffers(b.column(1))
        for lo, hi in chunks(offsets):
            w = Words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
            part = b.slice(lo, hi - lo)
            yield pa.RecordBatch.from_arrays([part.column(0), _bits(_sequences(w, w.hashes())), part.column(1)], ["doc", "seq", "text"])


def paths(graph: DataFrame) -> DataFrame:
    """Unbranched paths of edges (h, c, at, next, prev; 0: none, or several): (h, c, doc, seq, pos) of the first edge and ``edges``, their number."""
    begins, ends = (materialize(graph.where(f"{c} = 0").select("h"), name) for c, name in (("prev", "path-begins"), ("next", "path-ends")))

    def beside(column: str, keys: DataFrame) -> DataFrame:
        maybe, _ = split_rows(graph.where(F.col(column) != 0), F.col(column), keys)
        return maybe.join(keys.select(F.col("h").alias(column)), column, "left_semi")

    first = graph.where("prev = 0").unionByName(beside("prev", ends)).select("h", "c", "at", F.lit(False).alias("ends"))
    last = graph.where("next = 0").unionByName(beside("next", begins)).select("h", "c", "at", F.lit(True).alias("ends"))
    marks = first.unionByName(last).mapInArrow(_placed, "h long, c long, doc long, seq int, pos long, ends boolean")
    ahead = Window.partitionBy("doc", "seq").orderBy("pos").rangeBetween(Window.currentRow, Window.unboundedFollowing)
    marks = marks.withColumn("end", F.min(F.when(F.col("ends"), F.col("pos"))).over(ahead))
    return marks.where(~F.col("ends")).select("h", "c", "doc", "seq", "pos", (F.col("end") - F.col("pos") + 1).alias("edges"))


def repeated_spans(docs: DataFrame, *, k: int = 20, anchor: int = ANCHOR) -> DataFrame:
    """Spans to remove: (doc, seq, start, words), ids as in ``docs`` (null ids as the largest), seq: bits of the hash of the row's words."""
    spark = docs.sparkSession
    settings(spark)
    texts = _texts(docs).where(F.col("text").isNotNull()).select("doc", "text")
    found = texts.mapInArrow(_own_anchors(k, anchor, False), "anchor long, sequence long")
    found = found.groupBy("anchor").agg(F.min("sequence").alias("a"), F.max("sequence").alias("z"))
    shared = materialize(found.where("a <> z").select("anchor"), "anchors")
    chosen = key_filter(shared, "anchor", shared.count())
    if chosen is None:
        texts = _listed(texts, shared, k, anchor)
    wanted = spark.sparkContext.broadcast(chosen)
    edges = texts.mapInArrow(_edges(k, anchor, wanted), _EDGE)
    graph = edges.groupBy("h", "c").agg(F.count("*").alias("n"), F.min("at").alias("at"), *[f(c).alias(f"{c}_{name}") for c in ("next", "prev") for name, f in (("lo", F.min), ("hi", F.max))])
    one = lambda c: F.when(F.col(f"{c}_lo") == F.col(f"{c}_hi"), F.col(f"{c}_lo")).otherwise(0).alias(c)
    graph = materialize(graph.where("n > 1").select("h", "c", "at", one("next"), one("prev")), "graph")
    heads = paths(graph).select("h", "c", F.col("doc").alias("src_doc"), F.col("seq").alias("src_seq"), F.col("pos").alias("src_pos"), "edges")
    heads = materialize(heads, "paths")
    first = spark.sparkContext.broadcast(key_filter(heads, "h", heads.count()))
    at = texts.mapInArrow(_occurrences(k, anchor, wanted, first), "h long, c long, doc long, seq int, pos long").join(heads, ["h", "c"])
    source = (F.col("doc") == F.col("src_doc")) & (F.col("seq") == F.col("src_seq")) & (F.col("pos") == F.col("src_pos"))
    spans = at.where(~source).select("doc", "seq", F.col("pos").cast("int").alias("start"), (F.col("edges") + (k - 1)).cast("int").alias("words"))
    return spans.unionByName(_copies(_texts(docs).where(F.col("text").isNotNull()).select("doc", "text"), k))


def _copies(texts: DataFrame, k: int) -> DataFrame:
    """One span for each text whose words are all those of a text with a smaller id."""
    rows = materialize(texts.mapInArrow(_digests, "doc long, seq int, digest binary, n int").where(F.col("n") >= k), "sequences")
    originals = materialize(rows.groupBy("digest").agg(F.min("doc").alias("original"), F.count("*").alias("copies")).where("copies > 1").select("digest", "original"), "originals")
    return rows.join(originals, "digest").where("doc <> original").select("doc", "seq", F.lit(0).alias("start"), F.col("n").alias("words"))


def _digests(batches):
    for b in batches:
        data, offsets = text_buffers(b.column(1))
        for lo, hi in chunks(offsets):
            w = Words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
            yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), _bits(_sequences(w, w.hashes())), binaries(w.digests()), pa.array(np.diff(w.first).astype(np.int32))], ["doc", "seq", "digest", "n"])


def _cut(batches):
    """Each text's words that lie in none of its spans (the last column), joined by a space."""
    for b in batches:
        spans, listed = (b.column(2), True) if b.num_columns > 2 else (None, False)
        data, offsets = text_buffers(b.column(1))
        for lo, hi in chunks(offsets):
            w = Words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
            gone = np.zeros(len(w.start), bool)
            for i in range(hi - lo if listed else 0):
                for s in spans[lo + i].as_py() or ():
                    gone[w.first[i] + s["start"] : min(w.first[i] + s["start"] + s["words"], w.first[i + 1])] = True
            kept = np.flatnonzero(~gone)
            raw, cut = w.joined(kept)
            n, left = np.diff(w.first), np.diff(np.searchsorted(kept, w.first))
            text = pa.array([raw[a : max(a, z - 1)] for a, z in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array(n.astype(np.int64)), pa.array((n - left).astype(np.int64)), text], ["doc_id", "n_words", "n_removed", "text"])


def remove_repeats(docs: DataFrame, *, k: int = 20, anchor: int = ANCHOR) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, text (the words that stay, joined by a space)."""
    settings(docs.sparkSession)
    texts = _texts(docs)
    every = repeated_spans(docs, k=k, anchor=anchor).groupBy("doc", "seq").agg(F.collect_set(F.struct("start", "words")).alias("spans"))
    every = materialize(every, "spans")
    maybe, plain = split_rows(texts, F.xxhash64("doc"), materialize(every.select(F.xxhash64("doc").alias("h")), "span-keys"))
    schema = "doc_id long, n_words long, n_removed long, text string"
    busy = maybe.select("doc", "text", "doc_id").mapInArrow(_tagged_rows, "doc long, seq int, text string, doc_id long")
    busy = busy.join(every, ["doc", "seq"], "left").select("doc_id", "text", "spans").mapInArrow(_cut, schema)
    return plain.select("doc_id", "text").mapInArrow(_cut, schema).unionByName(busy)


def _tagged_rows(batches):
    for b in batches:
        at = 0
        for part in _tagged(iter([b])):
            yield pa.RecordBatch.from_arrays([*part.columns, b.column(2).slice(at, part.num_rows)], ["doc", "seq", "text", "doc_id"])
            at += part.num_rows
