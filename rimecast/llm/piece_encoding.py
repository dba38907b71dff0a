"""SentencePiece encoding and decoding by a table of distinct chunks.

Where no piece crosses a white-space marker, pieces can't span two marked words, so a text's ids are those of its chunks (a run of markers and
what follows it; where no longer piece has a line feed, also a line feed and what follows it) put together by position. Chunks are
counted, and each distinct one that occurs again is segmented once, in Spark, into a written table. The frequent ones,
as many as ``TABLE_BYTES`` hold, reach the workers as a broadcast Arrow table. A chunk that a filter of all repeated ones rules out occurs
once in the corpus and is segmented where it stands. What is left, chunks that are neither frequent nor single,
leaves holes: each is joined to the table by its chunk and comes back to its text by row and position. Between the two, a text
travels as the compressed ids that are known. If no chunk but frequent ones repeats, nothing is exchanged at all. Tasks cut many
texts at once, look up their distinct chunks, and spread their ids over the positions as arrays.

Chunks of over ``LONGEST`` characters are segmented where they stand, so that rows of the table stay small. Vocabulary files
for which the above doesn't hold (a piece with a marker behind another character, a normaliser that is not the identity, removal
of extra blanks, symbols that are defined by the user) have their texts encoded whole by the library; results are the library's in every case.

A null text is empty and has no ids; null ids decode to the empty text, an id outside of the vocabulary is an error. Each input row gives one
output row, repeated rows and null ids of documents included; an empty table gives no rows; other columns are not read, whatever their names.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import key_filter, materialize, settings

MARK = "▁"
LONGEST = 64
TABLE_BYTES = 64 << 20
#: Texts are cut in slices of so many bytes; a task adds counts up to about so many rows before it hands them on.
SLICE, COUNTED_ROWS = 1 << 22, 1 << 19
_HOLE = -1
_OPEN = np.array([_HOLE], "<i4").tobytes()
_SEED = 42


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value, shift, at = value | (byte & 127) << shift, shift + 7, at + 1
        if byte < 128:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of one serialized message."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        wire = tag & 7
        if wire == 0:
            value, at = _varint(data, at)
        else:
            size, at = (8, at) if wire == 1 else (4, at) if wire == 5 else _varint(data, at)
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


#: A vocabulary file's field numbers and kinds of pieces.
_PIECE, _NORMALIZER, _TEXT, _KIND, _USER_DEFINED = 1, 3, 1, 3, 4
_CHARSMAP, _PREFIX, _REMOVE, _ESCAPE, _SUFFIX_FIELD, _RULES = 2, 3, 4, 5, 24, 6


class Pieces:
    """A vocabulary file on a worker: how it cuts texts, the ids of single chunks, the bytes of ids.

    A chunk is written without the marker it begins with, or with its line feed: "word", "\\nword", " word" for two markers
    and a word, "" for a marker alone.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        spec, pieces, plain = {}, [], True
        for field, value in _fields(self.model.serialized_model_proto()):
            if field == _NORMALIZER:
                spec = dict(_fields(value))
            elif field == _PIECE:
                piece = dict(_fields(value))
                pieces.append(piece.get(_TEXT, b"").decode())
                plain = plain and piece.get(_KIND, 1) != _USER_DEFINED
        plain = plain and not spec.get(_CHARSMAP) and not spec.get(_RULES) and not spec.get(_REMOVE, 1) and spec.get(_ESCAPE, 1) == 1 and spec.get(_PREFIX, 1) == 1
        plain = plain and not any(MARK in p.lstrip(MARK) or ("\n" in p and len(p) > 1) for p in pieces)
        # a line feed of its own behind the marker in front: what follows it is read as in the middle of a text
        lone = self.model.encode("\n")
        self.cuts = plain and len(lone) == 2 and self.model.id_to_piece(lone[0]) == MARK
        self.mark = lone[:1]
        self._find = re.compile(f"{MARK}+[^{MARK}\n]*|\n[^{MARK}\n]*").findall
        self._pieces = pieces

    def chunks(self, text: str) -> list[str]:
        """The chunks of one text."""
        return [c[1:] if c[0] == MARK else c for c in self._find(MARK + text.replace(" ", MARK))] if text else []

    def cut(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The chunks of many texts, one after the other, and where each text's begin and end."""
        texts = texts.cast(pa.large_string())
        # between single blanks, and at line feeds, a text is simply split
        odd = pc.or_(pc.match_substring_regex(texts, f"  |{MARK}|^ "), pc.equal(pc.binary_length(texts), 0))
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        if pc.any(odd).as_py():
            rows = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
            other = pa.array([self.chunks(t) for t in texts.take(pa.array(rows)).to_pylist()], split.type)
            at = np.arange(len(texts))
            at[rows] = len(texts) + np.arange(len(rows))
            split = pa.concat_arrays([split, other]).take(pa.array(at))
        return split.flatten(), np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))])

    def encode(self, chunks: list[str]) -> list[list[int]]:
        """The ids of each chunk as they are within a text."""
        ids = self.model.encode(chunks, num_threads=1) if chunks else []
        return [self.mark if not c else i[1:] if c[0] == "\n" else i for c, i in zip(chunks, ids, strict=True)]

    def surfaces(self) -> tuple[pa.Array, np.ndarray]:
        """Bytes of all pieces, then the same without the marker they begin with; and which ids only the library decodes."""
        whole = [bytes([int(p[1:-1], 16)]) if self.model.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(self._pieces)]
        strange = [self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_unused(i) for i in range(len(whole))]
        return pa.array(whole + [x[1:] if x[:1] == b" " else x for x in whole], pa.large_binary()), np.array(strange)

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        """Texts of ids that ``encode`` gave: the bytes of the pieces, without the marker in front."""
        if not hasattr(self, "_surfaces"):
            self._surfaces = self.surfaces()
        surfaces, strange = self._surfaces
        if strange[ids].any():
            return pa.array([self.model.decode(ids[a:b].tolist()) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)], pa.large_string())
        at = ids.astype(np.int32)
        at[ends[:-1][ends[1:] > ends[:-1]]] += len(self._pieces)
        data, offsets = _joined(surfaces, at)
        return pa.LargeStringArray.from_buffers(len(ends) - 1, pa.py_buffer(offsets[ends]), data)


def _joined(parts: pa.Array, at: np.ndarray) -> tuple[pa.Buffer, np.ndarray]:
    """The bytes of the chosen parts, one after the other, and where each one's begin and end."""
    if not len(at):
        return pa.py_buffer(b""), np.zeros(1, np.int64)
    _, offsets, data = parts.take(pa.array(at)).buffers()
    return data, np.frombuffer(offsets, np.int64)[: len(at) + 1]


def _spread(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin, begin + 1, ... of each range, one range after the other."""
    total = np.cumsum(size)
    return np.arange(total[-1] if len(total) else 0) + np.repeat(begin - (total - size), size)


_WORKER: dict[str, object] = {}


def _pieces(path: str) -> Pieces:
    if path not in _WORKER:
        _WORKER[path] = Pieces(path)
    return _WORKER[path]


def _key(chunk: str) -> int:
    return xxhash.xxh64_intdigest(chunk.encode(), _SEED)


def _slices(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``SLICE`` bytes of text, or one longer text."""
    ends, at = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)), 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE, side="right")))
        yield batch.slice(at, to - at)
        at = to


def chunk_counts(texts: DataFrame, path: str) -> DataFrame:
    """Distinct chunks of up to ``LONGEST`` characters and how often they occur: (chunk, n)."""

    def added(tables):
        t = pa.concat_tables(tables).group_by("chunk").aggregate([("n", "sum")])
        return pa.table({"chunk": t["chunk"], "n": t["n_sum"]})

    def counted(batches):
        pieces, seen, fresh_rows = _pieces(path), [], 0
        for batch in batches:
            for part in _slices(batch, 0):
                chunks = pieces.cut(part.column(0))[0].dictionary_encode()
                words = chunks.dictionary.cast(pa.string())
                n = np.bincount(chunks.indices.to_numpy(), minlength=len(words)).astype(np.int64)
                seen.append(pa.table({"chunk": words, "n": n}).filter(pc.less_equal(pc.utf8_length(words), LONGEST)))
                fresh_rows += seen[-1].num_rows
                if fresh_rows >= COUNTED_ROWS:
                    seen, fresh_rows = [added(seen)], 0
                    if seen[0].num_rows >= COUNTED_ROWS:
                        yield from seen.pop().to_batches(max_chunksize=1 << 16)
        if seen:
            yield from added(seen).to_batches(max_chunksize=1 << 16)
        pa.default_memory_pool().release_unused()

    return texts.select("text").mapInArrow(counted, "chunk string, n long").groupBy("chunk").agg(F.sum("n").alias("n"))


def segment(chunks: DataFrame, path: str) -> DataFrame:
    """(chunk, n, ids, key): each distinct chunk's ids as 32-bit numbers, and its 64-bit key."""

    def segmented(batches):
        pieces = _pieces(path)
        for batch in batches:
            words = batch.column(0).to_pylist()
            ids = [np.array(x, "<i4").tobytes() for x in pieces.encode(words)]
            keys = np.array([_key(w) for w in words], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ids, pa.binary()), pa.array(keys)], ["chunk", "n", "ids", "key"])

    return chunks.select("chunk", "n").mapInArrow(segmented, "chunk string, n long, ids binary, key long")


def _frequent(table: DataFrame, most: int) -> tuple[int, int, int]:
    """The least count of a frequent chunk, a power of two, with how many chunks have it, and how many there are."""
    power = F.floor(F.log2("n")).cast("int").alias("p")
    size = F.sum(F.octet_length("chunk") + F.octet_length("ids"))
    sizes = sorted(table.groupBy(power).agg(F.count("*").alias("c"), size.alias("b")).collect(), reverse=True)  # 64 rows at most
    least, taken, held = 63, 0, 0
    for p, c, b in sizes:
        if held + b > most:
            break
        least, taken, held = p, taken + c, held + b
    return (1 << least) - (least == 63), taken, sum(c for _, c, _ in sizes)


class _Known:
    """Frequent chunks' ids, single chunks segmented where they stand, and holes for the others."""

    def __init__(self, path: str, shared):
        packed, self.filter, self.holes = shared.value
        table = pa.ipc.open_stream(packed).read_all().combine_chunks()
        self.pieces, self.keys = _pieces(path), table["key"].to_numpy()
        self.chunks, self.ids = (table[c].chunk(0) if table.num_rows else pa.array([], t) for c, t in (("chunk", pa.large_string()), ("ids", pa.large_binary())))

    def look_up(self, words: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Ids, as 32-bit numbers, at which place among them each distinct chunk has its own, and which chunks stay open."""
        keys = np.array([_key(w) for w in words.to_pylist()], np.uint64)
        at = np.searchsorted(self.keys, keys.view(np.int64))
        at[at == len(self.keys)] = 0
        hit = np.flatnonzero(self.keys[at] == keys.view(np.int64)) if len(self.keys) else np.empty(0, np.int64)
        # equal keys are no proof; what another chunk's key hides is segmented below like any other
        same = pc.equal(self.chunks.take(pa.array(at[hit])), words.take(pa.array(hit))).to_numpy(zero_copy_only=False).astype(bool)
        missing = np.ones(len(words), bool)
        missing[hit[same]] = False
        missed = np.flatnonzero(missing)
        is_open = np.zeros(len(words), bool)
        if self.holes and len(missed):
            may = pc.less_equal(pc.utf8_length(words.take(pa.array(missed))), LONGEST).to_numpy(zero_copy_only=False).astype(bool)
            if self.filter is not None:
                may &= self.filter(keys[missed])
            is_open[missed[may]] = True
            missed = missed[~may]
        found = self.pieces.encode(words.take(pa.array(missed)).to_pylist())
        # behind the table's ids: those found here, then one hole
        at[missed], at[is_open] = len(self.ids) + np.arange(len(missed)), len(self.ids) + len(missed)
        used = np.unique(at)
        own, extra = used[used < len(self.ids)], pa.array([np.array(x, "<i4").tobytes() for x in found] + [_OPEN], pa.large_binary())
        ids = pa.concat_arrays([self.ids.take(pa.array(own)), extra.take(pa.array(used[len(own) :] - len(self.ids)))])
        return ids, np.searchsorted(used, at), is_open

    def fill(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a batch of texts, with ``_HOLE`` for what stays open, and where each text's begin and end."""
        chunks, ends = self.pieces.cut(texts)
        chunks = chunks.dictionary_encode()
        ids, at, _ = self.look_up(chunks.dictionary)
        data, offsets = _joined(ids, at[chunks.indices.to_numpy()])
        return np.frombuffer(data, "<i4", int(offsets[-1]) >> 2), offsets[ends] >> 2

    def open(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """For each hole the row of its text, its number among the text's holes, and the chunk."""
        chunks, ends = self.pieces.cut(texts)
        chunks = chunks.dictionary_encode()
        is_open = self.look_up(chunks.dictionary)[2]
        at = np.flatnonzero(is_open[chunks.indices.to_numpy()])
        row = np.searchsorted(ends, at, side="right") - 1
        number = np.arange(len(at)) - np.searchsorted(row, row)
        return row, number, chunks.dictionary.take(chunks.indices.take(pa.array(at)))


def _packed(table: pa.Table) -> bytes:
    """A table compressed: what the workers keep of it beside the one that they use."""
    table = table.cast(pa.schema([("chunk", pa.large_string()), ("ids", pa.large_binary()), ("key", pa.int64())]))
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_table(table)
    return out.getvalue().to_pybytes()


def _known(path: str, shared, token: str) -> _Known:
    if ("known", token) not in _WORKER:
        for old in [k for k in _WORKER if isinstance(k, tuple)]:
            del _WORKER[old]
        _WORKER["known", token] = _Known(path, shared)
    return _WORKER["known", token]


def _result(pieces: Pieces, doc: pa.Array, ids: np.ndarray, ends: np.ndarray, with_text: bool) -> pa.RecordBatch:
    columns, names = [doc, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.astype(np.int32)))], ["doc_id", "ids"]
    if with_text:
        columns, names = [*columns, pieces.decode(ids, ends).cast(pa.string())], [*names, "decoded"]
    return pa.RecordBatch.from_arrays(columns, names)


def encode_pieces(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """(doc_id, ids) for each row, as the library encodes whole texts without begin or end ids; with ``with_text`` also
    ``decoded``, what the library decodes the ids to."""
    spark = docs.sparkSession
    settings(spark)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>" + ", decoded string" * with_text
    if not Pieces(path).cuts:
        return rows.mapInArrow(lambda batches: _whole(batches, path, with_text), schema)
    table = materialize(segment(chunk_counts(rows, path).where("n > 1"), path), "chunk-table")
    least, taken, total = _frequent(table, table_bytes)
    often = _packed(table.where(F.col("n") >= least).select("chunk", "ids", "key").orderBy("key").toArrow())  # bounded in bytes
    rare = table.where(F.col("n") < least).select("chunk", "ids", "key")
    only = key_filter(rare.select("key"), "key", total - taken) if total > taken else None
    shared, token = spark.sparkContext.broadcast((often, only, total > taken)), uuid.uuid4().hex
    del often
    if total == taken:
        return rows.mapInArrow(lambda batches: _complete(batches, path, shared, token, with_text), schema)
    # two hashes of id and text name a row; equal rows share their holes
    rows = rows.select(F.xxhash64("doc_id", "text").alias("k1"), F.xxhash64("text", F.lit(1), "doc_id").alias("k2"), "doc_id", "text")
    holes = rows.select("k1", "k2", "text").mapInArrow(lambda batches: _open(batches, path, shared, token), "k1 long, k2 long, at int, chunk string")
    # what the filter let through although it is single comes back as it went
    back = F.struct("at", "ids", F.when(F.col("ids").isNull(), F.col("chunk")).alias("chunk"))
    found = holes.join(rare.select("chunk", "ids"), "chunk", "left").groupBy("k1", "k2").agg(F.sort_array(F.collect_set(back)).alias("found"))
    partly = rows.mapInArrow(lambda batches: _partly(batches, path, shared, token), f"k1 long, k2 long, doc_id {rows.schema['doc_id'].dataType.simpleString()}, n int, known binary")
    both = partly.join(found.hint("merge"), ["k1", "k2"], "left").select("doc_id", "n", "known", "found")
    return both.mapInArrow(lambda batches: _filled(batches, path, with_text), schema)


def _whole(batches, path, with_text):
    model = _pieces(path).model
    for batch in batches:
        ids = [model.encode(t, num_threads=1) for t in batch.column(1).to_pylist()]
        text = [pa.array([model.decode(i) if i else "" for i in ids], pa.string())] * with_text
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32())), *text], ["doc_id", "ids", "decoded"][: 2 + with_text])


def _complete(batches, path, shared, token, with_text):
    known = _known(path, shared, token)
    for batch in batches:
        for part in _slices(batch, 1):
            yield _result(known.pieces, part.column(0), *known.fill(part.column(1)), with_text)
    pa.default_memory_pool().release_unused()


def _open(batches, path, shared, token):
    known = _known(path, shared, token)
    for batch in batches:
        for part in _slices(batch, 2):
            row, number, chunks = known.open(part.column(2))
            row = pa.array(row)
            yield pa.RecordBatch.from_arrays([part.column(0).take(row), part.column(1).take(row), pa.array(number, pa.int32()), chunks.cast(pa.string())], ["k1", "k2", "at", "chunk"])
    pa.default_memory_pool().release_unused()


def _partly(batches, path, shared, token):
    """The ids that are known, compressed, with ``_HOLE`` where one or more are not."""
    known = _known(path, shared, token)
    for batch in batches:
        for part in _slices(batch, 3):
            ids, ends = known.fill(part.column(3))
            # ids below 32,767 take two bytes; -1 stays -1
            small = ids.astype("<i2") if len(known.pieces.model) < 1 << 15 else ids.astype("<i4")
            data = [pa.compress(small[a:b].tobytes(), codec="zstd", asbytes=True) if a < b else b"" for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(np.diff(ends), pa.int32()), pa.array(data, pa.binary())], ["k1", "k2", "doc_id", "n", "known"])
    pa.default_memory_pool().release_unused()


def _filled(batches, path, with_text):
    pieces = _pieces(path)
    kind = np.dtype("<i2" if len(pieces.model) < 1 << 15 else "<i4")
    for batch in batches:
        texts = []
        for n, known, found in zip(*[c.to_pylist() for c in batch.columns[1:]], strict=True):
            ids = np.frombuffer(pa.decompress(known, n * kind.itemsize, codec="zstd", asbytes=True), kind).astype("<i4") if n else np.empty(0, "<i4")
            if found:
                given = [np.array(pieces.encode([x["chunk"]])[0], "<i4") if x["ids"] is None else np.frombuffer(x["ids"], "<i4") for x in found]
                size = np.ones(len(ids), np.int64)
                at = np.flatnonzero(ids == _HOLE)
                size[at] = [len(g) for g in given]
                ids = np.repeat(ids, size)
                ids[_spread((np.cumsum(size) - size)[at], size[at])] = np.concatenate(given)
            texts.append(ids)
        ends = np.concatenate([[0], np.cumsum([len(x) for x in texts], dtype=np.int64)])
        yield _result(pieces, batch.column(0), np.concatenate([*texts, np.empty(0, "<i4")]), ends, with_text)


def decode_pieces(encoded: DataFrame, path: str, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) for each row of ids, as the library decodes them."""
    settings(encoded.sparkSession)
    rows = encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))

    def decoded(batches):
        model = _pieces(path).model
        for batch in batches:
            texts = [model.decode(ids) if ids else "" for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return rows.mapInArrow(decoded, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text string")
