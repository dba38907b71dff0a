"""Token counts by a map-side two-tier lookup.

Tier one: a broadcast table of the lengths (in tokens) of frequent pre-tokens, at most
``TABLE_ENTRIES`` of them, picked from ``SAMPLE_ROWS`` documents of ordinary length. Tier two: each
Python worker encodes what the table misses and keeps the lengths in a cache of at most
``CACHE_ENTRIES``, which outlives a task. The sample only decides what is fast: every
pre-token of every whole text is counted, and no pre-token is ever shuffled.

How a text is cut is the vocabulary file's own business: special strings, normaliser and pre-tokenizer are the
file's, applied by its library. Where they are the ones written down in ``KNOWN``, texts of common characters are cut
by the same expression directly, which is faster. Files whose special strings have options of their own, that have no
pre-tokenizer, or that are sentence-piece models, are counted by encoding texts whole (no tiers apply).

Null texts count as empty (0 bytes, 0 tokens). Each input row gives one output row, so
repeated rows and null ids are carried through; other columns of the input are not read.
"""

from __future__ import annotations

import json
import uuid
from collections import Counter
from pathlib import Path

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settings

TABLE_ENTRIES = 32768
SAMPLE_ROWS = 2000
SAMPLE_CHARS = 8192
CACHE_ENTRIES = 400_000
LONGEST_KEPT = 40

#: How one vocabulary's own configuration normalises and cuts a text (fixed values).
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
KNOWN = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": PRE_TOKEN}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}
_PRE = regex.compile(PRE_TOKEN)
#: Characters for which lower-casing one by one, normal form C and the classes above are the same in
#: every Unicode version: a text with any other character is cut by the library.
_OTHER = regex.compile(r"[^\t\n\r -~¡-įı-ǃǍ-ǰЀ-џ‐-‧‰-⁞一-龥]")


class _Lengths(dict):
    """Piece -> tokens. A miss is encoded, and kept unless long or the cache is full.

    A piece is a pre-token as the text has it, or, cut by the library, as the model takes it (behind a mark).
    """

    def __init__(self, path: str, table: dict[str, int]):
        super().__init__(table)
        self.table, self.special, self.direct, self.cuts = table, None, False, False
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode = lambda text: len(model.encode(text, num_threads=1))
            return
        from tokenizers import Tokenizer

        self.tokenizer = t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        self.encode = lambda text: len(t.encode(text, add_special_tokens=False).ids)
        config = json.loads(Path(path).read_text("utf-8"))
        added = t.get_added_tokens_decoder().values()
        self.cuts = t.pre_tokenizer is not None and not any(x.lstrip or x.rstrip or x.single_word or x.normalized for x in added)
        self.direct = self.cuts and all(config.get(k) == v for k, v in KNOWN.items())
        names = sorted((x.content for x in added), key=len, reverse=True)
        if names:
            self.special = regex.compile("|".join(map(regex.escape, names)))

    def __missing__(self, piece: str) -> int:
        n = len(self.tokenizer.model.tokenize(piece[1:])) if piece[0] == "\0" else self.encode(piece)
        if len(piece) <= LONGEST_KEPT:
            if len(self) - len(self.table) >= CACHE_ENTRIES:
                self.clear()
                self.update(self.table)
            self[piece] = n
        return n

    def pieces(self, text: str) -> list[str]:
        """Pre-tokens of a text without special strings."""
        if self.direct and not _OTHER.search(text):
            return _PRE.findall(text.lower())
        if self.tokenizer.normalizer is not None:
            text = self.tokenizer.normalizer.normalize_str(text)
        return ["\0" + p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)] if text else []

    def count(self, text: str) -> int:
        if not self.cuts:
            return self.encode(text)
        if self.special is not None and (found := self.special.findall(text)):
            return len(found) + sum(map(self.count, self.special.split(text)))
        return sum(map(self.__getitem__, self.pieces(text)))


_WORKER: dict[str, _Lengths] = {}


def _worker(path: str, table, token: str) -> _Lengths:
    if token not in _WORKER:
        _WORKER.clear()
        _WORKER[token] = _Lengths(path, table.value)
    return _WORKER[token]


def frequent_lengths(docs: DataFrame, path: str, *, text_col: str = "text") -> dict[str, int]:
    """Lengths of the most frequent pre-tokens of up to ``SAMPLE_ROWS`` texts of at most ``SAMPLE_CHARS``.

    The rows are taken partition after partition until there are enough, so a large table isn't scanned.
    """
    size = F.length(text_col)
    lengths, seen = _Lengths(path, {}), Counter()
    if not lengths.cuts:
        return {}
    for (text,) in docs.where((size > 0) & (size <= SAMPLE_CHARS)).select(text_col).limit(SAMPLE_ROWS).collect():
        seen.update(w for w in lengths.pieces(text) if len(w) <= LONGEST_KEPT)
    return {w: lengths[w] for w, _ in sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:TABLE_ENTRIES]}


def count_tokens(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048) -> DataFrame:
    """One row per input row: id, n_bytes, n_tokens, over_limit (n_tokens > limit)."""
    spark = docs.sparkSession
    settings(spark)
    table = spark.sparkContext.broadcast(frequent_lengths(docs, tokenizer_path, text_col=text_col))
    token = uuid.uuid4().hex

    def counted(batches):
        lengths = _worker(tokenizer_path, table, token)
        for b in batches:
            n = pa.array([lengths.count(t) if t else 0 for t in b.column(2).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), n], ["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    out = rows.mapInArrow(counted, f"doc_id {kind}, n_bytes long, n_tokens long")
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
