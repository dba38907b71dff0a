"""Benchmark decontamination: a BM25 index of test items, queried by every training passage.

Rule. An item is question and answer: the answer follows an answer mark or the last question mark, or
else is the last sentence; without either, the whole text is both. A document is contaminated when it holds at least
``overlap`` of the distinct five-word shingles of the question, and of the answer, anywhere in its text. A
question or answer of under five words is one shingle; an item of under five words counts only as a whole.

Index. Items are indexed with BM25 impacts, each divided by the item's score against itself, so that a score of 1 is
the item's own text. Document frequencies are counted in Spark over the whole benchmark. Items are ordered by vocabulary
and grouped in blocks; each term keeps its largest impact per block. An index holds at most ``INDEX_WORDS`` words (or one
longer item); a larger benchmark is taken in several such shards, one pass over the documents for each, so what is broadcast
is bounded whatever the benchmark's size.

Retrieval (block-max WAND, for many passages in lock-step). As the rule looks at the whole text, a passage is a whole text:
cutting it could only lose. Each item has a threshold of its own, which follows from the rule: ``m`` missing shingles lack at
most ``m`` words (``2 m`` where shingles repeat), so a contaminated document scores at least 1 less the ``m`` largest
impacts of the question and of the answer; retrieval loses nothing that verification keeps. Frequent terms whose impacts
together stay below half the threshold of every item are left aside; the lists of the other terms are merged, and a block
is looked into only if its maxima plus what the frequent terms can add reach the least threshold in it. In such
blocks each item's score is computed in full, and all items at or above their threshold are retrieved: there is no cut
at k. What is retrieved is verified by the rule.

Words are runs of letters, the marks on them and digits of any script, in lower case: neither quotes of any kind nor capitals tell two texts apart. One row per input row. Null or empty texts and items match
nothing. Ids may be of any type; items with equal ids (null is one, too) are reported once, with the best of their
overlaps. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .arrays import Words, chunks, text_buffers, windows
from .common import materialize, settings


INDEX_WORDS = 2_000_000
BLOCK = 8
SHINGLE = 5
_CLOSE = 1e-9
K1, B = 1.2, 0.75

#: What ends a word, in texts that aren't ASCII.
_OTHER = r"[^\pL\pM\pN]+"
_PLAIN = np.full(256, 0x20, np.uint8)
for _lo, _hi in ((48, 58), (97, 123), (128, 256)):
    _PLAIN[_lo:_hi] = np.arange(_lo, _hi)
_PLAIN[65:91] = np.arange(97, 123)
_ANSWER = re.compile(r"(?:^|\n)\s*(?:answer|a|antwort|réponse|respuesta)\s*[:.)]\s*|\?\s+", re.IGNORECASE)
_SENTENCE = re.compile(r"[.!?]\s+(?=\S)")


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    w = Words(_PLAIN[data], offsets)
    return w.hashes(), w.first


def plain_texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of texts in which only words have bytes above ASCII, and these in lower case."""
    data, offsets = text_buffers(column)
    if not len(data) or data.max() < 128:
        return data, offsets
    return text_buffers(pc.replace_substring_regex(pc.utf8_lower(column), _OTHER, " "))


def _hashes(text: str) -> np.ndarray:
    return word_hashes(*plain_texts(pa.array([text])))[0]


def question_and_answer(text: str) -> tuple[str, str]:
    marks = list(_ANSWER.finditer(text)) or list(_SENTENCE.finditer(text))
    if marks and text[: marks[-1].start()].strip() and text[marks[-1].end() :].strip():
        return text[: marks[-1].end()], text[marks[-1].end() :]
    return text, text


def shingles(h: np.ndarray) -> np.ndarray:
    """All shingles, in order."""
    return windows(h, min(SHINGLE, max(1, len(h))))


class Item:
    """One row of the benchmark: its words (the first ``cut`` are the question's; -1: all are both) and their document frequencies."""

    def __init__(self, item, words: np.ndarray, cut: int, terms: np.ndarray, df: np.ndarray):
        self.item, self.n = item, len(words)
        order = np.argsort(terms)
        self.terms, self.df = terms[order], df[order]
        self.tf = np.bincount(np.searchsorted(self.terms, words), minlength=len(terms))
        whole = cut <= 0 or cut >= len(words) or len(words) < SHINGLE
        #: words of the question and the answer, shingles of each with their size
        self.roles = [words] if whole else [words[:cut], words[cut:]]
        self.wanted = [(min(SHINGLE, len(r)), np.unique(shingles(r))) for r in self.roles]

    def impacts(self, n_items: int, mean: float) -> np.ndarray:
        idf = np.log1p((n_items - self.df + 0.5) / (self.df + 0.5))
        v = idf * self.tf * (K1 + 1) / (self.tf + K1 * (1 - B + B * self.n / mean))
        return v / v.sum()

    def threshold(self, impacts: np.ndarray, overlap: float) -> float:
        """The least score of a text that holds enough of both."""
        lost = 0.0
        for words, (_, wanted) in zip(self.roles, self.wanted, strict=True):
            n = len(wanted)
            missing = n - int(np.ceil(overlap * n - _CLOSE))
            if n < len(shingles(words)):
                missing *= 2
            own = np.sort(impacts[np.searchsorted(self.terms, np.unique(words))])
            lost += float(own[len(own) - min(missing, len(own)) :].sum())
        return max(1.0 - lost, 1e-6)


class Index:
    """Impacts of one shard."""

    def __init__(self, items: list[Item], n_items: int, mean: float, overlap: float):
        # items that share rare terms stand together
        self.items = sorted(items, key=lambda x: tuple(sorted(zip(x.df.tolist(), x.terms.tolist(), strict=True))[:4]))
        self.vocabulary = np.unique(np.concatenate([x.terms for x in self.items]))
        freq = np.zeros(len(self.vocabulary))
        self.ids, self.impacts, least = [], [], []
        for x in self.items:
            i, v = np.searchsorted(self.vocabulary, x.terms), x.impacts(n_items, mean)
            freq[i] = x.df
            self.ids.append(i)
            self.impacts.append(v)
            least.append(x.threshold(v, overlap))
        self.least = np.array(least)
        self.n_blocks = -(-len(self.items) // BLOCK)
        self.block_least = np.array([self.least[b * BLOCK : (b + 1) * BLOCK].min() for b in range(self.n_blocks)])
        self._split(freq)
        bits = 1 << 20
        self.maybe = np.zeros(bits, bool)
        self.maybe[(self.vocabulary & np.uint64(bits - 1)).astype(np.int64)] = True

    def _split(self, freq: np.ndarray) -> None:
        """Put the most frequent terms aside while no item gets more than half its threshold from them."""
        aside, rest = np.zeros(len(self.vocabulary), bool), np.zeros(len(self.items))
        holders: dict[int, list[tuple[int, float]]] = {}
        for d, (i, v) in enumerate(zip(self.ids, self.impacts, strict=True)):
            for t, x in zip(i.tolist(), v.tolist(), strict=True):
                holders.setdefault(t, []).append((d, x))
        for t in np.argsort(-freq, kind="stable").tolist():
            if freq[t] < 2 or any(rest[d] + x > self.least[d] / 2 for d, x in holders[t]):
                continue
            aside[t] = True
            for d, x in holders[t]:
                rest[d] += x
        self.aside = aside
        self.rest = np.array([rest[b * BLOCK : (b + 1) * BLOCK].max() for b in range(self.n_blocks)])
        # lists of the other terms: (block, largest impact in it)
        rows: list[tuple[int, int, float]] = []
        for t, held in holders.items():
            if not aside[t]:
                top: dict[int, float] = {}
                for d, x in held:
                    top[d // BLOCK] = max(top.get(d // BLOCK, 0.0), x)
                rows += [(t, b, x) for b, x in top.items()]
        rows.sort()
        self.lists = np.searchsorted([r[0] for r in rows], np.arange(len(self.vocabulary) + 1)) if rows else np.zeros(len(self.vocabulary) + 1, int)
        self.block = np.array([r[1] for r in rows], np.int64)
        self.top = np.array([r[2] for r in rows])

    def terms(self, h: np.ndarray) -> np.ndarray:
        """Vocabulary position of each word, -1 if it has none."""
        out = np.full(len(h), -1)
        at = np.flatnonzero(self.maybe[(h & np.uint64(len(self.maybe) - 1)).astype(np.int64)])
        i = np.searchsorted(self.vocabulary, h[at])
        ok = i < len(self.vocabulary)
        ok[ok] = self.vocabulary[i[ok]] == h[at][ok]
        out[at[ok]] = i[ok]
        return out

    def candidates(self, term: np.ndarray, passage: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (passage, block) that may reach the threshold. One entry per word and passage."""
        use = term >= 0
        use[use] = ~self.aside[term[use]]
        key = np.unique(passage[use] * len(self.vocabulary) + term[use])
        p, t = np.divmod(key, max(1, len(self.vocabulary)))
        size = self.lists[t + 1] - self.lists[t]
        at = np.repeat(self.lists[t] - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
        pair, inverse = np.unique(np.repeat(p, size) * self.n_blocks + self.block[at], return_inverse=True)
        bound = np.bincount(inverse, self.top[at], len(pair))
        p, b = np.divmod(pair, max(1, self.n_blocks))
        good = bound + self.rest[b] >= self.block_least[b] - _CLOSE
        return p[good], b[good]

    def retrieve(self, block: int, present: np.ndarray) -> list[int]:
        """Items of a block whose full score reaches their threshold; ``present``: a mask over the vocabulary."""
        lo = block * BLOCK
        return [d for d in range(lo, min(lo + BLOCK, len(self.items))) if self.impacts[d][present[self.ids[d]]].sum() >= self.least[d] - _CLOSE]


def _held(part: np.ndarray, found: np.ndarray) -> float:
    at = np.minimum(np.searchsorted(found, part), len(found) - 1)
    return float((found[at] == part).mean()) if len(found) else 0.0


def matches(index: Index, h: np.ndarray, first: np.ndarray, overlap: float) -> dict[int, dict]:
    """Text -> {item: overlap} for the texts of a chunk."""
    out: dict[int, dict] = {}
    term = index.terms(h)
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    text, block = index.candidates(term, owner)
    present, last, found = np.zeros(len(index.vocabulary), bool), -1, {}
    for i, b in zip(text.tolist(), block.tolist(), strict=True):
        lo, hi = int(first[i]), int(first[i + 1])
        if i != last:
            present[:] = False
            t = term[lo:hi]
            present[t[t >= 0]] = True
            last, found = i, {}
        for d in index.retrieve(b, present):
            x, held = index.items[d], []
            for size, wanted in x.wanted:
                if size not in found:
                    found[size] = np.unique(windows(h[lo:hi], size))
                held.append(_held(wanted, found[size]))
            if min(held) >= overlap - _CLOSE:
                best = out.setdefault(i, {})
                best[x.item] = max(best.get(x.item, 0.0), min(held))
    return out


def _parsed(batches):
    """Word hashes of items, and how many are the question's (-1: no answer was found)."""
    for b in batches:
        words, cuts = [], []
        for text in b.column(1).to_pylist():
            first, second = question_and_answer(text)
            q = _hashes(first)
            words.append((q if first == text else np.r_[q, _hashes(second)]).view(np.int64))
            cuts.append(-1 if first == text else len(q))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(words, pa.list_(pa.int64())), pa.array(cuts, pa.int32())], ["item_id", "words", "cut"])


def build(items: DataFrame, overlap: float) -> Iterator[Index]:
    """Indexes of shards of bounded size; statistics are those of the whole benchmark, counted in Spark."""
    kind = items.schema["item_id"].dataType.simpleString()
    parsed = items.where("text is not null").select("item_id", "text").mapInArrow(_parsed, f"item_id {kind}, words array<long>, cut int")
    parsed = materialize(parsed.where(F.size("words") > 0).withColumn("num", F.monotonically_increasing_id()), "items")
    n_items, mean = parsed.agg(F.count("*"), F.avg(F.size("words"))).first()
    terms = parsed.select("num", F.explode(F.array_distinct("words")).alias("term"))
    counts = materialize(terms.groupBy("term").agg(F.count("*").alias("df")), "term-counts")
    held = terms.join(counts, "term").groupBy("num").agg(F.collect_list(F.struct("term", "df")).alias("held"))  # no longer than the item
    batch, size = [], 0
    for r in materialize(parsed.join(held, "num").select("item_id", "words", "cut", "held.term", "held.df"), "indexed-items").toLocalIterator():
        words, terms_ = (np.array(r[c], np.int64).view(np.uint64) for c in ("words", "term"))
        if batch and size + len(words) > INDEX_WORDS:
            yield Index(batch, n_items, mean, overlap)
            batch, size = [], 0
        batch.append(Item(r["item_id"], words, r["cut"], terms_, np.array(r["df"], np.float64)))
        size += len(words)
    if batch:
        yield Index(batch, n_items, mean, overlap)


def _in_order(ids) -> list:
    return sorted(ids, key=lambda x: (x is None, x if x is not None else 0))


def find_contamination(docs: DataFrame, items: DataFrame, *, overlap: float = 0.8) -> DataFrame:
    """One row per input row: doc_id, n_items, items (sorted ids, null last), overlap (of the best), contaminated."""
    spark = docs.sparkSession
    settings(spark)
    kind, item = (d.schema[c].dataType.simpleString() for d, c in ((docs, "doc_id"), (items, "item_id")))
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    none, parts = F.array().cast(f"array<{item}>"), []
    for index in build(items, overlap):
        parts.append(texts.mapInArrow(_search(spark.sparkContext.broadcast(index), overlap, to_arrow_type(items.schema["item_id"].dataType)), f"doc_id {kind}, text_key long, items array<{item}>, overlap double"))
    found = parts[0] if parts else texts.select("doc_id", none.alias("items"), F.lit(0.0).alias("overlap"))
    if len(parts) > 1:  # equal rows get equal results, so one of each is enough
        for part in parts[1:]:
            found = found.unionByName(part)
        merged = found.where(F.size("items") > 0).groupBy(F.col("doc_id").alias("id"), F.col("text_key").alias("key"))
        merged = merged.agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"), F.max("overlap").alias("overlap"))
        found = texts.join(merged, F.col("doc_id").eqNullSafe(F.col("id")) & F.col("text_key").eqNullSafe(F.col("key")), "left")
        found = found.select("doc_id", F.coalesce("items", none).alias("items"), F.coalesce("overlap", F.lit(0.0)).alias("overlap"))
    n = F.size("items").cast("long")
    return found.select("doc_id", n.alias("n_items"), "items", "overlap", (n > 0).alias("contaminated"))


def _search(shared, overlap: float, kind: pa.DataType):
    def run(batches):
        index = shared.value
        for b in batches:
            data, offsets = plain_texts(b.column(2))
            for lo, hi in chunks(offsets):
                h, first = word_hashes(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                got = matches(index, h, first, overlap)
                lists = pa.array([_in_order(got.get(i, ())) for i in range(hi - lo)], pa.list_(kind))
                best = pa.array([max(got[i].values()) if i in got else 0.0 for i in range(hi - lo)], pa.float64())
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), b.column(1).slice(lo, hi - lo), lists, best], ["doc_id", "text_key", "items", "overlap"])

    return run


def drop_contaminated(docs: DataFrame, items: DataFrame, *, overlap: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns: one filter pass for each shard."""
    spark = docs.sparkSession
    settings(spark)
    at = docs.columns.index("text")

    def clean(shared):
        def run(batches):
            for b in batches:
                data, offsets = plain_texts(b.column(at))
                good = np.ones(len(offsets) - 1, bool)
                for lo, hi in chunks(offsets):
                    h, first = word_hashes(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                    good[[lo + i for i in matches(shared.value, h, first, overlap)]] = False
                yield b.take(pa.array(np.flatnonzero(good)))

        return run

    for index in build(items, overlap):
        docs = docs.mapInArrow(clean(spark.sparkContext.broadcast(index)), docs.schema)
    return docs
