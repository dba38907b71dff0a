"""Language identification by hierarchical discrimination.

A text is its hashed byte n-grams (letters only, lower case), as square roots of shares. One
stage picks the language family, a second the language within it; both are one-versus-one
linear support vector machines, the winner having most votes, then the largest sum of margins.

Training uses a bounded sample: at most ``per_language`` labelled documents, picked by a hash of id and text, of every
language, and ``FAMILY_ROWS`` of them, spread evenly over its languages, for a family. Rows that repeat an id and a text count once,
also where the sample's rate is set. Every text is predicted whole. The score is the least logistic
margin against the rivals of the two stages, between 0 and 1; a winner of all its duels has 0.5
or more whatever the text, so the score alone can't tell an unknown language.

Whether a text has a known language at all is its likeness: the mean log-probability of its
n-grams in the learned language that fits best, less the mean over that language's own learning
rows. The least likeness of a known text is calibrated on learning rows cut to ``CUT`` characters,
as short texts vary most: all but a share of ``OUTSIDE`` of the cuts have it.

Null texts and texts without a letter get ``und`` with score 0, as does everything where no
language could be learned. With one learned language all texts with letters get it, score 1.
Rows with a null language or id are never learned from; repeated rows get equal results.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .arrays import chunks, text_buffers

from .common import settings
from .linear import grams, letters, svm

#: Default bounds of the sample that is learned from.
PER_LANGUAGE, FAMILY_ROWS = 400, 1600
LOG2 = 13
SIZES = (1, 2, 3)
SLOPE = 3.0
#: Added to every n-gram's probability, as a share of an even spread over all n-grams.
SMOOTH = 0.02
CUT = 24
OUTSIDE = 0.001
#: Families by language code (fixed values); a code that isn't listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af lb fy".split(),
    "romance": "fr es it pt ro ca gl oc".split(),
    "slavic": "ru uk be pl cs sk bg sr hr sl mk bs".split(),
    "turkic": "tr az kk uz ky tk".split(),
    "uralic": "fi et hu".split(),
    "indic": "hi bn ur mr gu pa ne".split(),
}
_FAMILY = {code: name for name, codes in FAMILIES.items() for code in codes}


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row per text: square roots of the shares of its n-grams."""
    clean, n = letters(data), len(offsets) - 1
    total = np.zeros((n, 1 << LOG2), np.float32)
    for k in SIZES:
        codes, at = grams(clean, offsets, k, LOG2)
        owner = np.repeat(np.arange(n), np.diff(at))
        total += np.bincount(owner * (1 << LOG2) + codes, minlength=n << LOG2).reshape(n, -1)
    return np.sqrt(total / np.maximum(1, total.sum(axis=1, keepdims=True)))


def _small(offsets: np.ndarray):
    """Chunks of at most 64 texts: a row of features is wide."""
    for lo, hi in chunks(offsets):
        for at in range(lo, hi, 64):
            yield at, min(hi, at + 64)


def has_letter(data: np.ndarray, offsets: np.ndarray, texts) -> np.ndarray:
    ascii_letter = np.zeros(256, bool)
    ascii_letter[65:91] = ascii_letter[97:123] = True
    total = np.zeros(len(data) + 1, np.int64)
    np.cumsum(ascii_letter[data], out=total[1:])
    sure = total[offsets[1:]] > total[offsets[:-1]]
    for i in np.flatnonzero(~sure & (np.diff(offsets) > 0)):
        sure[i] = any(c.isalpha() for c in texts[int(i)].as_py())
    return sure


class _Rows:
    """Rows of features as they came from the workers: codes of n-grams and their values."""

    def __init__(self, codes: list[bytes], values: list[bytes]):
        self.codes, self.values, self.shape = codes, values, (len(codes), 1 << LOG2)

    def __getitem__(self, which: np.ndarray) -> np.ndarray:
        x = np.zeros((len(which), 1 << LOG2), np.float32)
        for i, k in enumerate(which):
            x[i, np.frombuffer(self.codes[k], np.uint16)] = np.frombuffer(self.values[k], np.float16)
        return x


class Duel:
    """One-versus-one machines over a list of names."""

    def __init__(self, names: list[str], rows: np.ndarray | _Rows, y: np.ndarray):
        self.names, self.pairs = names, list(combinations(range(len(names)), 2))
        self.w = np.zeros((len(self.pairs), rows.shape[1] + 1), np.float32)
        for p, (a, b) in enumerate(self.pairs):
            use = np.flatnonzero((y == names[a]) | (y == names[b]))
            x = rows[use].astype(np.float64)
            seen = np.flatnonzero(x.any(axis=0))  # what neither has gets no weight
            self.w[p, np.r_[seen, -1]] = svm(x[:, seen], np.where(y[use] == names[a], 1.0, -1.0))

    def __call__(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Winner and its confidence."""
        n = len(x)
        if not self.pairs:
            return np.zeros(n, int), np.ones(n)
        m = x @ self.w[:, :-1].T + self.w[:, -1]
        votes, sums = np.zeros((n, len(self.names))), np.zeros((n, len(self.names)))
        least = np.full((n, len(self.names)), np.inf)
        for p, (a, b) in enumerate(self.pairs):
            for k, s in ((a, m[:, p]), (b, -m[:, p])):
                votes[:, k] += s > 0
                sums[:, k] += s
                least[:, k] = np.minimum(least[:, k], s)
        best = np.argmax(votes + sums / (1 + np.abs(sums).max()) / 2, axis=1)
        return best, 1 / (1 + np.exp(-SLOPE * least[np.arange(n), best]))


class Model:
    def __init__(self, rows: _Rows, lang: np.ndarray):
        family = np.array([_FAMILY.get(v, v) for v in lang], object)
        names = sorted(set(lang))
        self.families = sorted(set(family))
        # of a family's languages as many rows each as fit, in the sample's order
        place = np.zeros(len(lang), int)
        for v in names:
            place[lang == v] = np.arange((lang == v).sum())
        share = {f: max(1, FAMILY_ROWS // len(set(lang[family == f]))) for f in self.families}
        some = place < np.array([share[f] for f in family])
        self.first = Duel(self.families, rows, np.where(some, family, None))
        self.second = [Duel(sorted(set(lang[family == f])), rows, np.where(family == f, lang, None)) for f in self.families]
        self.log, self.own = np.zeros((len(names), 1 << LOG2), np.float32), np.zeros(len(names))
        for k, v in enumerate(names):
            shares = np.square(rows[np.flatnonzero(lang == v)])
            self.log[k] = np.log(shares.mean(axis=0) + SMOOTH / (1 << LOG2))
            self.own[k] = (shares @ self.log[k]).mean()
        self.least = -np.inf

    def likeness(self, x: np.ndarray) -> np.ndarray:
        return (np.square(x) @ self.log.T - self.own).max(axis=1)

    def calibrate(self, cuts: pa.Array) -> None:
        """Set ``least`` by short learning texts."""
        data, offsets = text_buffers(cuts)
        found = [self.likeness(features(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])) for lo, hi in _small(offsets)]
        if found:
            self.least = float(np.quantile(np.concatenate(found), OUTSIDE))

    def __call__(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        which, score = self.first(x)
        out = np.empty(len(x), object)
        for f, duel in enumerate(self.second):
            at = np.flatnonzero(which == f)
            if len(at):
                best, s = duel(x[at])
                out[at] = np.array(duel.names, object)[best]
                score[at] = np.minimum(score[at], s)
        return out, score


def _vectors(batches):
    for b in batches:
        data, offsets = text_buffers(b.column(1))
        for lo, hi in _small(offsets):
            x = features(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
            at = [np.flatnonzero(r).astype(np.uint16) for r in x]
            sparse = [pa.array([c.tobytes() for c in at], pa.binary()), pa.array([r[c].astype(np.float16).tobytes() for r, c in zip(x, at, strict=True)], pa.binary())]
            yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), *sparse, b.column(2).slice(lo, hi - lo)], ["lang", "codes", "values", "cut"])


def train(docs: DataFrame, learn: Column, per_language: int = PER_LANGUAGE) -> Model | None:
    """Fit on a sample of the rows where ``learn`` holds and the language is known."""
    known = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    different = known.select("lang", "doc_id", F.xxhash64("text").alias("key")).distinct()
    counts = {r["lang"]: r["n"] for r in different.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row for each language
    if not counts:
        return None
    place = F.pmod(F.xxhash64("doc_id", "text", F.lit("language")), F.lit(1 << 20))
    rate = F.create_map(*[F.lit(v) for k, n in sorted(counts.items()) for v in (k, min(1 << 20, 2 * per_language * (1 << 20) // n + 64))])
    cut = F.regexp_extract("text", rf"(?s)\p{{L}}.{{0,{CUT - 1}}}", 0).alias("cut")
    # repeated rows have one place and count once
    drawn = known.where(place < F.coalesce(rate[F.col("lang")], F.lit(0))).groupBy("lang", "doc_id", F.xxhash64("text").alias("key")).agg(F.first("text").alias("text"))
    # the rate lets some more through than needed, so that all languages with enough rows have as many
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id", "key"), "doc_id")
    drawn = drawn.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= per_language)
    rows = drawn.select("lang", "text", cut, "rank").mapInArrow(_vectors, "lang string, codes binary, values binary, cut string").collect()
    if not rows:
        return None
    model = Model(_Rows([r["codes"] for r in rows], [r["values"] for r in rows]), np.array([r["lang"] for r in rows], object))
    model.calibrate(pa.array([r["cut"] for r in rows if r["cut"]], pa.string()))
    return model


def _predict(m: Model | None, column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Language, score, and whether the text is like a learned language."""
    data, offsets = text_buffers(column)
    lang, score, known = np.full(len(offsets) - 1, "und", object), np.zeros(len(offsets) - 1), np.zeros(len(offsets) - 1, bool)
    some = has_letter(data, offsets, column)
    if m is not None:
        for lo, hi in _small(offsets):
            if some[lo:hi].any():
                x = features(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                got, s = m(x)
                lang[lo:hi] = np.where(some[lo:hi], got, "und")
                score[lo:hi] = np.where(some[lo:hi], s, 0.0)
                known[lo:hi] = some[lo:hi] & (m.likeness(x) >= m.least)
    return lang, score, known


def identify(docs: DataFrame, *, learn: Column) -> DataFrame:
    """One row per input row: doc_id, lang_pred, score. Only ``text`` is looked at for a prediction."""
    spark = docs.sparkSession
    settings(spark)
    model = spark.sparkContext.broadcast(train(docs, learn))

    def run(batches):
        for b in batches:
            lang, score, _ = _predict(model.value, b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def accept(docs: DataFrame, *, learn: Column, min_score: float = 0.5) -> DataFrame:
    """The rows like a learned language and with at least ``min_score``, with all their columns."""
    spark = docs.sparkSession
    settings(spark)
    model = spark.sparkContext.broadcast(train(docs, learn))
    at = docs.columns.index("text")

    def run(batches):
        for b in batches:
            _, score, known = _predict(model.value, b.column(at))
            good = np.flatnonzero(known & (score >= min_score))
            yield b.take(pa.array(good))

    return docs.mapInArrow(run, docs.schema)
