"""Toxicity by a character n-gram linear classifier with naive Bayes log-count ratios.

A text is the set of its hashed byte n-grams (letters only, lower case, words set off by
spaces). From labelled documents each n-gram gets its log-count ratio between toxic and other
documents; all n-grams, of either sign, are scaled by it (drawn towards 0 where few documents speak for it), and a logistic regression on them gives the score, calibrated to the share of toxic labels.

Training uses at most ``PER_CLASS`` labelled documents of each class, those with the smallest hashes of their
ids; of rows that repeat an id, one text counts. Every text is scored whole. Null or empty texts get the score of the bias. Labels
that are null or belong to no document are not used, several labels of one id count as their
largest. Without labels of both classes the score is the share of toxic labels (0 if none).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import chunks, text_buffers
from .common import materialize, settings
from .linear import grams, letters, logistic

PER_CLASS = 1500
LOG2 = 20
SIZES = (4, 5, 6)
#: An n-gram of so many documents has its ratio multiplied by the square root of a half.
DRAWN = 20
L2 = 0.3
_SAMPLE_PARTS = 8


def feature_sets(data: np.ndarray, offsets: np.ndarray, wanted: np.ndarray | None = None):
    """Distinct n-gram codes of each text in turn; only those ``wanted``, if given."""
    # a space before and after each text sets off its first and last word
    n = len(offsets) - 1
    where = offsets[1:-1]
    clean = letters(data)
    clean = np.insert(clean, np.r_[0, np.repeat(where, 2), len(clean)], 0x20)
    offsets = offsets + 2 * np.arange(n + 1)
    last = np.zeros(1 << LOG2, np.int32)
    parts = [grams(clean, offsets, k, LOG2) for k in SIZES]
    for i in range(n):
        codes = np.concatenate([c[at[i] : at[i + 1]] for c, at in parts])
        if wanted is not None:
            codes = codes[wanted[codes]]
        order = np.arange(len(codes), dtype=np.int32)
        last[codes] = order
        yield codes[last[codes] == order]


def _document_counts(batches):
    counts = np.zeros((2, 1 << LOG2), np.uint32)
    for b in batches:
        data, offsets = text_buffers(b.column(1))
        label = b.column(0).to_numpy(zero_copy_only=False)
        for lo, hi in chunks(offsets):
            for i, codes in enumerate(feature_sets(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])):
                counts[label[lo + i], codes] += 1
    yield pa.RecordBatch.from_arrays([pa.array([counts.tobytes()], pa.binary())], ["counts"])


def _sparse_rows(wanted):
    def run(batches):
        keep = wanted.value
        for b in batches:
            data, offsets = text_buffers(b.column(1))
            for lo, hi in chunks(offsets):
                sets = [np.sort(c).astype(np.int32).tobytes() for c in feature_sets(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], keep)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array(sets, pa.binary())], ["label", "codes"])

    return run


def train(docs: DataFrame, labels: DataFrame, learn: Column, label_col: str) -> tuple[np.ndarray, float]:
    """Weights over all codes, and the bias."""
    spark = docs.sparkSession
    known = labels.where(learn & F.col(label_col).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg((F.max(label_col) > 0).cast("int").alias("label"))
    counts = dict.fromkeys((0, 1), 0) | {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = counts[1] / max(1, counts[0] + counts[1])
    prior = np.log(share / (1 - share)) if 0 < share < 1 else (40.0 if share else -40.0)
    nothing = np.zeros(1 << LOG2, np.float32), float(prior)
    if not 0 < share < 1:
        return nothing
    picked = None
    for c in (0, 1):  # the smallest hashes of each class
        part = known.where(F.col("label") == c).orderBy(F.xxhash64("doc_id", F.lit("toxicity")), "doc_id").limit(PER_CLASS)
        picked = part if picked is None else picked.unionByName(part)
    picked = materialize(picked, "labelled-ids")
    sample = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    sample = materialize(sample.select("label", "text").repartition(_SAMPLE_PARTS), "labelled-sample")
    both = np.zeros((2, 1 << LOG2), np.int64)
    for r in sample.mapInArrow(_document_counts, "counts binary").toLocalIterator():
        both += np.frombuffer(r["counts"], np.uint32).reshape(2, -1)
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    df = both.sum(axis=0)
    wanted = df > 0
    best = np.flatnonzero(wanted)
    if len(sizes) < 2 or not len(best):
        return nothing
    log = [np.log((both[c] + 1) / (sizes[c] + 2)) for c in (0, 1)]
    ratio = (log[1] - log[0]) * np.sqrt(df / (df + DRAWN))
    place, y, sets = np.cumsum(wanted, dtype=np.int32) - 1, [], []
    for r in sample.mapInArrow(_sparse_rows(spark.sparkContext.broadcast(wanted)), "label int, codes binary").toLocalIterator():
        y.append(r["label"])
        sets.append(place[np.frombuffer(r["codes"], np.int32)])
    y = np.array(y, np.float64)
    weight = np.where(y > 0, share * len(y) / y.sum(), (1 - share) * len(y) / (len(y) - y.sum()))
    w = logistic(sets, ratio[best], y, weight, L2)
    table = np.zeros(1 << LOG2, np.float32)
    table[best] = w[:-1] * ratio[best]
    return table, float(w[-1])


def score_toxicity(docs: DataFrame, labels: DataFrame, *, learn: Column, label_col: str = "toxic", threshold: float = 0.3) -> DataFrame:
    """One row per input row: doc_id, score, predicted (score >= threshold). ``learn``: a condition on labels."""
    spark = docs.sparkSession
    settings(spark)
    weights, bias = train(docs, labels, learn, label_col)
    model = spark.sparkContext.broadcast(weights)

    def run(batches):
        w = model.value
        used = w != 0
        for b in batches:
            data, offsets = text_buffers(b.column(1))
            z = np.empty(len(offsets) - 1)
            for lo, hi in chunks(offsets):
                for i, codes in enumerate(feature_sets(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], used)):
                    z[lo + i] = np.sort(w[codes]).sum(dtype=np.float64) + bias
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(1 / (1 + np.exp(-np.clip(z, -40, 40))))], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
