"""Quality rules: in-text counts and cross-document line frequency, in built-in functions only.

In-text counts: words (``[^\\x20\\x09-\\x0D]+``), their characters, symbols, repeated lines,
and words in three-word windows found at least twice in the text. A document fails the base
rules with under 50 words, or with over half of its words in repeated windows.

Line frequency: normalised lines are hashed once, into a table of lines, and the distinct documents
that have each are counted per host. A line is over the limit when it occurs in more than ``max_docs`` documents of the
host and in more than ``max_share`` of them; it is taken out, and a document that loses more
than ``max_removed`` of its words that way is depleted and rejected. With ``with_text`` the
result also has each text without its lines over the limit.

A null text has no words and fails; a null host is a host of its own. Documents are told apart by their ids, so rows that
repeat an id are one document in line counts and host sizes; rows with a null id are, if their texts differ, documents of their
own. Repeated rows get equal results. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .lines import join_lines, line_hashes, raw_lines

WORD_BREAK = r"[\x20\x09-\x0D]+"


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), "")


def _triples(words: Column) -> Column:
    """Hashes of the three-word windows, in order."""
    n = F.size(words)
    return F.when(n >= 3, F.transform(F.slice(words, F.lit(1), n - 2), lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))))


def _covered(placed: Column) -> Column:
    """Words covered by windows of three at the given positions (array of structs h, i sorted by h, i)."""
    again = F.filter(placed, lambda x, i: (x["h"] == F.get(placed, i - 1)["h"]) | (x["h"] == F.get(placed, i + 1)["h"]))
    at = F.sort_array(F.transform(F.filter(again, lambda x: x.isNotNull()), lambda x: x["i"]))
    first = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last"))
    return F.aggregate(at, first, lambda s, p: F.struct((s["n"] + F.least(F.lit(3), p - s["last"])).alias("n"), p.alias("last")))["n"]


def text_counts(docs: DataFrame, *, host_col: str = "source", with_text: bool = False) -> DataFrame:
    """doc_id, text_key, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and, on request, full_text."""
    full = ["full_text"] * with_text
    text = F.coalesce(F.col("text"), F.lit(""))
    a = docs.select("doc_id", F.xxhash64("text").alias("text_key"), F.col(host_col).cast("string").alias("host"), text.alias("text"), _words(F.col("text")).alias("words"), *[F.col("text").alias(c) for c in full])
    lines = F.filter(raw_lines(F.col("text")), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    b = a.select(
        "doc_id", "text_key", "host",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        lines.alias("lines"),
        _triples(F.col("words")).alias("grams"),
        *full,
    )
    repeated = F.size(F.array_distinct("grams")) < F.size("grams")
    c = b.select(
        "doc_id", "text_key", "host", "n_words", "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(repeated, F.sort_array(F.transform("grams", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("placed"),
        *full,
    )
    return c.select("doc_id", "text_key", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", F.coalesce(_covered(F.col("placed")), F.lit(0).cast("long")).alias("n_repeat_words"), *full)


def line_table(docs: DataFrame, host_col: str) -> DataFrame:
    """Lines with a word, written out: (doc_id, text_key, host, pos, key, n), ``key`` of host and line, ``n`` its words."""
    lines = F.arrays_zip(line_hashes(F.col("text")).alias("h"), F.transform(raw_lines(F.col("text")), lambda x: F.size(_words(x))).alias("n"))
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), F.xxhash64(host_col).alias("host"), F.posexplode(lines).alias("pos", "line")).where(F.col("line.h").isNotNull())
    return materialize(rows.select("doc_id", "text_key", "host", "pos", F.xxhash64("host", "line.h").alias("key"), F.col("line.n").alias("n")), "lines")


def frequent_lines(docs: DataFrame, lines: DataFrame, *, host_col: str = "source", max_docs: int = 10, max_share: float = 0.01) -> DataFrame:
    """Keys of the lines over the limits. Only lines of enough rows have their distinct documents counted."""
    unnamed = F.when(F.col("doc_id").isNull(), F.col("text_key")).alias("unnamed")
    often = materialize(lines.groupBy("key").agg(F.count("*").alias("rows")).where(F.col("rows") > max_docs).select("key"), "often")
    held = join_lines(lines, often, "key", "left_semi").select("host", "key", "doc_id", unnamed).distinct().groupBy("host", "key").agg(F.count("*").alias("n")).where(F.col("n") > max_docs)
    of = docs.select(F.xxhash64(host_col).alias("host"), "doc_id", F.xxhash64("text").alias("text_key"))
    sizes = of.select("host", "doc_id", unnamed).distinct().groupBy("host").agg(F.count("*").alias("docs"))
    return held.join(sizes, "host").where(F.col("n") > F.col("docs") * max_share).select("key")


def apply_quality_rules(
    docs: DataFrame, *, host_col: str = "source", max_docs: int = 10, max_share: float = 0.01, max_removed: float = 0.5, min_words: int = 50, max_repeat_pct: int = 50, with_text: bool = False
) -> DataFrame:
    """One row per input row: the counts, n_removed_words, base_failed, depleted, kept and, on request, the text without its lines over the limits."""
    lines = line_table(docs, host_col)
    over = materialize(frequent_lines(docs, lines, host_col=host_col, max_docs=max_docs, max_share=max_share), "frequent-lines")
    # repeated rows bring the same lines once more: one row of each line and position counts
    hits = join_lines(lines, over, "key", "left_semi").groupBy("doc_id", "text_key", "pos").agg(F.max("n").alias("n"))
    lost = hits.groupBy("doc_id", "text_key").agg(F.sum("n").alias("lost"), *[F.collect_set("pos").alias("gone")] * with_text)
    counts = text_counts(docs, host_col=host_col, with_text=with_text)
    joined = counts.join(lost.withColumnsRenamed({"doc_id": "_id", "text_key": "_key"}), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")), "left")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_pct * F.col("n_words"))
    lost_words = F.least(F.coalesce("lost", F.lit(0)), F.col("n_words"))
    depleted = lost_words > F.col("n_words") * max_removed
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    stay = F.filter(raw_lines(F.col("full_text")), lambda x, i: ~F.array_contains(F.col("gone"), i))
    clean = [F.when(F.col("gone").isNull(), F.col("full_text")).otherwise(F.array_join(stay, "\n")).alias("text")] * with_text
    return joined.select(*names, failed.alias("base_failed"), (~failed & ~depleted).alias("kept"), lost_words.cast("long").alias("n_removed_words"), depleted.alias("depleted"), *clean)
