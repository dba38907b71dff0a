"""Cross-site line removal: how many distinct sites carry a line, in built-in functions only.

Lines are normalised and hashed once, into a table of (document, site, line). Only lines of at least
``min_sites`` rows can spread over that many sites, so the rest leave first, by a count. For the others,
HyperLogLog sketches of the sites are built per line and merged by aggregation. Where the estimate lies
within four standard errors of the threshold, the distinct sites are counted exactly. A line
spread over ``min_sites`` sites or more is boilerplate: it stays in the document with the
smallest id that has it and is removed from all others. Only texts that may hold a line to remove are exchanged.

A null site counts as a site of its own, a null text as empty. Rows with a null id come last in
the order of ids, by the hashes of their texts: a line that only such rows have stays in the one with the least. Rows
that repeat an id count as one document for the order. Repeated rows get equal results.
All columns are handed through, whatever their names; input columns that are called like the two counts give way to them.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, materialize, split_rows
from .lines import join_lines, line_hashes, raw_lines

LG_K = 12
_ERRORS = 4 * 1.04 / math.sqrt(1 << LG_K)


def line_slots(docs: DataFrame, site_col: str) -> DataFrame:
    """Distinct lines of each row, written out: (doc_id, text_key, site, line)."""
    site = F.coalesce(F.col(site_col).cast("string"), F.lit("\0"))
    lines = F.array_compact(F.array_distinct(line_hashes(F.col("text"))))
    return materialize(docs.select("doc_id", F.xxhash64("text").alias("text_key"), site.alias("site"), F.explode(lines).alias("line")), "line-slots")


def boilerplate(slots: DataFrame, *, min_sites: int = 10) -> DataFrame:
    """Lines spread over ``min_sites`` sites or more, and where each stays: (line, first_doc, first_key), the key where no id is known."""
    often = materialize(slots.groupBy("line").agg(F.count("*").alias("n")).where(F.col("n") >= min_sites).select("line"), "common-lines")
    common, home = join_lines(slots, often, "line"), ["line", "first_doc", "first_key"]
    spread = common.groupBy("line").agg(F.hll_sketch_agg("site", LG_K).alias("sketch"), F.min("doc_id").alias("first_doc"), F.min("text_key").alias("first_key"))
    spread = materialize(spread.select(*home, F.hll_sketch_estimate("sketch").alias("sites")), "line-spread")
    low, high = math.floor(min_sites * (1 - _ERRORS)), math.ceil(min_sites * (1 + _ERRORS))
    near = materialize(spread.where(F.col("sites").between(low, high)).select(*home), "near-lines")
    exact = join_lines(common, near.select("line"), "line", "left_semi").groupBy("line", "site").agg(F.lit(1)).groupBy("line").agg(F.count("*").alias("exact"))
    near = near.join(exact, "line").where(F.col("exact") >= min_sites).select(*home)
    return spread.where(F.col("sites") > high).select(*home).unionByName(near)


def remove_boilerplate(docs: DataFrame, *, site_col: str = "source", min_sites: int = 10, counts: tuple[str, str] = ("n_lines", "n_removed")) -> DataFrame:
    """All columns of ``docs`` with ``text`` cleaned, and the numbers of lines and of removed ones, named by ``counts``."""
    slots = line_slots(docs, site_col)
    found = materialize(boilerplate(slots, min_sites=min_sites), "boilerplate")
    id_, key, gone = fresh([*docs.columns, *counts], "id", "key", "gone")
    stays = F.col("doc_id").eqNullSafe(F.col("first_doc")) & (F.col("doc_id").isNotNull() | (F.col("text_key") == F.col("first_key")))
    hits = join_lines(slots, found, "line").where(~stays)
    hits = materialize(hits.groupBy(F.col("doc_id").alias(id_), F.col("text_key").alias(key)).agg(F.collect_set("line").alias(gone)), "line-hits")
    maybe, clean = split_rows(docs, F.xxhash64("doc_id", F.xxhash64("text")), materialize(hits.select(F.xxhash64(id_, key).alias("key")), "hit-keys"))
    maybe = maybe.join(hits, F.col("doc_id").eqNullSafe(F.col(id_)) & (F.xxhash64("text") == F.col(key)), "left")
    pairs = F.arrays_zip(raw_lines(F.col("text")).alias("line"), line_hashes(F.col("text")).alias("h"))
    stay = F.filter(pairs, lambda x: x["h"].isNull() | ~F.array_contains(F.col(gone), x["h"]))
    cut = F.when(F.col(gone).isNull(), F.col("text")).otherwise(F.array_join(F.transform(stay, lambda x: x["line"]), "\n"))
    n_gone = F.when(F.col(gone).isNull(), 0).otherwise(F.size(F.filter(line_hashes(F.col("text")), lambda h: F.array_contains(F.col(gone), h))))
    n_lines = F.when(F.coalesce("text", F.lit("")) == "", 0).otherwise(F.size(raw_lines(F.col("text")))).cast("long").alias(counts[0])
    names = [c for c in docs.columns if c not in counts]
    done = maybe.select(*[cut.alias(c) if c == "text" else F.col(c) for c in names], n_lines, n_gone.cast("long").alias(counts[1]))
    return clean.select(*names, n_lines, F.lit(0).cast("long").alias(counts[1])).unionByName(done)
