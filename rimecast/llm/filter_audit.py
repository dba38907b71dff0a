"""How filters interact: what each order of them removes, at which step, and what each filter alone is worth.

Every document is reduced to a mask with one bit for each filter it fails. Documents are counted by
(part, mask, labels); these mask cells, not the documents, are then unpivoted against all orders and steps
of the filters. Within a cell and an order, a running bit-or over the steps before tells whether the cell has
failed earlier; conditional sums per (part, order, step) give what is kept, removed, redundant and lost, and a
window over all orders of one filter gives its Shapley total.

Documents meet in exchanges as ids, digests and bits only, never as texts. Copies of a text are combined before they
are exchanged, so a text that fills a third of the table is one row of each task.

A null text is empty. A null part is the part "". A document with a null id is no copy of a smaller one, since nothing
is smaller than null, and has no labels. Rows that repeat an id count each; among copies all rows with the smallest id are the first.
A document that has several rows of labels has a label if one of them sets it. An empty table gives no rows; a part has all orders and
steps, zeros included. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .quality_rules import _words

#: n filters have n! orders; 7 are 35,280 rows for each part.
MOST_FILTERS = 7
NULL_SALTS = 64


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions of one text: few words, few distinct words, many capitals, special characters."""
    text = F.coalesce(text, F.lit(""))
    words = _words(text)
    return {
        "A": F.size(words) < 100,
        "B": 100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 10 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def mask_cells(docs: DataFrame, labels: DataFrame, filters: dict[str, Column], *, part: Column, copies: bool = True) -> DataFrame:
    """Documents counted by (part, mask, good, toxic): ``n`` of each.

    ``filters`` are failure conditions of a row, the first one bit 0 of the mask; with ``copies`` one further bit says
    that a smaller id has the same text.
    """
    bits = reduce(lambda a, b: a.bitwiseOR(b), [F.when(failed, F.lit(1 << k)).otherwise(F.lit(0)) for k, failed in enumerate(filters.values())])
    digest = F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)) if copies else F.lit(None).cast("binary")
    # an id that is null finds no labels: such rows are dealt out by their digests
    salt = F.when(F.col("id").isNull(), F.pmod(F.xxhash64("digest"), F.lit(NULL_SALTS)) + 1).otherwise(F.lit(0)).cast("int")
    rows = docs.select(F.col("doc_id").alias("id"), F.coalesce(part.cast("string"), F.lit("")).alias("part"), digest.alias("digest"), bits.alias("bits")).withColumn("salt", salt)
    known = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    rows = rows.join(known.withColumn("salt", F.lit(0)), ["id", "salt"], "left")
    what = ["digest", "bits", "part", "good", "toxic"]
    rows = rows.select("id", "salt", *[F.coalesce(c, F.lit(0)).alias(c) if c in ("good", "toxic") else F.col(c) for c in what])
    # one row per id and text first, without an exchange of its own; then copies are combined before they are exchanged
    same = rows.groupBy("id", "salt", *what).agg(F.count("*").alias("n"))
    cells = same.groupBy(*what).agg(F.sum("n").alias("n"), F.min("id").alias("low"), F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("n_null"), F.min_by("n", "id").alias("n_low"))
    if copies:
        cells = cells.withColumn("first", F.min("low").over(Window.partitionBy("digest")))
        firsts = F.col("n_null") + F.when(F.col("low") == F.col("first"), F.col("n_low")).otherwise(0)
        split = F.array(F.struct(F.col("bits").alias("mask"), firsts.alias("n")), F.struct(F.col("bits").bitwiseOR(F.lit(1 << len(filters))).alias("mask"), (F.col("n") - firsts).alias("n")))
        cells = cells.select("part", "good", "toxic", F.explode(split).alias("x")).select("part", "good", "toxic", "x.mask", "x.n")
    else:
        cells = cells.select("part", "good", "toxic", F.col("bits").alias("mask"), "n")
    return cells.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").cast("long").alias("n")).where("n > 0")


def audit_filters(cells: DataFrame, names: Sequence[str]) -> DataFrame:
    """Metrics per (part, filter_order, step) of counted mask cells; bit k of a mask is ``names[k]``, one letter each."""
    if not 1 <= len(names) <= MOST_FILTERS or any(len(x) != 1 for x in names) or len(set(names)) < len(names):
        raise ValueError(f"between 1 and {MOST_FILTERS} filters with different letters, not {list(names)}")
    steps = F.array(*[F.struct(F.lit("".join(names[k] for k in order)).alias("filter_order"), F.lit(at).alias("step"), F.lit(1 << k).alias("bit")) for order in permutations(range(len(names))) for at, k in enumerate(order, 1)])
    long = cells.withColumn("s", F.explode(steps)).select("part", "mask", "good", "toxic", "n", "s.*")
    run = Window.partitionBy("part", "mask", "good", "toxic", "filter_order").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    failed = F.col("mask").bitwiseAND(F.col("bit"))
    earlier = F.coalesce(F.bit_or(failed).over(run), F.lit(0)) != 0
    long = long.select("*", (failed != 0).alias("fails"), earlier.alias("gone"))
    fails, gone, out = F.col("fails"), F.col("gone"), F.col("fails") & ~F.col("gone")
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).cast("long")
    metrics = long.groupBy("part", "filter_order", "step", "bit").agg(
        total(~fails & ~gone).alias("kept"),
        total(out).alias("removed"),
        total(fails & gone).alias("redundant"),
        total(F.col("mask") == F.col("bit")).alias("unique_fails"),
        total(out & (F.col("good") == 1)).alias("good_lost"),
        total(out & (F.col("toxic") == 1)).alias("toxic_lost"),
    )
    whole = Window.partitionBy("part", "bit")
    return metrics.withColumn("shapley", F.sum("removed").over(whole).cast("long")).drop("bit")


def filter_interactions(docs: DataFrame, labels: DataFrame, *, part_col: str = "lang") -> DataFrame:
    """The audit of filters A to D of a text and E, the copies of a text with a smaller id."""
    filters = text_filters(F.col("text"))
    return audit_filters(mask_cells(docs, labels, filters, part=F.col(part_col)), [*filters, "E"])
