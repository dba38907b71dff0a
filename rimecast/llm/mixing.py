"""Mixing sources to target weights: budgets down a domain - language - source tree.

Each leaf's tokens are counted; a node's capacity is that of its children, a leaf's is its
tokens times ``max_epochs``. The budget flows down level by level: children share their
parent's part by weight, a child that can't take its share is filled and what is left over is
shared again among its siblings. As a parent never gets more than its capacity, a shortage
goes to siblings first and only then, through the parent's own capacity, to its siblings.
The fill level of each family comes in closed form from one ordered window over the tree's
nodes, in whole tokens (decimals), so no loop and no driver state is needed.

Selection: a leaf's budget is spent on whole epochs and then a prefix of one more. Epoch
``e`` orders the leaf's documents by a seeded digest; documents are taken while the running
sum of tokens stays within the rest. The running sum goes down the digest's leading characters: at each of
``SLOT_LEVELS`` levels the 256 slots of the slot in which the prefix ends are summed up, so that only one of
some 16 million slots of a leaf is ever sorted: 600 rows of a leaf of ten billion.

Weights are whole numbers, fractions or decimals, compared within one level; a weight of 0 gives no budget (nor do its tokens
count as capacity of what is above), a negative one is an error. A domain is a column of the documents or follows from the source.

A document's tokens are its words, or what the column ``tokens`` says (null: 0); a document without any, as one with a null
or empty text, is never selected and counts nowhere. Null domains, languages or sources form leaves of their own (''), and weights
default to 1. Repeated rows are each a document with the same place in the order: their tokens
are taken together or not at all.
"""

from __future__ import annotations

from fractions import Fraction
from math import lcm

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

LEVELS = ("domain", "lang", "source")
_WIDE = "decimal(38,0)"
#: Levels of slots, and characters of the digest in each.
SLOT_LEVELS, SLOT_CHARS = 3, 2


def default_domain(source: Column) -> Column:
    """Domain of a source: by its number modulo four; a source without a number is web."""
    n = F.regexp_extract(F.coalesce(source, F.lit("")), "([0-9]+)$", 1)
    kind = F.when(n == "", 0).otherwise(F.expr("try_cast(regexp_extract(coalesce(source, ''), '([0-9]+)$', 1) as decimal(38,0))") % 4)
    return F.when(kind == 1, "books").when(kind == 2, "code").when(kind == 3, "news").otherwise("web")


Weight = int | float | str | Fraction


def whole_weights(weights: dict[str, Weight]) -> tuple[dict[str, int], int]:
    """The same weights as whole numbers, and what a weight of 1 is then."""
    exact = {k: v if isinstance(v, Fraction) else Fraction(str(v)) for k, v in weights.items()}
    if bad := sorted(k for k, v in exact.items() if v < 0):
        raise ValueError(f"weights must not be negative: {', '.join(map(str, bad))}")
    one = lcm(*(v.denominator for v in exact.values()))
    return {k: int(v * one) for k, v in exact.items()}, one


def _weight(name: Column, weights: dict[str, Weight]) -> Column:
    given, one = whole_weights(weights)
    out = F.lit(one)
    for k, v in sorted(given.items()):
        out = F.when(name == k, F.lit(v).cast(_WIDE)).otherwise(out)
    return out.cast(_WIDE)


def _floor_div(a: Column, b: Column) -> Column:
    return ((a - a % b) / b).cast(_WIDE)


def _share(children: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Split ``given`` (the parent's budget, on each child) over children with w and cap.

    In order of cap / w, a child is filled while its share of what is left is no less than its
    cap; from the first that isn't, all get shares by weight of what is left then.
    """
    order = Window.partitionBy(*parent).orderBy((F.col("cap").cast("double") / F.col("w").cast("double")), name)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    behind = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    t = children.withColumn("left", (F.col("given") - F.coalesce(F.sum("cap").over(before), F.lit(0))).cast(_WIDE)).withColumn("weights", F.sum("w").over(behind).cast(_WIDE))
    t = t.withColumn("full", (F.col("cap") * F.col("weights") <= F.col("w") * F.col("left")).cast("int"))
    t = t.withColumn("open", F.min("full").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) == 0)
    at = Window.partitionBy(*parent)
    t = t.withColumn("pool", F.max(F.when(F.col("open"), F.col("left"))).over(at)).withColumn("over", F.max(F.when(F.col("open"), F.col("weights"))).over(at))
    share = F.when(F.col("open"), F.least(F.col("cap"), _floor_div(F.col("w") * F.col("pool"), F.col("over")))).otherwise(F.col("cap"))
    return t.select(*children.columns, share.cast(_WIDE).alias("budget"))


def budgets(leaves: DataFrame, total: Column, weights: dict[str, dict[str, Weight]]) -> DataFrame:
    """Budget of each leaf: columns domain, lang, source, tokens, cap, budget."""
    given, none = None, F.lit(False)
    for name in LEVELS:
        none = none | (_weight(F.col(name), weights.get(name, {})) == 0)
    leaves = leaves.withColumn("cap", F.when(none, F.lit(0).cast(_WIDE)).otherwise(F.col("cap")))
    for depth in range(len(LEVELS)):
        keys, parent = list(LEVELS[: depth + 1]), list(LEVELS[:depth])
        nodes = leaves.groupBy(*keys).agg(F.sum("cap").cast(_WIDE).alias("cap"))
        # what has no weight has no capacity either, so that any weight does
        nodes = nodes.withColumn("w", F.greatest(_weight(F.col(keys[-1]), weights.get(keys[-1], {})), F.lit(1).cast(_WIDE)))
        if given is None:
            top = leaves.agg(F.least(total, F.sum("cap")).cast(_WIDE).alias("given")).first()[0]
            nodes = nodes.withColumn("given", F.lit(top).cast(_WIDE)).withColumn("root", F.lit(1))
            parent = ["root"]
        else:
            nodes = nodes.join(given, parent)
        given = _share(nodes, parent, keys[-1]).select(*keys, F.col("budget").alias("given"))
    return leaves.join(given, list(LEVELS)).withColumnRenamed("given", "budget")


def digest(seed: int, epoch: Column, doc_id: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def n_words(text: Column) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")).cast("long")


def _few(leaves: DataFrame) -> DataFrame:
    """Leaves are broadcast while there are few of them; else the join shuffles."""
    return F.broadcast(leaves) if leaves.count() <= 10_000 else leaves


def mix_sources(
    docs: DataFrame, *, weights: dict[str, dict[str, Weight]], share: tuple[int, int] = (1, 2), max_epochs: int = 4, seed: int = 17, tokens: Column | None = None, domain: Column | None = None
) -> DataFrame:
    """Selected rows (doc_id, domain, lang, source, n_tokens, epoch): one for each epoch that takes a document.

    The total budget is ``share`` (numerator, denominator) of all tokens.
    """
    source = F.coalesce("source", F.lit(""))
    size = n_words(F.col("text")) if tokens is None else tokens.cast("long")
    rows = docs.select("doc_id", (default_domain(F.col("source")) if domain is None else F.coalesce(domain.cast("string"), F.lit(""))).alias("domain"), F.coalesce("lang", F.lit("")).alias("lang"), source.alias("source"), size.alias("n_tokens"))
    rows = materialize(rows.where("n_tokens > 0"), "token-counts")
    leaves = rows.groupBy(*LEVELS).agg(F.sum("n_tokens").cast(_WIDE).alias("tokens")).withColumn("cap", (F.col("tokens") * max_epochs).cast(_WIDE))
    leaves = materialize(leaves, "leaves")
    whole = leaves.agg(F.sum("tokens")).first()[0] or 0
    plan = budgets(leaves, F.lit(int(whole) * share[0] // share[1]), weights)
    plan = plan.withColumn("epochs", _floor_div(F.col("budget"), F.col("tokens")).cast("int")).withColumn("rest", (F.col("budget") % F.col("tokens")).cast("long"))
    plan = materialize(plan.select(*LEVELS, "epochs", "rest"), "budgets")
    names = ["doc_id", *LEVELS, "n_tokens"]
    placed = rows.join(_few(plan), list(LEVELS))
    chosen = placed.where("epochs > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("epochs") - 1))).select(*names, "epoch")
    open_ = placed.where("rest > 0").withColumn("place", digest(seed, F.col("epochs"), F.col("doc_id")))
    for level in range(SLOT_LEVELS):
        fits, open_ = _by_slots(open_, 1 + level * SLOT_CHARS)
        chosen = chosen.unionByName(fits.select(*names, F.col("epochs").alias("epoch")))
        open_ = materialize(open_, "edge-slots")
    run = Window.partitionBy(*LEVELS).orderBy("place").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    last = open_.withColumn("sofar", F.sum("n_tokens").over(run)).where("sofar <= rest")
    return chosen.unionByName(last.select(*names, F.col("epochs").alias("epoch")))


def _by_slots(rows: DataFrame, at: int) -> tuple[DataFrame, DataFrame]:
    """Rows of the slots that fit wholly into the rest, and rows of the one slot of each leaf in which it ends, with what is left of it."""
    rows = rows.withColumn("slot", F.substring("place", at, SLOT_CHARS))
    slots = rows.groupBy(*LEVELS, "slot").agg(F.sum("n_tokens").alias("sum"), F.first("rest").alias("rest"))
    upto = Window.partitionBy(*LEVELS).orderBy("slot").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    slots = slots.withColumn("end", F.sum("sum").over(upto))
    before = F.col("end") - F.col("sum")
    fits, edge = F.col("end") <= F.col("rest"), (F.col("end") > F.col("rest")) & (before < F.col("rest"))
    cuts = slots.groupBy(*LEVELS).agg(F.max(F.when(fits, F.col("slot"))).alias("fit"), F.max(F.when(edge, F.col("slot"))).alias("edge"), F.max(F.when(edge, before)).alias("start"))
    cut = rows.join(_few(materialize(cuts, "cuts")), list(LEVELS))
    ends = cut.where("slot = edge").withColumn("rest", F.col("rest") - F.col("start"))
    return cut.where("slot <= fit"), ends.drop("slot", "fit", "edge", "start")
