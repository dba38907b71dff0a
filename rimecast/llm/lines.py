"""Normalised lines of a text, as built-in column expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A side of at most so many rows is broadcast (a row is a few longs); a larger one is shuffled.
BROADCAST_ROWS = 50_000
SALTS = 16


def raw_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_hashes(text: Column) -> Column:
    """A hash for each ``\\n``-separated line, in order; null for a line without a word.

    Lines are compared in lower case, with runs of blanks as one space and none at the ends.
    """
    plain = F.split(F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09\x0B-\x0D]+", " ")), "\n")
    return F.transform(plain, lambda x: F.when(F.trim(x) != "", F.xxhash64(F.trim(x))))


def join_lines(slots: DataFrame, side: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join rows of lines (with doc_id and text_key) to a materialised table keyed by line.

    A table of few rows is broadcast, after counting it. A larger one is copied to ``SALTS`` salts and
    shuffled, so that a line which fills a third of all rows is dealt to many tasks.
    """
    if side.count() <= BROADCAST_ROWS:
        return slots.join(F.broadcast(side), key, how)
    salted = side.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = slots.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(SALTS)).cast("int"))
    return dealt.join(salted, [key, "_salt"], how).drop("_salt")
