"""A corpus pipeline of five stages, each on all that the one before it kept.

Language identification drops what has no known language; line dedup takes cross-site
boilerplate lines out (a document left without a word goes); near-dedup keeps one document of
each group; decontamination drops documents that hold benchmark items; mixing selects rows
to the target weights. Each stage's result is written to the shared folder and read again.

``n_chars`` follows the cleaned text. The last stage returns the selected documents' ids with
their leaf, tokens and epoch. Repeated rows are one document from near-dedup on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rimecast.llm.common import fresh, materialize, only_last
from rimecast.llm.decontaminate import drop_contaminated
from rimecast.llm.language_id import accept
from rimecast.llm.line_dedup import remove_boilerplate
from rimecast.llm.mixing import mix_sources
from rimecast.llm.near_dups import deduplicate
from rimecast.llm.queries import MIN_SITES, MIX, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return accept(docs, learn=F.lit(True))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    n_lines, n_removed = fresh(docs.columns, "n_lines", "n_removed")
    clean = remove_boilerplate(docs, min_sites=MIN_SITES, counts=(n_lines, n_removed))
    left = clean.where((F.col(n_removed) == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    size = F.when(F.col(n_removed) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", size).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_sources(docs, **MIX)


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

#: The first stage is a trained model, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with only_last(spark):  # a stage's own tables go once its result is written
            docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
