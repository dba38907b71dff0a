"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query()
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_counts import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"), tokenizer_file())


@query(oracles.near_duplicates(3, 85))
def op3_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .near_dups import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=85).drop("text_key")


#: Production parameters.
MIN_SITES = 10
LINE_LIMITS = {"max_docs": 10, "max_share": 0.01, "max_removed": 0.5}
WEIGHTS = {"domain": {"web": 4, "books": 3, "code": 2, "news": 1}, "lang": {"en": 6, "de": 2, "fr": 1, "es": 1}}
MIX = {"weights": WEIGHTS, "share": (1, 2), "max_epochs": 4, "seed": 17}


@query(oracles.line_dedup(MIN_SITES))
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import remove_boilerplate

    out = remove_boilerplate(table(spark, sf_dir, "documents"), min_sites=MIN_SITES)
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query("WITH " + oracles.mixing("documents", **MIX) + " SELECT * FROM mixed")
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix_sources

    return mix_sources(table(spark, sf_dir, "documents"), **MIX)


@query(oracles.quality_rules(**LINE_LIMITS))
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_rules import apply_quality_rules

    return apply_quality_rules(table(spark, sf_dir, "documents"), **LINE_LIMITS)


def _fold(n: int):
    """crc32 of the id as text, modulo n."""
    return F.crc32(F.col("doc_id").cast("string")) % n


@query()
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language_id import identify

    out = identify(table(spark, sf_dir, "documents"), learn=_fold(5) != 0)
    return out.select("doc_id", F.coalesce(_fold(5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query()
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import score_toxicity

    out = score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), learn=_fold(4) != 2)
    return out.select("doc_id", F.coalesce(_fold(4) == 2, F.lit(False)).alias("held_out"), "score", "predicted")


@query()
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import find_pii

    return find_pii(table(spark, sf_dir, "documents"))


@query(oracles.repeats(20))
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substring_dedup import remove_repeats

    out = remove_repeats(table(spark, sf_dir, "documents"), k=20)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query(oracles.contamination(5, 0.8))
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import find_contamination

    out = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), overlap=0.8)
    items = F.array_join(F.transform("items", lambda i: i.cast("string")), ",")
    return out.select("doc_id", "n_items", items.alias("items"), F.round("overlap", 6).alias("overlap"), "contaminated", (~F.col("contaminated")).alias("kept"))


@query(oracles.filter_audit())
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .filter_audit import filter_interactions

    return filter_interactions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def damaged(conversations: DataFrame) -> DataFrame:
    """The conversations with rows dropped, emptied, cut, repeated or given to the user; dropped ones have ``present`` false."""
    conv, turn = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    act = F.crc32(F.concat(conv, F.lit(":"), turn)) % 20
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    text = F.when(act == 0, "").when(act == 1, "").when(act == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    copies = F.explode(F.when(act == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")
    return conversations.select("conv_id", "turn", F.when(act == 4, "user").otherwise(role).alias("role"), text.alias("text"), (act != 0).alias("present"), copies).drop("copy")


@query(oracles.conversation_repair())
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .conversation_repair import repair_conversations

    return repair_conversations(damaged(table(spark, sf_dir, "conversations")), F.col("present"))


@query()
def op13_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .piece_encoding import encode_pieces

    out = encode_pieces(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"), with_text=True)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
