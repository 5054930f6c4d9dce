"""The registered queries of this subpackage; each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchloom.llm.archives import archive_pages
from batchloom.llm.chat import digests, format_chat
from batchloom.llm.decontamination import find_leaks
from batchloom.llm.differencing import pack_evenly
from batchloom.llm.filter_audit import audit_filters
from batchloom.llm.hard_negatives import mine_hard_negatives
from batchloom.llm.lattice import score_texts
from batchloom.llm.packing import pack
from batchloom.llm.quality_rules import quality_rules
from batchloom.llm.rule_ensemble import score_quality
from batchloom.llm.simhash_dedup import near_duplicates
from batchloom.llm.substring_dedup import remove_repeated_words
from batchloom.llm.suffix_dedup import remove_repeats

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _query(function):
    QUERIES[function.__name__] = function
    return function


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def byte_level_tokenizer() -> str:
    """The place of the byte-level vocabulary on this machine and on every executor."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


@_query
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"), byte_level_tokenizer())


@_query
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(_table(spark, sf_dir, "pages")).drop("record_id")


@_query
def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    more = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return digests(format_chat(rows))


@_query
def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query
def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return score_texts(_table(spark, sf_dir, "documents"), str(public_tokenizers.path("piece_bpe_32k.model")))


@_query
def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_query
def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = remove_repeats(_table(spark, sf_dir, "documents"), 50)
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@_query
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = remove_repeated_words(_table(spark, sf_dir, "documents"), 20)
    return left.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


@_query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_table(spark, sf_dir, "documents"))


@_query
def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), 3, 2)


@_query
def op11_hard_negative_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(rows.select("vec_id", "embedding", moved.alias("label")), F.col("vec_id") % 50 == 0)


@_query
def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_evenly(_table(spark, sf_dir, "documents"), byte_level_tokenizer())


@_query
def op13_filter_interaction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
