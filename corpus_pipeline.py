"""A training corpus from raw documents, in five stages.

Every stage gets the documents that its predecessor kept, as a stored table. All stages but the last give documents with the
same columns; null texts are treated as empty. Near-dedup and decontamination decide on rows, by a stored key of each row:
rows that share a ``doc_id`` or have none are judged by their own texts. Other columns than those of ``documents`` are dropped
at the first stage. Repeated rows of one document become one at near-dedup. Empty tables go through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchloom.llm.decontamination import find_leaks
from batchloom.llm.packing import pack
from batchloom.llm.quality_rules import quality_rules
from batchloom.llm.queries import byte_level_tokenizer
from batchloom.llm.simhash_dedup import near_duplicates
from batchloom.llm.substring_dedup import remove_repeated_words
from batchloom.sources.files import write_scratch

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _keyed(docs: DataFrame) -> DataFrame:
    """The documents with a stored ``row``, different for every row."""
    return write_scratch(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("row")), "keyed")


def _texts(keyed: DataFrame) -> DataFrame:
    """What the operators judge: each row under its key."""
    return keyed.select(F.col("row").alias("doc_id"), "text")


def _chosen(keyed: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    """The documents that are (not) named; the names are stored first, so that Spark knows their size when it plans the join."""
    return keyed.join(write_scratch(rows, "named").hint("shuffle_hash"), "row", how).select(COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules(docs, keep=tuple(COLUMNS)).where("kept").select(COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates (three-word shingles, two bits): that with the smallest id, null counting as
    the largest; of one id, that with the smallest hash of its columns."""
    keyed = _keyed(docs)
    found = near_duplicates(_texts(keyed), 3, 2).select(F.col("doc_id").alias("row"), "component_id")
    rank = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", F.xxhash64(*COLUMNS[1:]).alias("content"), "row")
    best = found.join(keyed.select("row", rank.alias("rank")), "row").groupBy("component_id").agg(F.min("rank").alias("best"))
    return _chosen(keyed, best.select("best.row"), "left_semi")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without words covered by windows of twenty words that start earlier in the corpus; others are unchanged."""
    found = remove_repeated_words(docs.select(COLUMNS), 20, keep=tuple(COLUMNS))
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    n_chars = F.when(F.col("n_removed") > 0, F.length("kept_text").cast("bigint")).otherwise(F.col("n_chars"))
    return found.select("doc_id", text.alias("text"), "lang", "source", n_chars.alias("n_chars"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no item of the benchmark."""
    keyed = _keyed(docs)
    leaks = find_leaks(_texts(keyed), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _chosen(keyed, leaks.select(F.col("doc_id").alias("row")).distinct(), "left_anti")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens with their places in sequences."""
    return pack(docs, byte_level_tokenizer())


STAGES = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", decontaminate),
    ("best_fit_packing", packing),
]

#: SQL cannot express the tokenizer and the fingerprints; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed corpus of the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_scratch(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
