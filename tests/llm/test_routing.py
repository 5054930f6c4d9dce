"""Buckets follow the size of the input; their number never changes a result."""

import public_tokenizers
import pytest

from batchloom.llm import routing
from batchloom.llm.lattice import score_texts
from batchloom.llm.substring_dedup import remove_repeated_words
from batchloom.llm.suffix_dedup import remove_repeats


def test_buckets_follow_the_input(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    few = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert routing.bucket_count(docs) == few
    size = routing.stored_bytes(docs)
    monkeypatch.setattr(routing, "BUCKET_BYTES", size // (10 * few))
    assert size <= routing.bucket_count(docs) * routing.BUCKET_BYTES < size + routing.BUCKET_BYTES
    unknown = spark.createDataFrame(spark.sparkContext.parallelize([(1, "a")]), "doc_id long, text string")
    assert routing.stored_bytes(unknown) == 0 and routing.bucket_count(unknown) == few


@pytest.mark.parametrize(
    "run",
    [remove_repeats, remove_repeated_words, lambda d: score_texts(d, str(public_tokenizers.path("piece_bpe_32k.model"))).drop("score", "base_score")],
    ids=["bytes", "words", "scores"],
)
def test_results_do_not_depend_on_the_buckets(spark, sf_dir, monkeypatch, run):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    few = sorted(map(tuple, run(docs).collect()))
    monkeypatch.setattr(routing, "BUCKET_BYTES", routing.stored_bytes(docs) // 300)
    assert routing.bucket_count(docs) >= 300
    assert sorted(map(tuple, run(docs).collect())) == few
