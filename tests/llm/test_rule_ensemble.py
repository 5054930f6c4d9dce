"""The rule ensemble on held-out labels, on edge rows and, all rows of a table, against plain counting."""

import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from batchloom.llm import rule_ensemble as module
from batchloom.llm.queries import QUERIES
from batchloom.llm.rule_ensemble import STATISTICS, compiled, score_quality, statistics, tree_rules

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored = QUERIES["op4_quality_classifier"](spark, SF).cache()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert scored.count() == docs.count()
    assert scored.where("score < 0 or score > 1 or score is null or predicted != int(score >= 0.3)").count() == 0
    assert scored.where(F.col("held_out") != (F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0)).count() == 0
    held = [(r.score, r.quality, r.predicted) for r in scored.where("held_out").join(labels, "doc_id").collect()]
    good, bad = [s for s, q, _ in held if q], [s for s, q, _ in held if not q]
    assert sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad)) > 0.95
    assert sum(p == q for _, q, p in held) / len(held) > 0.93


def test_edges(spark):
    rows = [(1, "a b c", "x"), (2, None, "x"), (None, "", "x"), (3, "the cat " * 3000, None), (3, "the cat " * 3000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = score_quality(docs, none).collect()
    assert len(got) == 5 and {r.score for r in got} == {0.5}
    one = spark.createDataFrame([(1, 1, 0), (2, 1, None), (3, None, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    assert all(0 < r.score < 1 for r in score_quality(docs, one).collect())
    assert score_quality(docs.limit(0), one).count() == 0


def test_paths_become_rules():
    text = """RandomForest
  Tree 0 (weight 1.0):
    If (feature 0 <= 2.0)
     If (feature 0 <= 1.0)
      Predict: 0.0
     Else (feature 0 > 1.0)
      Predict: 1.0
    Else (feature 0 > 2.0)
     Predict: 1.0
"""
    inf = float("inf")
    name = next(iter(STATISTICS))
    assert tree_rules(text) == {((name, -inf, 2.0),), ((name, -inf, 1.0),), ((name, 1.0, 2.0),), ((name, 2.0, inf),)}


def test_compiled_expression(spark):
    name = next(iter(STATISTICS))
    docs = spark.createDataFrame([(1, ""), (2, "a b c d e f")], "doc_id long, text string")
    inf = float("inf")
    found = statistics(docs).select("doc_id", compiled(0.0, {((name, 1.0, inf),): 100.0}).alias("p")).collect()
    assert {r.doc_id: round(r.p, 6) for r in found} == {1: 0.5, 2: 1.0}


def plain_statistics(text):
    """Every statistic of one text by plain counting."""
    text = text or ""
    raw = text.encode()
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    repeated = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    n, chars = max(1, len(words)), sum(map(len, words))
    letters = len(re.findall("[A-Za-z]", text))
    return {
        "log_words": math.log1p(len(words)),
        "word_length": chars / n,
        "distinct_words": len(set(words)) / n,
        "repeated_words": len(repeated) / n,
        "repeated_lines": (len(lines) - len(set(lines))) / max(1, len(lines)),
        "words_per_line": len(words) / max(1, len(lines)),
        "symbols": len(re.findall(r"[#*$%&|<>]", text)) / n,
        "bars": text.count("|") / n,
        "exclamations": text.count("!") / n,
        "capitals": len(re.findall("[A-Z]", text)) / max(1, letters),
        "digits": len(re.findall("[0-9]", text)) / max(1, chars),
        "stops": len(re.findall("[.,;:?]", text)) / n,
        "other_bytes": (len(raw) - len(re.findall(rb"[A-Za-z0-9 \n.,]", raw))) / max(1, len(raw)),
    }


def test_whole_table_against_plain_counting(spark, sf_dir, monkeypatch):
    """Statistics and scores of all rows: the fitted rules are evaluated one by one in plain Python."""
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    texts |= {-1: None, -2: "", -3: " \n\t ", -4: "é日本 | ! A 1 ;\né日本 | ! A 1 ;\n" * 30, -5: "long " + "x" * 100_000}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r.doc_id: r.asDict() for r in statistics(docs).collect()}
    expected = {d: plain_statistics(t) for d, t in texts.items()}
    assert set(found) == set(expected)
    for d, values in expected.items():
        assert {k: found[d][k] for k in STATISTICS} == pytest.approx(values, rel=1e-12), d
    fitted = []
    real = module.fit
    monkeypatch.setattr(module, "fit", lambda sample: fitted.append(real(sample)) or fitted[-1])
    scored = score_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).collect()
    (intercept, weights) = fitted[0]
    assert len(scored) == len(texts) and weights
    for r in scored:
        fires = sum(w for rule, w in weights.items() if all(low < expected[r.doc_id][name] <= high for name, low, high in rule))
        assert r.score == pytest.approx(1 / (1 + math.exp(-intercept - fires)), rel=1e-9)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.3)


def test_held_out_labels_are_not_learned_from(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    marked = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("one"))
    first, second = ({r.doc_id: r.score for r in score_quality(d, own).collect()} for d, own in ((docs, labels), (marked, turned)))
    assert first == second
