"""Quality classifier as a sparse ensemble of rules.

1. One pass over the texts gives a row of statistics per document.
2. On a bounded sample of labelled documents shallow trees are grown; every path from a root to a node is a rule, a
   conjunction of bounds on statistics.
3. A logistic model with a lasso penalty weighs the rules; most weights are zero and their rules are dropped.
4. The rules that are left are compiled into one Spark column expression over the statistics, which scores all documents.

Statistics are of the whole text; ids, sources, languages and labels are no inputs of a score. Only documents whose CRC-32
of the id as text does not leave the held-out remainder are learned from, at most ``sample_rows`` of them, chosen by a hash
of the id. Null texts are empty and are scored like any other. A null ``doc_id`` stays null and counts as held out; null
labels are not learned from; repeated rows are scored one by one. If there is no label, or only one kind, every score is the
smoothed share of good labels. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchloom.llm.quality_rules import DIGITS, LETTERS, SYMBOLS, UPPER
from batchloom.llm.texts import Texts, binaries, pieces
from batchloom.sources.files import write_scratch

#: A rule: lower (exclusive) and upper (inclusive) bounds by statistic.
Rule = tuple[tuple[str, float, float], ...]


def _distinct_share(t: Texts) -> np.ndarray:
    words = t.words
    first = words.first.tolist()
    return np.array([len(set(words.flat[a:b])) / max(1, b - a) for a, b in zip(first[:-1], first[1:], strict=True)])


def _per(count, whole) -> np.ndarray:
    return count / np.maximum(1, whole)


STATISTICS = {
    "log_words": lambda t: np.log1p(t.n_words),
    "word_length": lambda t: _per(t.word_chars, t.n_words),
    "distinct_words": _distinct_share,
    "repeated_words": lambda t: _per(t.n_repeat_words, t.n_words),
    "repeated_lines": lambda t: _per(t.lines[1], t.lines[0]),
    "words_per_line": lambda t: _per(t.n_words, t.lines[0]),
    "symbols": lambda t: _per(t.count_bytes(SYMBOLS), t.n_words),
    "bars": lambda t: _per(t.count_bytes(b"|"), t.n_words),
    "exclamations": lambda t: _per(t.count_bytes(b"!"), t.n_words),
    "capitals": lambda t: _per(t.count_bytes(UPPER), t.count_bytes(LETTERS)),
    "digits": lambda t: _per(t.count_bytes(DIGITS), t.word_chars),
    "stops": lambda t: _per(t.count_bytes(b".,;:?"), t.n_words),
    "other_bytes": lambda t: _per(t.n_bytes - t.count_bytes(LETTERS + DIGITS + b" \n.,"), t.n_bytes),
}


def statistics(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, one double per statistic)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                texts = Texts(binaries(part.column("text")))
                values = [pa.array(np.asarray(f(texts), dtype=np.float64)) for f in STATISTICS.values()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *values], ["doc_id", *STATISTICS])

    schema = "doc_id bigint, " + ", ".join(f"{name} double" for name in STATISTICS)
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, schema)


def tree_rules(described: str) -> set[Rule]:
    """The paths of trees, read from their description."""
    names = list(STATISTICS)
    rules: set[Rule] = set()
    path: list[tuple[int, str, str, float]] = []
    for line in described.splitlines():
        found = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if not found:
            continue
        depth = len(found[1])
        path = [p for p in path if p[0] < depth] + [(depth, names[int(found[2])], found[3], float(found[4]))]
        bounds: dict[str, tuple[float, float]] = {}
        for _, name, side, value in path:
            low, high = bounds.get(name, (-math.inf, math.inf))
            bounds[name] = (low, min(high, value)) if side == "<=" else (max(low, value), high)
        rules.add(tuple(sorted((n, a, b) for n, (a, b) in bounds.items())))
    return rules


def condition(rule: Rule) -> Column:
    tests = []
    for name, low, high in rule:
        if low > -math.inf:
            tests.append(F.col(name) > low)
        if high < math.inf:
            tests.append(F.col(name) <= high)
    return reduce(lambda a, b: a & b, tests)


def compiled(intercept: float, weights: dict[Rule, float]) -> Column:
    """The ensemble's probability of a good document as a column expression over the statistics."""
    total = F.lit(float(intercept))
    for rule, weight in sorted(weights.items()):
        total = total + F.when(condition(rule), float(weight)).otherwise(0.0)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def fit(sample: DataFrame, trees: int = 20, depth: int = 3, penalty: float = 0.001) -> tuple[float, dict[Rule, float]]:
    """Intercept and non-zero weights, from rows with the statistics and ``label``."""
    labels = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    good, bad = labels.get(1.0, 0), labels.get(0.0, 0)
    if not good or not bad:
        return math.log((good + 1) / (bad + 1)), {}
    vectors = VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(sample)
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, maxBins=64, seed=7, featureSubsetStrategy="onethird").fit(vectors)
    rules = sorted(tree_rules(forest.toDebugString))
    rows = sample.select(F.array(*[condition(r).cast("double") for r in rules]).alias("fires"), "label")
    from pyspark.ml.functions import array_to_vector

    model = LogisticRegression(elasticNetParam=1.0, regParam=penalty, maxIter=100).fit(rows.select(array_to_vector("fires").alias("features"), "label"))
    return model.intercept, {r: w for r, w in zip(rules, model.coefficients.toArray().tolist(), strict=True) if w}


def score_quality(docs: DataFrame, labels: DataFrame, held_out: int = 0, folds: int = 5, sample_rows: int = 20_000, threshold: float = 0.3) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1, higher is better), predicted (1 from ``threshold`` on)."""
    known = write_scratch(statistics(docs), "statistics")
    out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds)) == held_out, F.lit(True))
    marked = labels.select(F.col("doc_id").cast("bigint"), F.col("quality").cast("double").alias("label")).where("label in (0, 1)")
    usable = known.where(~out).join(marked, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    intercept, weights = fit(write_scratch(usable, "labelled"))
    score = compiled(intercept, weights)
    return known.select("doc_id", out.alias("held_out"), score.alias("score")).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
