"""Hard negatives against brute force, and the bounds against plain scores."""

import math
import random

import numpy as np
import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from batchloom.llm.hard_negatives import Walk, best, mine_hard_negatives, spanning_tree
from batchloom.llm.queries import QUERIES


def brute(rows, positives=5, negatives=3, every=50):
    """``rows``: (vec_id, vector, label)."""
    kept = []
    for d, v, label in rows:
        if d is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            kept.append((d, [math.floor(256 * float(x)) for x in v], label))
    out = []
    for n, (d, v, label) in enumerate(kept):
        if d % every:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), e, other) for m, (e, w, other) in enumerate(kept) if m != n]
        same = sorted((s, e) for s, e, other in scored if other == label)[:positives]
        for s, e in same:
            p = -s
            found = sorted((t, f) for t, f, other in scored if other != label and 50 * p <= 100 * -t <= 95 * p)[:negatives]
            out += [(d, e, r, f, p, -t) for r, (t, f) in enumerate(found, 1)]
    return sorted(out)


def got(df):
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in df.collect())


SCHEMA = "vec_id long, embedding array<float>, label int, row string, block int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)


def clustered(seed, n, dims=6, spread=0.05):
    rng = random.Random(seed)
    centres = [[rng.uniform(-1, 1) for _ in range(dims)] for _ in range(5)]
    rows = []
    for i in range(n):
        centre = rng.choice(centres)
        rows.append((i, [float(np.float32(c + rng.gauss(0, spread))) for c in centre], rng.randrange(3)))
    return rows


ODD = [
    (None, [1.0] * 6, 1), (1000, None, 1), (1050, [1.0] * 6, None), (1100, [1.0, None] + [0.0] * 4, 1), (1150, [float("nan")] * 6, 1),
    (1200, [float("inf")] * 6, 1), (1250, [], 1), (1300, [0.5, 0.5], 2), (1350, [0.0] * 6, 0), (-50, [0.9] * 6, 0), (-1, [0.9] * 6, 1),
    (1400, [-0.3] * 6, 7), (1450, [0.2] * 6, 8), (1451, [-0.2] * 6, 8),
]


@pytest.mark.parametrize(("block", "cell_bytes"), [(1024, 32 << 20), (2, 4000)])
def test_edges(spark, block, cell_bytes):
    rows = clustered(block, 300) + ODD + clustered(9, 60)  # the last repeat ids with other vectors
    rows += rows[:5]
    df = mine_hard_negatives(frame(spark, rows), F.col("vec_id") % 10 == 0, block=block, cell_bytes=cell_bytes)
    assert got(df) == brute(rows, every=10)


def test_a_third_of_all_rows_are_one_vector(spark):
    rows = clustered(4, 200) + [(1000 + i, [0.5] * 6, i % 2) for i in range(100)]
    df = mine_hard_negatives(frame(spark, rows), F.col("vec_id") % 10 == 0, block=16, cell_bytes=2000)
    assert got(df) == brute(rows, every=10)


def test_empty_and_no_anchor(spark):
    rows = frame(spark, clustered(1, 20))
    assert mine_hard_negatives(rows.limit(0), F.lit(True)).count() == 0
    assert mine_hard_negatives(rows, F.lit(False)).count() == 0
    assert mine_hard_negatives(rows, F.lit(None).cast("boolean")).count() == 0


def test_large_components(spark):
    rows = [(i, [float(np.float32(x * 2.0**21)) for x in v], label) for i, v, label in clustered(2, 60)]
    assert got(mine_hard_negatives(frame(spark, rows), F.col("vec_id") % 10 == 0)) == brute(rows, every=10)
    with pytest.raises(PythonException, match="64 bits"):
        mine_hard_negatives(frame(spark, [*rows, (1, [1e30] * 6, 1)]), F.col("vec_id") % 10 == 0).collect()


def test_whole_table(spark, sf_dir):
    rows = []
    for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect():
        label = r.label if r.label is None or r.vec_id % 7 else (r.label + 1) % 10
        rows.append((r.vec_id, r.embedding, label))
    want = brute(rows)
    assert want and got(QUERIES["op11_hard_negative_mining"](spark, sf_dir)) == want


def test_tree_is_a_minimum_spanning_tree():
    rng = np.random.default_rng(1)
    points = rng.integers(-200, 200, (40, 4))
    parent, length = spanning_tree(points)
    every = np.vstack((np.zeros((1, 4)), points))
    distance = np.sqrt(np.square(every[:, None] - every[None]).sum(axis=2))
    edges = sorted((distance[i, j], i, j) for i in range(41) for j in range(i))
    group = list(range(41))
    total = 0.0
    for d, i, j in edges:  # Kruskal
        if group[i] != group[j]:
            total += d
            old, new = group[i], group[j]
            group = [new if g == old else g for g in group]
    assert np.isclose(length.sum(), total)
    assert all(np.isclose(length[i], distance[i + 1, parent[i] + 1]) for i in range(40))


def test_bounds_spare_candidates_and_lose_none():
    rng = np.random.default_rng(2)
    centres = rng.integers(-200, 200, (8, 16))
    points = np.repeat(centres, 50, axis=0) + rng.integers(-6, 7, (400, 16))
    labels = np.sort(rng.integers(0, 4, 400))
    anchors = points[::10]
    parent, length = spanning_tree(anchors)
    for same in (True, False):
        walk = Walk(labels[::10], anchors, parent, length, same)

        def visit(at, score):
            exact = points @ anchors[at]
            least = float(exact.max()) * 0.6
            chosen, found = score(least, least * 1.3)
            own = (labels == labels[::10][at]) == same
            assert (found == exact[chosen]).all()
            assert set(np.flatnonzero(own & (exact >= least) & (exact <= least * 1.3))) <= set(chosen.tolist())

        walk.over(labels, points, visit)
        assert 0 < walk.scored < 0.6 * len(anchors) * sum((labels == x).sum() if same else (labels != x).sum() for x in labels[::10]) / len(anchors)


def test_best_keeps_ties_in_order():
    scores = np.array([3, 5, 5, 1, 5, 5, 2, 0, 0, 0, 0, 0, 0, 0])
    ids = np.arange(14)[::-1]
    assert ids[best(scores, ids, 3)].tolist() == [8, 9, 11]
