"""Connected components against a plain union of sets."""

import random

import numpy as np
import pytest

from batchloom.llm.components import _settled, components, forest


def plain(edges):
    groups = {}
    for a, b in edges:
        merged = groups.get(a, {a}) | groups.get(b, {b})
        for x in merged:
            groups[x] = merged
    return {x: min(g) for x, g in groups.items() if min(g) != x}


def graphs():
    rng = random.Random(5)
    chain = [(i, i + 1) for i in range(300)]
    rng.shuffle(chain)
    star = [(1000, 1000 + i) for i in range(1, 200)]
    noise = [(rng.randint(2000, 2400), rng.randint(2000, 2400)) for _ in range(250)]
    return {"chain": chain, "all": chain + star + noise + [(-5, 7), (9, 9)], "repeated": [(1, 2)] * 5 + [(2, 1)]}


@pytest.mark.parametrize("name", ["chain", "all", "repeated"])
def test_distributed(spark, name):
    edges = graphs()[name]
    df = spark.createDataFrame(edges, "a long, b long").repartition(6)
    assert {r.node: r.root for r in components(df).collect()} == plain([e for e in edges if e[0] != e[1]])


def test_one_row_for_each_node(spark):
    """Stars that several tasks find each for itself, with repeated edges, are still joined."""
    edges = [(5, 1), (6, 1), (5, 1), (1, 5), (7, 6)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(5)
    assert sorted(map(tuple, components(df).collect())) == [(5, 1), (6, 1), (7, 1)]


@pytest.mark.parametrize(
    "edges, stars",
    [([], True), ([(5, 1), (6, 1), (9, 8)], True), ([(5, 1), (5, 1)], False), ([(5, 1), (5, 2)], False), ([(5, 3), (3, 1)], False)],
)
def test_settled(spark, edges, stars):
    assert _settled(spark.createDataFrame(edges, "a long, b long")) is stars


def test_none(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_forest():
    edges = graphs()["all"]
    a, b = forest(np.array([x for x, _ in edges]), np.array([y for _, y in edges]))
    assert dict(zip(a.tolist(), b.tolist())) == plain(edges)
