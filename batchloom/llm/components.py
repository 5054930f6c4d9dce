"""Connected components of a distributed graph by alternating star contraction."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchloom.sources.files import write_scratch


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same components as the edges (a, b) have, as edges from each node to the smallest of its component."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    label = np.arange(len(nodes))
    x, y = at[: len(a)], at[len(a) :]
    while len(x):
        low = np.minimum(label[x], label[y])
        before = label.copy()
        np.minimum.at(label, label[x], low)
        np.minimum.at(label, label[y], low)
        while True:  # nodes point to nodes; follow them to the end
            further = label[label]
            if np.array_equal(further, label):
                break
            label = further
        if np.array_equal(before, label):
            break
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            a, b = forest(np.asarray(batch.column(0)), np.asarray(batch.column(1)))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def _star(edges: DataFrame, large: bool) -> DataFrame:
    if large:
        sides = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        sides = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = sides.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("root"))
    near = sides.join(least, "a")
    if large:
        out = near.where("b > a").select(F.col("b").alias("a"), F.col("root").alias("b"))
    else:
        out = near.select(F.col("b").alias("a"), F.col("root").alias("b")).unionByName(least.select("a", F.col("root").alias("b")))
    return out.where("a != b").distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every node with an edge to a smaller one has a single edge, and none from a larger one."""
    child, parent = F.count_if(F.col("child")), F.count_if(~F.col("child"))
    sides = edges.select(F.col("a").alias("node"), F.lit(True).alias("child")).unionByName(edges.select(F.col("b").alias("node"), F.lit(False).alias("child")))
    nodes = sides.groupBy("node").agg(child.alias("up"), parent.alias("down"))
    return nodes.agg(F.count_if(F.expr("up > 1 or (up > 0 and down > 0)"))).first()[0] == 0


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows (node, root): the smallest node reachable from each node that has an edge, other than itself.

    Edges lead from larger to smaller nodes all the time, so stars are the result as soon as there is nothing else.
    """
    now = edges.select(F.col(a).cast("bigint").alias("a"), F.col(b).cast("bigint").alias("b")).where("a != b")
    now = write_scratch(now.mapInArrow(_local, "a bigint, b bigint"), "edges")
    while not _settled(now):
        now = write_scratch(_star(_star(now, True), False), "edges")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
