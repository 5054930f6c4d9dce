"""Hard negatives of anchor vectors, found with score bounds that run along a spanning tree of the anchors.

Vectors become integers (``floor(scale * x)``) and scores are integer inner products. Anchors are numbered in order of a sign
code, so that similar ones stand together, and every ``BLOCK`` of them are joined by a minimum spanning tree whose root is the
zero vector, which scores 0 with everything. If a parent scores s with a candidate, a child at distance d scores within
s - d * |candidate| and s + d * |candidate|; if the parent's own score is only known to lie within bounds, the bounds widen
by as much. A task walks a tree from its root for a slice of candidates, and only candidates whose bounds overlap what is
looked for are scored.

Two passes bring every block of anchors together with every cell of candidates:

1. Positives: a range open to the top, whose lower end is the lowest of the best same-label scores found so far. The best
   ``positives`` of each anchor in each cell are merged.
2. Negatives: each positive opens a window from ``low`` to ``high`` per cent of its score; other-label candidates whose bounds
   overlap one are scored, and the first ``negatives`` in each window are kept, so that the window's lower end rises.

Anchors and cells are stored tables; a pass deals each block of anchors to every cell, as the stated queries go against all
rows. Cells hold about ``CELL_BYTES`` of vectors, so their number follows the input, and no task holds more than a cell and a
block. A task returns at most a few rows for an anchor and cell. Nothing but numbers of rows reaches the driver.

Rows with a null id, a null label, a null vector or a null or non-finite component take no part. Rows of shorter vectors count
as if filled up with zeros; an empty vector scores 0. Rows are judged one by one: rows that share an id are different rows
with equal rank, and each anchor row has rows of its own in the result. Ties go to the smaller id. An empty table gives no rows.
Other columns are not read. Scores are exact as long as squared lengths stay below 2 ** 63; longer vectors raise an error.
"""

from __future__ import annotations

import functools
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from batchloom.operators.keys import assign_keys
from batchloom.sources.files import write_scratch

BLOCK = 1024
CELL_BYTES = 32 << 20
SLICE = 1 << 14
_SIGNS = 24


def integer_rows(rows: DataFrame, anchor: Column, scale: int) -> DataFrame:
    """The rows that take part: row, vec_id, label, anchor, vector (little-endian 64-bit integers) and its sign code; stored."""
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    taken = rows.select(
        F.col("vec_id").cast("bigint"),
        F.col("label").cast("bigint"),
        F.col("embedding").cast("array<double>").alias("embedding"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
    ).where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & usable)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, codes = [], []
            for own in batch.column("embedding"):
                values = np.floor(float(scale) * np.asarray(own.values, dtype=np.float64))
                if len(values) and np.square(values).sum() >= 2.0**63:
                    raise OverflowError("an inner product of these vectors may not fit into 64 bits")
                vectors.append(values.astype("<i8").tobytes())
                signs = _directions(len(values)) @ values > 0
                codes.append(int(signs @ (1 << np.arange(_SIGNS))))
            kept = [batch.column(c) for c in ("row", "vec_id", "label", "anchor")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(vectors, pa.binary()), pa.array(codes, pa.int32())], ["row", "vec_id", "label", "anchor", "vector", "code"])

    numbered = write_scratch(taken.withColumn("row", F.monotonically_increasing_id()), "vectors")
    return write_scratch(numbered.mapInArrow(write, "row bigint, vec_id bigint, label bigint, anchor boolean, vector binary, code int"), "integers")


@functools.cache
def _directions(dims: int) -> np.ndarray:
    """Fixed random directions; the first components of longer vectors meet the same ones."""
    return np.random.Generator(np.random.PCG64(7)).standard_normal((dims, _SIGNS)).T


def matrix(vectors: list[bytes], dims: int) -> np.ndarray:
    """Rows of integers, shorter ones filled up with zeros."""
    out = np.zeros((len(vectors), dims), dtype=np.int64)
    for i, v in enumerate(vectors):
        own = np.frombuffer(v, dtype="<i8")
        out[i, : len(own)] = own
    return out


def narrow(rows: np.ndarray) -> np.ndarray:
    """The same integers in the smallest type that holds them all."""
    most = int(np.abs(rows).max()) if rows.size else 0
    return rows.astype(next(t for t in (np.int16, np.int32, np.int64) if most <= np.iinfo(t).max))


def scoring(rows: np.ndarray) -> np.ndarray:
    """The rows as doubles where these give exact inner products, else as they are."""
    squares = np.square(rows.astype(np.float64)).sum(axis=1)
    return rows.astype(np.float64) if not len(squares) or squares.max() < 2.0**52 else rows


def spanning_tree(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The parent and the distance to it of each vector, by Prim's algorithm from the zero vector, which is number -1."""
    points = vectors.astype(np.float64)
    n = len(points)
    squares = np.square(points).sum(axis=1)
    near = squares.copy()
    parent = np.full(n, -1, dtype=np.int64)
    length = np.empty(n)
    open_ = np.ones(n, dtype=bool)
    for _ in range(n):
        at = int(np.argmin(np.where(open_, near, np.inf)))
        open_[at] = False
        length[at] = np.sqrt(np.square(points[at] - (points[parent[at]] if parent[at] >= 0 else 0.0)).sum())
        distance = np.maximum(squares + squares[at] - 2 * (points @ points[at]), 0.0)
        closer = open_ & (distance < near)
        near[closer] = distance[closer]
        parent[closer] = at
    return parent, length


def walk_order(parent: np.ndarray) -> list[tuple[int, int, bool]]:
    """(vector, parent, whether this is the parent's last child) from the root on; larger subtrees come last.

    A parent's bounds are dropped before its largest subtree is entered, so that few are held at a time.
    """
    n = len(parent)
    children: list[list[int]] = [[] for _ in range(n + 1)]
    for i, p in enumerate(parent.tolist()):
        children[p].append(i)  # the root is the last entry
    size = np.ones(n + 1, dtype=np.int64)
    order, todo = [], [n]
    while todo:
        at = todo.pop()
        order.append(at)
        todo += children[at]
    for at in reversed(order):
        size[at] += sum(int(size[c]) for c in children[at])
    out, todo = [], [(c, n, c == last) for c, last in _last_is_largest(children[n], size)][::-1]
    while todo:
        at, p, last = todo.pop()
        out.append((at, -1 if p == n else p, last))
        todo += [(c, at, c == end) for c, end in _last_is_largest(children[at], size)][::-1]
    return out


def _last_is_largest(children: list[int], size: np.ndarray) -> list[tuple[int, int]]:
    own = sorted(children, key=lambda c: int(size[c]))
    return [(c, own[-1]) for c in own]


def blocks(anchors: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """The anchors with their block, and one row per block: block, data (rows, ids, labels, integer vectors, parents, distances)."""
    numbered = assign_keys(anchors.select("code", "row", "vec_id", "label", "vector"), ["code", "row"], "n")

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("row")
        stored = table.column("vector").to_pylist()
        vectors = matrix(stored, max(len(v) // 8 for v in stored))
        own = [np.asarray(table.column(c)) for c in ("row", "vec_id", "label")]
        data = pickle.dumps((*own, narrow(vectors), *spanning_tree(vectors)), protocol=5)
        return pa.table({"block": table.column("block").combine_chunks()[:1], "data": pa.array([data], pa.binary())})

    dealt = numbered.withColumn("block", F.expr(f"(n - 1) div {size}"))
    return dealt.select("block", "row"), dealt.groupBy("block").applyInArrow(build, "block bigint, data binary")


def cells(rows: DataFrame, number: int) -> DataFrame:
    """The candidates in ``number`` parts of nearly equal size, one row each: cell, data."""

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by([("label", "ascending"), ("row", "ascending")])
        own = [np.asarray(table.column(c)) for c in ("row", "vec_id", "label")]
        stored = table.column("vector").to_pylist()
        data = pickle.dumps((*own, narrow(matrix(stored, max(len(v) // 8 for v in stored)))), protocol=5)
        return pa.table({"cell": table.column("cell").combine_chunks()[:1], "data": pa.array([data], pa.binary())})

    dealt = rows.select(F.pmod(F.xxhash64("row"), F.lit(number)).cast("int").alias("cell"), "row", "vec_id", "label", "vector")
    return dealt.groupBy("cell").applyInArrow(build, "cell int, data binary")


def meet(blocks_: DataFrame, cells_: DataFrame, number: int) -> DataFrame:
    """Every block of anchors with every cell of candidates, the cells dealt out evenly whatever their bytes."""
    everywhere = blocks_.withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(number - 1)))).withColumnRenamed("data", "anchors")
    dealt = cells_.withColumnRenamed("data", "candidates").repartition(2 * number, "cell")
    return dealt.join(everywhere.repartition(2 * number, "cell"), "cell")


class Walk:
    """The walk of one tree over slices of candidates, which are in order of their labels.

    ``visit(at, score)`` is called for each anchor in order. ``score(least, most)`` scores the candidates whose bounds
    overlap that range and that have the anchor's label (or, with ``same`` unset, another one), and gives their places and scores.
    """

    def __init__(self, labels: np.ndarray, vectors: np.ndarray, parent: np.ndarray, length: np.ndarray, same: bool):
        self.labels, self.vectors, self.length, self.same = labels, vectors, length, same
        self.order = walk_order(parent)
        self.inner = set(parent.tolist())
        self.scored = 0

    def over(self, labels: np.ndarray, candidates: np.ndarray, visit) -> None:
        anchors, values = scoring(self.vectors), scoring(candidates)
        if anchors.dtype != values.dtype:
            anchors, values = self.vectors, candidates
        norms = np.sqrt(np.square(candidates.astype(np.float64)).sum(axis=1))
        first, last = (np.searchsorted(labels, self.labels, side=side) for side in ("left", "right"))
        bounds: dict[int, tuple[np.ndarray, np.ndarray]] = {-1: (np.zeros(len(values)), np.zeros(len(values)))}
        for at, parent, is_last in self.order:
            low, high = bounds.pop(parent) if is_last else bounds[parent]
            # What rounding can add to distances, norms and scores is far below these additions.
            reach = (self.length[at] * (1 + 1e-9) + 1e-6) * norms + 0.5
            low, high = low - reach, high + reach
            a, b = int(first[at]), int(last[at])

            def score(least: float, most: float) -> tuple[np.ndarray, np.ndarray]:
                if self.same:
                    chosen = np.flatnonzero((high[a:b] >= least) & (low[a:b] <= most)) + a
                else:
                    overlap = (high >= least) & (low <= most)
                    overlap[a:b] = False
                    chosen = np.flatnonzero(overlap)
                found = values[chosen] @ anchors[at]
                low[chosen] = high[chosen] = found
                self.scored += len(chosen)
                return chosen, found.astype(np.int64)

            visit(at, score)
            if at in self.inner:
                bounds[at] = low, high


def best(scores: np.ndarray, ids: np.ndarray, number: int) -> np.ndarray:
    """The first of these rows: higher scores first, ties by smaller ids."""
    if len(scores) > 4 * number:  # ties with the last one stay in
        least = np.partition(scores, len(scores) - number)[len(scores) - number]
        near = np.flatnonzero(scores >= least)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near]))[:number]]


def _opened(anchors: bytes, candidates: bytes) -> tuple[list, list]:
    """A block (rows, ids, labels, vectors, parents, distances) and a cell (rows, ids, labels, vectors), equally wide."""
    block, cell = list(pickle.loads(anchors)), list(pickle.loads(candidates))
    dims = max(block[3].shape[1], cell[3].shape[1])
    for own in (block, cell):
        if own[3].shape[1] < dims:
            own[3] = np.pad(own[3], ((0, 0), (0, dims - own[3].shape[1])))
    return block, cell


def _slices(cell: list):
    rows, ids, labels, vectors = cell
    for start in range(0, len(rows), SLICE):
        part = slice(start, start + SLICE)
        yield rows[part], ids[part], labels[part], vectors[part].astype(np.int64)


_NONE = np.empty(0, dtype=np.int64)


def find_positives(anchors: bytes, candidates: bytes, number: int) -> tuple[list[np.ndarray], int]:
    """For one block and cell: anchor row, anchor id, candidate id, score of the best of the same label; scores worked out."""
    (rows, ids, labels, vectors, parent, length), cell = _opened(anchors, candidates)
    held = [(_NONE, _NONE)] * len(rows)
    walk = Walk(labels, vectors.astype(np.int64), parent, length, same=True)
    for own_rows, own_ids, own_labels, values in _slices(cell):

        def visit(at, score):
            known, known_ids = held[at]
            chosen, found = score(float(known.min()) if len(known) == number else -np.inf, np.inf)
            other = own_rows[chosen] != rows[at]
            scores, names = np.concatenate((known, found[other])), np.concatenate((known_ids, own_ids[chosen[other]]))
            top = best(scores, names, number)
            held[at] = scores[top], names[top]

        walk.over(own_labels, values, visit)
    times = [len(scores) for scores, _ in held]
    return [np.repeat(rows, times), np.repeat(ids, times), np.concatenate([n for _, n in held]), np.concatenate([x for x, _ in held])], walk.scored


def find_negatives(anchors: bytes, candidates: bytes, windows: bytes, number: int) -> tuple[list[np.ndarray], int]:
    """For one block and cell: anchor row, number of the window, candidate id, score of the first in each window; scores worked out.

    ``windows``: anchor row, number, least and largest score of each window of the block's anchors.
    """
    (rows, _, labels, vectors, parent, length), cell = _opened(anchors, candidates)
    w_row, w_number, w_least, w_most = pickle.loads(windows)
    by_row: dict[int, list[int]] = {}
    for w, row in enumerate(w_row.tolist()):
        by_row.setdefault(row, []).append(w)
    held = [(_NONE, _NONE)] * len(w_row)
    walk = Walk(labels, vectors.astype(np.int64), parent, length, same=False)
    for _, own_ids, own_labels, values in _slices(cell):

        def visit(at, score):
            own = by_row.get(int(rows[at]))
            if own is None:
                return
            # A window that holds enough needs no scores below its last one.
            least = [int(held[w][0].min()) if len(held[w][0]) == number else int(w_least[w]) for w in own]
            most = [int(w_most[w]) for w in own]
            chosen, found = score(float(min(least)), float(max(most)))
            for w, low, high in zip(own, least, most, strict=True):
                inside = np.flatnonzero((found >= low) & (found <= high))
                scores, names = np.concatenate((held[w][0], found[inside])), np.concatenate((held[w][1], own_ids[chosen[inside]]))
                top = best(scores, names, number)
                held[w] = scores[top], names[top]

        walk.over(own_labels, values, visit)
    times = [len(scores) for scores, _ in held]
    return [np.repeat(w_row, times), np.repeat(w_number, times), np.concatenate([_NONE, *(n for _, n in held)]), np.concatenate([_NONE, *(x for x, _ in held)])], walk.scored


def _pass(pairs: DataFrame, find, names: list[str]) -> DataFrame:
    """``find`` on every pair of a block and a cell; the rows of a pair are few."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                columns, _ = find(*(batch.column(c)[i].as_py() for c in ("anchors", "candidates", *(["windows"] if "windows" in batch.schema.names else []))))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return pairs.mapInArrow(run, ", ".join(f"{n} bigint" for n in names))


def _first(rows: DataFrame, keys: list[str], score: str, tie: str, number: int) -> DataFrame:
    """The first rows of each key with their rank from 1; each cell has sent at most ``number`` of a key."""
    order = Window.partitionBy(*keys).orderBy(F.col(score).desc(), tie)
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= number)


def mine_hard_negatives(
    rows: DataFrame,
    anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    scale: int = 256,
    block: int = BLOCK,
    cell_bytes: int = CELL_BYTES,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` have vec_id, embedding and label; ``anchor`` is a condition on them. ``low`` and ``high`` are per cent of the
    positive's score.
    """
    spark = rows.sparkSession
    stored = integer_rows(rows, anchor, scale)
    size = stored.agg(F.count("*").alias("n"), F.sum(F.length("vector") + 24).alias("bytes")).first()
    if not size["n"]:
        return spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint")
    # Small inputs have more cells, so that every core gets some.
    number = max(-(-size["bytes"] // cell_bytes), min(4 * spark.sparkContext.defaultParallelism, -(-size["n"] // 1024)))
    parts = write_scratch(cells(stored, number), "cells")
    anchors, built = blocks(stored.where("anchor"), block)
    trees = write_scratch(built, "trees")

    found = _pass(meet(trees, parts, number), lambda a, c: find_positives(a, c, positives), ["row", "anchor_id", "positive_id", "positive_score"])
    chosen = _first(found, ["row", "anchor_id"], "positive_score", "positive_id", positives).withColumnRenamed("rank", "window")
    # The least and the largest integer score in the window; there is none where the positive's score is negative.
    def per_cent(n: int, add: int) -> str:
        return f"(positive_score div 100) * {n} + ((positive_score % 100) * {n} + {add}) div 100"

    windows = chosen.where(F.col("positive_score") >= 0).withColumns({"least": F.expr(per_cent(low, 99)), "most": F.expr(per_cent(high, 0))})
    opened = write_scratch(windows, "windows")

    def bundle(table: pa.Table) -> pa.Table:
        data = pickle.dumps(tuple(np.asarray(table.column(c)).astype(np.int64) for c in ("row", "window", "least", "most")), protocol=5)
        return pa.table({"block": table.column("block").combine_chunks()[:1], "windows": pa.array([data], pa.binary())})

    of_block = anchors.join(opened, "row").select("block", "row", "window", "least", "most")
    bundles = of_block.groupBy("block").applyInArrow(bundle, "block bigint, windows binary")  # at most block x positives rows
    # Anchors without a window have no part in the second pass, but lead to others.
    ready = trees.join(bundles, "block")
    negative = _pass(meet(ready, parts, number), lambda a, c, w: find_negatives(a, c, w, negatives), ["row", "window", "negative_id", "negative_score"])
    ranked = _first(negative, ["row", "window"], "negative_score", "negative_id", negatives)
    named = opened.select("row", F.col("window").cast("bigint").alias("window"), "anchor_id", "positive_id", "positive_score")
    return ranked.join(named, ["row", "window"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")

