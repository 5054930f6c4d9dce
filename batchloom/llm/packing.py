"""Packing of documents into sequences of a fixed number of tokens, by exact-complement hashing and then best fit.

1. Tasks encode the texts and cut each document into pieces. Every piece is numbered within its task and length, so that
   tasks never have to meet to number the pieces of one length, however many of them there are.
2. Only the number of pieces of each length reaches the driver: at most ``size`` numbers, whatever the input. From these
   availability counts the driver makes a plan, a list of (lengths that share a sequence, how many such sequences). For
   the longest length left, the gap is looked up among single lengths, sums of two and sums of three; combinations that
   fill it exactly are consumed as often as the counts allow. What is left goes by best fit, longest first. Every entry
   uses up at least one length, so the plan has at most ``2 * size`` entries.
3. Tasks look up the place of each piece in the plan by its length and its number among the pieces of that length.

Null texts are empty: such a document is the end token alone. A null ``doc_id`` stays null, repeated rows are documents of
their own, an empty table gives no rows, and other columns of the input are not read. A longer document is cut so that
all pieces but the first have the full length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from batchloom.llm.texts import pieces
from batchloom.llm.tokens import encoder
from batchloom.sources.files import write_scratch

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, task bigint, place bigint"


def tokenize(docs: DataFrame, tokenizer: str, size: int, end_id: int, keep_ids: bool = False) -> DataFrame:
    """The pieces of all documents, each with its task and its number among the task's pieces of that length."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        encode = encoder(tokenizer)
        seen = np.zeros(size + 1, dtype=np.int64)
        end = np.array([end_id], dtype="<u4")
        for batch in batches:
            for part in pieces(batch, limit=1 << 23):
                ids, bounds = encode.ids(part.column("text"))
                rows: list[tuple] = []
                for doc, low, high in zip(part.column("doc_id").to_pylist(), bounds[:-1], bounds[1:], strict=True):
                    own = np.concatenate((ids[low:high], end))
                    first = len(own) % size or size
                    cuts = [0, *range(first, len(own) + 1, size)]
                    for n, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                        data = own[a:b].tobytes()
                        rows.append((doc, n, a, b - a, zlib.crc32(data), task, int(seen[b - a]), data if keep_ids else None))
                        seen[b - a] += 1
                columns = list(zip(*rows, strict=True))
                types = [pa.int64(), pa.int32(), *[pa.int64()] * 5, pa.binary()]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "place", "ids"]
                width = 8 if keep_ids else 7
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns[:width], types, strict=False)], names[:width])
            pa.default_memory_pool().release_unused()  # workers live on with other stages' tasks

    source = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return source.mapInArrow(cut, PIECES + (", ids binary" if keep_ids else ""))


def _exact(left: np.ndarray, gap: int) -> tuple[int, ...] | None:
    """One, two or three available lengths that add up to ``gap``, the longest first."""
    if left[gap]:
        return (gap,)
    have = left[: gap + 1] > 0
    b = np.flatnonzero(have[(gap + 1) // 2 : gap]) + (gap + 1) // 2
    b = b[have[gap - b] & ((2 * b != gap) | (left[b] > 1))]
    if len(b):
        return int(b[-1]), int(gap - b[-1])
    for a in np.flatnonzero(have[(gap + 2) // 3 :])[::-1] + (gap + 2) // 3:
        rest = gap - a
        if rest < 2:
            continue
        b = np.arange((rest + 1) // 2, min(a, rest - 1) + 1)
        b = b[have[b] & have[rest - b]]
        for x in b[::-1]:
            three = (int(a), int(x), int(rest - x))
            if all(left[v] >= three.count(v) for v in three):
                return three
    return None


def plan(counts: np.ndarray, size: int) -> list[tuple[tuple[int, ...], int]]:
    """Which lengths share a sequence, and how often; ``counts[n]`` pieces have n tokens."""
    left = counts.astype(np.int64).copy()
    out: list[tuple[tuple[int, ...], int]] = []

    def use(lengths: tuple[int, ...]) -> None:
        times = min(int(left[v]) // lengths.count(v) for v in set(lengths))
        for v in lengths:
            left[v] -= times
        out.append((lengths, times))

    if left[size]:
        use((size,))
    for longest in range(size - 1, 0, -1):
        while left[longest]:
            left[longest] -= 1
            gap = size - longest
            fill = _exact(left, gap)
            left[longest] += 1
            if fill is None:
                break
            use((longest, *fill))
    for longest in range(size - 1, 0, -1):
        while left[longest]:
            left[longest] -= 1
            taken = [longest]
            gap = size - longest
            while gap and len(fit := np.flatnonzero(left[1 : gap + 1])):
                taken.append(int(fit[-1]) + 1)
                left[taken[-1]] -= 1
                gap -= taken[-1]
            for v in taken:
                left[v] += 1
            use(tuple(taken))
    return out


def places(planned: list[tuple[tuple[int, ...], int]], size: int) -> tuple[np.ndarray, ...]:
    """The plan as ranges of piece numbers: sorted keys (length, first number), first sequence and offset of each range."""
    rows = []
    taken = np.zeros(size + 1, dtype=np.int64)
    sequence = 0
    for lengths, times in planned:
        offset = 0
        for v in lengths:
            rows.append((v, int(taken[v]), sequence, offset))
            taken[v] += times
            offset += v
        sequence += times
    rows.sort()
    length, first, base, offset = (np.array(c, dtype=np.int64) for c in (zip(*rows, strict=True) if rows else ([], [], [], [])))
    return length, first, base, offset


def pack(docs: DataFrame, tokenizer: str, size: int = 1024, end_id: int = 2, keep_ids: bool = False) -> DataFrame:
    """Every piece of every document with its sequence and its offset there.

    Columns: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and with ``keep_ids`` the ids as little-endian
    unsigned 32-bit integers.
    """
    cut = write_scratch(tokenize(docs, tokenizer, size, end_id, keep_ids), "pieces")
    per_task = cut.groupBy("task", "length").agg(F.count("*").alias("n"))
    totals = np.zeros(size + 1, dtype=np.int64)
    for row in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``size`` rows
        totals[row["length"]] = row["n"]
    length, first, base, offset = places(plan(totals, size), size)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_task.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    extra = ["ids"] if keep_ids else []

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = np.searchsorted(length, np.arange(size + 2))
        for batch in batches:
            own, number = (np.asarray(batch.column(c)) for c in ("length", "number"))
            at = np.empty(len(own), dtype=np.int64)
            for v in np.unique(own):
                rows = np.flatnonzero(own == v)
                low, high = starts[v], starts[v + 1]
                at[rows] = low + np.searchsorted(first[low:high], number[rows], side="right") - 1
            kept = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32", *extra)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", *extra, "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(base[at] + number - first[at]), pa.array(offset[at])], names)

    numbered = cut.join(bases, ["task", "length"]).withColumn("number", F.col("before") + F.col("place"))
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, " + ("ids binary, " if keep_ids else "")
    return numbered.select("doc_id", "piece", "start", "length", "ids_crc32", *extra, "number").mapInArrow(
        assign, schema + "sequence_id bigint, offset bigint"
    )
