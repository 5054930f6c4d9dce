"""How five document filters interact, for every order in which they can be applied, by truth-table survival words.

A document is a 32-bit word: bit S is set if it survives the set S of filters, the filters being the bits of S. Its failures
choose the word from a table of 32. Tasks count each of the 32 bit positions over the words of a part and label, with
carry-save adders: three words become a word of sums and a word of carries, planes of twice the weight take the carries, and
only the last planes are counted bit by bit. Only 32 counts for each part and label leave a task. All orders, steps and shares
follow from these counts of survivors: what a step keeps is the survivors of the filters so far.

Filters (words are runs of bytes other than space, tab, newline, vertical tab, form feed and carriage return): A fewer than 50
words; B fewer different words than 65 in a hundred; C more than 5 characters A-Z in a hundred; D any of ``#$%&*|``; E the same text as
a row with a smaller ``doc_id`` anywhere in the table, whatever becomes of that row. Texts are compared by their SHA-256.

Null texts are empty. A null ``doc_id`` counts as larger than all others; rows with one id are not smaller than each other, so
that repeated rows of one document do not fail E against themselves. A null ``source`` is the part ``''``. A document has a label if any
row of ``labels`` for its id says so; rows without an id have none. A table without rows has no parts. Other columns are not
read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchloom.llm.texts import binaries
from batchloom.sources.files import write_scratch

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
_DUPLICATE = 1 << FILTERS.index("E")
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_CONTINUES = bytes(range(0x80, 0xC0))
_SYMBOLS = b"#$%&*|"
_LANES = 32

#: The survival word of each set of failures: bit S is set where S and the failures share no filter.
WORDS = np.array([sum(1 << s for s in range(SUBSETS) if not s & failed) for failed in range(SUBSETS)], dtype=np.uint32)


def own_failures(text: bytes) -> int:
    """The filters A to D that a text fails, as bits."""
    words = text.split()
    points = len(text.translate(None, _CONTINUES))
    upper = len(text) - len(text.translate(None, _UPPER))
    return (
        (len(words) < 50)
        | (100 * len(set(words)) < 65 * len(words)) << 1
        | (100 * upper > 5 * points) << 2
        | (len(text.translate(None, _SYMBOLS)) < len(text)) << 3
    )


def positional_popcount(words: np.ndarray) -> np.ndarray:
    """How many words have each bit set, by carry-save addition of rows of words."""
    out = np.zeros(32, dtype=np.int64)
    rows = np.zeros(-(-len(words) // _LANES) * _LANES, dtype="<u4")
    rows[: len(words)] = words
    plane, weight = rows.reshape(-1, _LANES), 1
    while len(plane):
        carried = []
        while len(plane) > 2:
            n = len(plane) // 3 * 3
            a, b, c = plane[0:n:3], plane[1:n:3], plane[2:n:3]
            half = a ^ b
            carried.append((a & b) | (half & c))
            plane = np.concatenate((half ^ c, plane[n:]))
        bits = np.unpackbits(np.ascontiguousarray(plane).view(np.uint8), bitorder="little")
        out += weight * bits.reshape(-1, 32).sum(axis=0, dtype=np.int64)
        plane = np.concatenate(carried) if carried else plane[:0]
        weight *= 2
    return out


def weighted_popcount(words: np.ndarray, times: np.ndarray) -> np.ndarray:
    """``positional_popcount`` of words that stand several times each, one binary digit of the times after another."""
    out = np.zeros(32, dtype=np.int64)
    digit = 0
    while (times >> digit).any():
        out += positional_popcount(words[(times >> digit & 1) > 0]) << digit
        digit += 1
    return out


def failures(docs: DataFrame) -> DataFrame:
    """One row per different (text, id, part): part, doc_id, failed (all five filters as bits), n (rows).

    Only digests are shuffled. The smallest id of each digest is combined before its shuffle and joined back by digest and id
    together, so that the copies of a text spread over the tasks.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = binaries(batch.column("text"))
            digests = pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())
            failed = pa.array([own_failures(t) for t in texts], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("part"), digests, failed], ["doc_id", "part", "digest", "failed"])

    source = docs.select(
        F.col("doc_id").cast("bigint"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), F.col("text").cast("string")
    )
    marks = write_scratch(source.mapInArrow(read, "doc_id bigint, part string, digest binary, failed int"), "audit-marks")
    rows = marks.groupBy("digest", "doc_id", "part", "failed").agg(F.count("*").alias("n")).alias("r")
    first = marks.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True)).alias("f")
    same = (F.col("r.digest") == F.col("f.digest")) & F.col("r.doc_id").eqNullSafe(F.col("f.doc_id"))
    failed = F.col("failed") + F.when(F.col("first").isNull(), F.lit(_DUPLICATE)).otherwise(F.lit(0))
    return rows.join(first, same, "left").select("r.doc_id", "r.digest", "part", failed.alias("failed"), "n")


def with_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows with ``good`` and ``toxic``; rows without an id are dealt out by their digest, as they match nothing."""
    said = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("bigint").alias("doc_id"), F.lit(0).cast("bigint").alias("spread"))
    said = said.agg(*[F.coalesce(F.max(F.col(c) == 1), F.lit(False)).alias(a) for c, a in (("quality", "good"), ("toxic", "toxic"))])
    spread = F.when(F.col("doc_id").isNull(), F.xxhash64("digest")).otherwise(F.lit(0)).cast("bigint")
    joined = rows.withColumn("spread", spread).join(said, ["doc_id", "spread"], "left")
    return joined.select("part", "failed", "n", *[F.coalesce(F.col(c), F.lit(False)).alias(c) for c in ("good", "toxic")])


def survivors(rows: DataFrame) -> DataFrame:
    """One row per part and set of filters: the documents that survive it, and those among them with each label."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = WORDS[np.asarray(batch.column("failed"))]
            times = np.asarray(batch.column("n"))
            every = np.ones(len(words), dtype=bool)
            classes = [every, *(np.asarray(batch.column(c).cast(pa.uint8())).astype(bool) for c in ("good", "toxic"))]
            parts = batch.column("part").dictionary_encode()
            codes = np.asarray(parts.indices)
            order = np.argsort(codes, kind="stable")
            bounds = np.searchsorted(codes[order], np.arange(len(parts.dictionary) + 1))
            counts = np.empty((3, len(parts.dictionary), SUBSETS), dtype=np.int64)
            for p in range(len(parts.dictionary)):
                own = order[bounds[p] : bounds[p + 1]]
                for c, label in enumerate(classes):
                    chosen = own[label[own]]
                    counts[c, p] = weighted_popcount(words[chosen], times[chosen])
            names = pa.array(np.repeat(np.arange(len(parts.dictionary)), SUBSETS))
            yield pa.RecordBatch.from_arrays(
                [parts.dictionary.take(names), pa.array(np.tile(np.arange(SUBSETS, dtype=np.int32), len(parts.dictionary))), *map(pa.array, counts.reshape(3, -1))],
                ["part", "subset", "kept", "good", "toxic"],
            )

    counted = rows.select("part", "failed", "n", "good", "toxic").mapInArrow(count, "part string, subset int, kept bigint, good bigint, toxic bigint")
    return counted.groupBy("part", "subset").agg(*[F.sum(c).alias(c) for c in ("kept", "good", "toxic")])


def _steps() -> Column:
    """All orders and steps with the sets of filters before and after the step."""
    rows = []
    for order in permutations(FILTERS):
        before = 0
        for step, letter in enumerate(order, 1):
            own = 1 << FILTERS.index(letter)
            rows.append(f"('{''.join(order)}', {step}, {before}, {before | own}, {own})")
            before |= own
    array = "array(" + ", ".join(f"struct{r}" for r in rows) + ")"
    return F.expr(array).cast("array<struct<filter_order: string, step: int, before: int, after: int, own: int>>")


def _shapley(letter: int) -> Column:
    """What a filter removes in all orders together; its predecessors are S in |S|! (4 - |S|)! of them."""
    own = 1 << letter
    terms = []
    for s in range(SUBSETS):
        if not s & own:
            orders = factorial(s.bit_count()) * factorial(len(FILTERS) - 1 - s.bit_count())
            terms.append(F.lit(orders) * (F.col("by_set")[s]["kept"] - F.col("by_set")[s | own]["kept"]))
    return sum(terms[1:], terms[0])


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step; its filter is the order's letter at the step.

    kept: documents left after the step. removed: by this step. redundant: those that fail its filter but were removed earlier.
    unique_fails: those that fail its filter only. good_lost, toxic_lost: removed here with that label. shapley: what the filter
    removes in all orders together.
    """
    counts = survivors(with_labels(failures(docs), labels))
    by_part = counts.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("subset", "kept", "good", "toxic"))).alias("by_set"))  # 32 rows each
    shares = by_part.select("part", "by_set", F.array(*[_shapley(i) for i in range(len(FILTERS))]).alias("shares"))
    rows = shares.select("part", "by_set", "shares", F.explode(_steps()).alias("s"))

    def left(at: Column | int, column: str = "kept") -> Column:
        return F.col("by_set")[at][column]

    before, after, own, every = F.col("s.before"), F.col("s.after"), F.col("s.own"), SUBSETS - 1
    removed = left(before) - left(after)
    others = F.lit(every) - own
    return rows.select(
        "part",
        F.col("s.filter_order").alias("filter_order"),
        F.col("s.step").alias("step"),
        left(after).alias("kept"),
        removed.alias("removed"),
        (left(0) - left(own) - removed).alias("redundant"),
        (left(others) - left(every)).alias("unique_fails"),
        (left(before, "good") - left(after, "good")).alias("good_lost"),
        (left(before, "toxic") - left(after, "toxic")).alias("toxic_lost"),
        F.col("shares")[F.round(F.log2(own)).cast("int")].alias("shapley"),
    )
