"""Packing of documents into windows of nearly no padding, by Karmarkar-Karp multiway differencing.

A task encodes its documents, cuts whole windows off the front of long ones and gathers what is left of each, up to
``GROUP`` rests at a time. The rests of a group are dealt to windows by differencing: every rest begins as a partial
partition of its own; the two partial partitions with the largest imbalances are merged so that the imbalances oppose each
other, the fullest windows of one meeting the emptiest of the other, until one partition is left. Its windows are nearly equal.
If one of them exceeds the capacity, the number of windows rises and the rests are dealt again.

Near-equal windows still lack a few tokens each. The emptiest windows, as many as the group's tokens do not need, are taken
apart and their tokens close the gaps of the others, so that these are full. Less than one window of tokens is left; it
is cut into sequences whose lengths are powers of two, which are not padded.

Groups never meet: nothing is shuffled, and nothing but rows leaves a task. The numbers of sequences hold the number of the
task and are different in all tasks. Null texts are empty: such a document is the end token alone. A null ``doc_id``
stays null, repeated rows are documents of their own, an empty table gives no rows, and other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchloom.llm.texts import pieces
from batchloom.llm.tokens import encoder

GROUP = 1024
PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def difference(lengths: np.ndarray, k: int) -> list[list[int]]:
    """The items of each of ``k`` windows with nearly equal sums, fullest first; windows may be empty.

    A partial partition is the sums of its windows that are not empty, the largest first, with a node of each. A node is an
    item, or two nodes that share a window.
    """
    lengths = np.asarray(lengths, dtype=np.int64)
    if not len(lengths):
        return [[] for _ in range(k)]
    left: list[int] = []
    right: list[int] = []
    heap = [(-n, i, np.array([n]), np.array([i])) for i, n in enumerate(lengths.tolist())]
    heapify(heap)
    number = len(lengths)
    while len(heap) > 1:
        _, _, a, a_nodes = heappop(heap)
        _, _, b, b_nodes = heappop(heap)
        shared = max(0, len(a) + len(b) - k)  # windows that hold something on both sides
        sums, nodes = np.concatenate((a, b[: len(b) - shared])), np.concatenate((a_nodes, b_nodes[: len(b) - shared]))
        if shared:
            sums[len(a) - shared : len(a)] += b[len(b) - shared :][::-1]
            first = len(lengths) + len(left)
            left += a_nodes[len(a) - shared :].tolist()
            right += b_nodes[len(b) - shared :][::-1].tolist()
            nodes[len(a) - shared : len(a)] = np.arange(first, first + shared)
        order = np.argsort(-sums, kind="stable")
        sums, nodes = sums[order], nodes[order]
        spread = int(sums[0]) - (int(sums[-1]) if len(sums) == k else 0)
        heappush(heap, (-spread, number, sums, nodes))
        number += 1
    out = []
    for node in heap[0][3].tolist():
        items, todo = [], [node]
        while todo:
            at = todo.pop()
            if at < len(lengths):
                items.append(at)
            else:
                todo += [left[at - len(lengths)], right[at - len(lengths)]]
        out.append(items)
    return out + [[] for _ in range(k - len(out))]


def windows(lengths: np.ndarray, size: int) -> list[list[int]]:
    """The items of near-equal windows within the capacity, as few as differencing finds; no item is longer than ``size``."""
    lengths = np.asarray(lengths, dtype=np.int64)
    k = -(-int(lengths.sum()) // size)
    while True:
        dealt = difference(lengths, k)
        most = max((int(lengths[w].sum()) for w in dealt if w), default=0)
        if most <= size:
            return dealt
        k = max(k + 1, k * most // size)


def level(dealt: list[list[int]], lengths: np.ndarray, size: int) -> list[list[tuple[int, int, int]]]:
    """Sequences as lists of (item, first, length): full ones, and the rest in lengths that are powers of two."""
    sums = np.array([int(lengths[w].sum()) for w in dealt], dtype=np.int64)
    total = int(sums.sum())
    order = np.argsort(-sums, kind="stable").tolist()
    full = total // size
    pool = [(item, 0, int(lengths[item])) for w in order[full:] for item in dealt[w]][::-1]

    def take(wanted: int) -> list[tuple[int, int, int]]:
        got = []
        while wanted:
            item, first, n = pool.pop()
            if n > wanted:
                pool.append((item, first + wanted, n - wanted))
                n = wanted
            got.append((item, first, n))
            wanted -= n
        return got

    out = [[*((item, 0, int(lengths[item])) for item in dealt[w]), *take(size - int(sums[w]))] for w in order[:full]]
    rest = total - full * size
    return out + [take(1 << bit) for bit in range(rest.bit_length() - 1, -1, -1) if rest >> bit & 1]


def pack_evenly(docs: DataFrame, tokenizer: str, size: int = 1024, end_id: int = 0, keep_ids: bool = False) -> DataFrame:
    """Every piece of every document with its sequence and its offset there.

    Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and with ``keep_ids`` the ids as little-endian
    unsigned 32-bit integers.
    """
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *(["ids"] if keep_ids else [])]
    types = [*[pa.int64()] * 7, pa.binary()][: len(names)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 40
        encode = encoder(tokenizer)
        end = np.array([end_id], dtype="<u4")
        rests: list[tuple] = []  # doc_id, start, tokens of the document, ids
        rows: list[tuple] = []

        def write(doc, start: int, tokens: int, ids: np.ndarray, offset: int) -> None:
            data = ids.tobytes()
            rows.append((doc, start, len(ids), zlib.crc32(data), tokens, sequence, offset, data)[: len(names)])

        def flush() -> None:
            nonlocal sequence
            lengths = np.array([len(r[3]) for r in rests], dtype=np.int64)
            for own in level(windows(lengths, size), lengths, size):
                offset = 0
                for item, first, n in own:
                    doc, start, tokens, ids = rests[item]
                    write(doc, start + first, tokens, ids[first : first + n], offset)
                    offset += n
                sequence += 1
            rests.clear()

        def batch_of_rows() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        for batch in batches:
            for part in pieces(batch, limit=1 << 23):
                ids, bounds = encode.ids(part.column("text"))
                for doc, low, high in zip(part.column("doc_id").to_pylist(), bounds[:-1], bounds[1:], strict=True):
                    own = np.concatenate((ids[low:high], end))
                    whole = len(own) // size * size
                    for start in range(0, whole, size):
                        write(doc, start, len(own), own[start : start + size], 0)
                        sequence += 1
                    if whole < len(own):
                        rests.append((doc, whole, len(own), own[whole:]))
                    if len(rests) == GROUP:
                        flush()
                yield batch_of_rows()
            pa.default_memory_pool().release_unused()  # workers live on with other stages' tasks
        if rests:
            flush()
        yield batch_of_rows()

    source = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return source.mapInArrow(run, PIECES + (", ids binary" if keep_ids else ""))
