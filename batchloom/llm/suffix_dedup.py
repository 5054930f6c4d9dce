"""Removal of repeated byte strings by a depth-limited radix sort of suffixes.

Only the first ``size`` bytes of a suffix matter, so suffixes are sorted by digits from the most significant one down and no
further than that depth; after the last pass, equal groups are exactly the repeated strings. The first digit is the anchor
of the suffix's first ``size`` bytes (see ``phrases``): it deals suffixes out to buckets, and suffixes alone with their
anchor are dropped at once. Inside a bucket the remaining digits are eight bytes each; a suffix leaves as soon as it is
alone in its group.

A byte is removed if a string of ``size`` bytes that covers it also starts in a document with a smaller ``doc_id``; strings
are judged on the input, overlaps count. Null texts are empty, texts shorter than ``size`` stay whole. A null ``doc_id``
counts as larger than all others and stays null. Rows with the same ``doc_id`` do not remove from each other. An empty table
gives no rows. Other columns are read only if they are named in ``keep``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchloom.llm import phrases
from batchloom.llm.phrases import Items, doc_ids, expand
from batchloom.llm.routing import bucket_count, chunked
from batchloom.llm.routing import opened as read
from batchloom.llm.texts import byte_values, binaries

GRAM = 24


def byte_items(table: pa.Table) -> tuple[Items, np.ndarray]:
    texts = binaries(table.column("text"))
    data = b"".join(texts)
    array = np.frombuffer(data, dtype=np.uint8)
    items = Items(
        np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)),
        doc_ids(table),
        lambda low, high: byte_values(array[low:high]),
        lambda low, high: data[low:high],
        within=False,
    )
    return items, array


def equal_groups(data: bytes, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes that share their first ``size`` bytes with another: their numbers and, ascending, their groups."""
    padded = np.frombuffer(data + bytes(16), dtype=np.uint8)
    digits = np.empty((len(data) // 8 + 1) * 8, dtype=np.uint64)
    for shift in range(8):
        digits[shift::8] = padded[shift : shift + len(digits)].view(">u8")
    active = np.arange(len(at))
    group = np.zeros(len(at), dtype=np.int64)
    for depth in range(0, size, 8):
        digit = digits[at[active] + depth]
        if size - depth < 8:
            digit = digit >> np.uint64(8 * (8 - size + depth))
        order = np.lexsort((digit, group)) if depth else np.argsort(digit)
        group, digit = group[order], digit[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (group[1:] != group[:-1]) | (digit[1:] != digit[:-1])
        run = np.cumsum(new) - 1
        alike = np.bincount(run, minlength=1)[run] > 1
        active, group = active[order[alike]], run[alike]
    return active, group


def find_earlier(size: int):
    def find(contents, windows, docs, starts, kind, asked, asked_docs, asked_starts):
        lengths = windows + size - 1
        at = expand(np.cumsum(lengths) - lengths, windows)
        earliest = np.repeat(docs, windows)
        active, group = equal_groups(b"".join(contents), at, size)
        if len(active):
            begin = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
            least = np.minimum.reduceat(earliest[active], begin)
            earliest[active] = np.repeat(least, np.diff(np.append(begin, len(group))))
        first = (np.cumsum(windows) - windows)[kind]
        return earliest[expand(first, asked)] < np.repeat(asked_docs, asked)

    return find


def remove_repeats(docs: DataFrame, size: int = 50, keep: tuple[str, ...] = (), hot: int = phrases.HOT) -> DataFrame:
    """One row per document: doc_id, the columns of ``keep``, n_bytes, n_removed, n_spans and the remaining bytes ``kept``."""
    gram = min(GRAM, max(1, size // 2))
    source = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), *[c for c in keep if c not in ("doc_id", "text")])
    chunks = chunked(source, source.columns).repartition("chunk")
    buckets = bucket_count(docs)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                table = read(row["data"])
                items, array = byte_items(table)
                known, answers = ({a["bucket"]: a["data"] for a in row[c] or ()} for c in ("known", "answers"))
                found = phrases.repeats(items, size, gram, buckets, known)
                later = found.doc > found.doc[found.best][found.kind]
                gone = phrases.flagged(found, answers, later, len(array), size)
                bounds = items.first
                removed = np.concatenate(([0], np.cumsum(gone)))[bounds]
                opens = gone.copy()
                opens[1:] &= ~gone[:-1]
                inner = bounds[:-1][items.counts > 0]
                opens[inner] = gone[inner]
                spans = np.concatenate(([0], np.cumsum(opens)))[bounds]
                left = array[~gone].tobytes()
                ends = (bounds - removed).tolist()
                parts = [left[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
                out = [pa.array(c) for c in (items.counts, np.diff(removed), np.diff(spans))]
                carried = [table.column(c).combine_chunks() for c in columns]
                yield pa.RecordBatch.from_arrays([*carried, *out, pa.array(parts, pa.binary())], [*columns, "n_bytes", "n_removed", "n_spans", "kept"])

    columns = ["doc_id", *[c for c in keep if c != "doc_id"]]
    asked = phrases.two_rounds(chunks, lambda t: byte_items(t)[0], size, gram, buckets, find_earlier(size), hot)
    schema = source.select(*columns).schema.add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long").add("kept", "binary")
    return asked.mapInArrow(apply, schema)
