"""Removal of repeated runs of words by relative Lempel-Ziv parsing against blocks of the corpus.

The corpus is the reference. It is held in blocks, one for each bucket: a block has the different phrases that were dealt to it
(see ``phrases``: runs of windows with one anchor) with their earliest places, and an index that gives, for a window of ``size``
words, the earliest place in the block where it stands. Since equal windows have equal anchors, the block of a window's anchor is the
only one that can hold it, so that parsing each stretch of a document against that block is parsing it against every block.

The parse is greedy. Where the window at hand stands earlier in the block, a factor begins there and is extended for as long as the
words after it follow those at that place; it is at least ``size`` words long, and its words are a duplicate span. The windows that begin
in a factor's last ``size - 1`` words reach beyond its end, so the parse goes on with the first of them: factors overlap at their
boundaries, and a span that was copied from several places is covered without a gap. Where no factor begins, the parse goes on with the
next word. Factors also end where a phrase ends; the factor of the next phrase begins with the next window, and ``phrases.flagged``
joins them in the document.

A word is removed if a window that covers it also starts earlier (smaller ``doc_id``, or the same and an earlier start);
windows are judged on the input. Words are parted by space, tab, newline, vertical tab, form feed and carriage return. Null
texts have no words, shorter texts stay whole. A null ``doc_id`` counts as larger than all others and stays null. Rows with
the same ``doc_id`` and the same start of a window are the same place, so neither is earlier, whatever else the rows hold. An empty
table gives no rows. Other columns are read only if they are named in ``keep``.
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
from batchloom.llm.texts import U64, Words, binaries, mix, window_hashes

GRAM = 8


def word_items(table: pa.Table) -> tuple[Items, Words]:
    words = Words(binaries(table.column("text")))
    hashes = words.hashes()
    data, starts, ends = words.data, words.starts, words.ends
    items = Items(words.counts, doc_ids(table), lambda low, high: hashes[low:high], lambda low, high: data[starts[low] : ends[high - 1]], within=True)
    return items, words


class Block:
    """The phrases of a block with the index of its windows; windows are numbered phrase by phrase."""

    def __init__(self, contents: list[bytes], windows: np.ndarray, docs: np.ndarray, starts: np.ndarray, size: int):
        words = Words(contents)
        ids = np.asarray(pa.array(words.flat, pa.binary()).dictionary_encode().indices).astype(np.int64)
        self.size = size
        self.at = expand(words.first[:-1], windows)
        self.kind = self._kinds(ids)
        self.end = np.repeat(np.cumsum(windows), windows)  # of each window's phrase
        place = np.repeat(docs, windows), expand(starts, windows)
        order = np.lexsort((place[1], place[0]))
        moved = np.ones(len(order), dtype=np.int64)
        moved[1:] = (place[0][order[1:]] != place[0][order[:-1]]) | (place[1][order[1:]] != place[1][order[:-1]])
        #: Equal for equal places, smaller for earlier ones.
        self.rank = np.empty(len(order), dtype=np.int64)
        self.rank[order] = np.cumsum(moved)
        #: The index: for each different window the earliest one of the block.
        self.earliest = np.empty(int(self.kind.max(initial=-1)) + 1, dtype=np.int64)
        self.earliest[self.kind[order[::-1]]] = order[::-1]

    def _kinds(self, ids: np.ndarray) -> np.ndarray:
        """The number of each window's content; hashes are compared word by word and salted anew if two contents share one."""
        salt = 0
        while True:
            keys = window_hashes(mix(ids.astype(U64) + U64(salt)), self.size)[self.at] if len(self.at) else np.empty(0, U64)
            _, index, kind = np.unique(keys, return_index=True, return_inverse=True)
            same = index[kind]
            if all(np.array_equal(ids[self.at + k], ids[self.at[same] + k]) for k in range(self.size)):
                return kind
            salt += 1

    def factors(self) -> list[tuple[int, int, int]]:
        """The parse: first window, number of windows and first window of the place copied from, for each factor."""
        source = self.earliest[self.kind]
        begins = np.flatnonzero(self.rank[source] < self.rank)  # where the index has an earlier place
        out = []
        i = 0
        while i < len(begins):
            at = int(begins[i])
            place = int(source[at])
            longest = int(min(self.end[at] - at, self.end[place] - place))
            differs = np.flatnonzero(self.kind[at : at + longest] != self.kind[place : place + longest])
            length = int(differs[0]) if len(differs) else longest
            out.append((at, length, place))
            i = int(np.searchsorted(begins, at + length))
        return out


def find_earlier(size: int):
    def find(contents, windows, docs, starts, kind, asked, asked_docs, asked_starts):
        block = Block(contents, windows, docs, starts, size)
        earlier = np.zeros(len(block.at), dtype=bool)
        for first, length, _ in block.factors():
            earlier[first : first + length] = True
        first = np.cumsum(windows) - windows
        later = (asked_docs > docs[kind]) | (asked_starts > starts[kind])
        return earlier[expand(first[kind], asked)] | np.repeat(later, asked)

    return find


def remove_repeated_words(docs: DataFrame, size: int = 20, keep: tuple[str, ...] = (), hot: int = phrases.HOT) -> DataFrame:
    """One row per document: doc_id, the columns of ``keep``, n_words, n_removed and the kept words as ``kept_text``."""
    gram = min(GRAM, max(1, size // 2))
    source = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), *[c for c in keep if c not in ("doc_id", "text")])
    chunks = chunked(source, source.columns).repartition("chunk")
    buckets = bucket_count(docs)
    columns = ["doc_id", *[c for c in keep if c != "doc_id"]]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                table = read(row["data"])
                items, words = word_items(table)
                known, answers = ({a["bucket"]: a["data"] for a in row[c] or ()} for c in ("known", "answers"))
                found = phrases.repeats(items, size, gram, buckets, known)
                best_doc, best_start = found.doc[found.best][found.kind], found.start[found.best][found.kind]
                later = (found.doc > best_doc) | (found.start > best_start)
                gone = phrases.flagged(found, answers, later, len(words), size)
                removed = np.concatenate(([0], np.cumsum(gone)))[items.first]
                parts = []
                for i, (a, b) in enumerate(zip(items.first[:-1].tolist(), items.first[1:].tolist(), strict=True)):
                    if removed[i + 1] == removed[i]:
                        parts.append(words.data[words.starts[a] : words.ends[b - 1]] if a < b else b"")
                    else:
                        parts.append(b" ".join([w for w, g in zip(words.flat[a:b], gone[a:b].tolist(), strict=True) if not g]))
                carried = [table.column(c).combine_chunks() for c in columns]
                own = [pa.array(items.counts), pa.array(np.diff(removed)), pa.array(parts, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays([*carried, *own], [*columns, "n_words", "n_removed", "kept_text"])

    asked = phrases.two_rounds(chunks, lambda t: word_items(t)[0], size, gram, buckets, find_earlier(size), hot)
    schema = source.select(*columns).schema.add("n_words", "long").add("n_removed", "long").add("kept_text", "string")
    return asked.mapInArrow(apply, schema)
