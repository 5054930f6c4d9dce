"""Phrases: runs of windows that share an anchor, the routing key of repeated windows.

The anchor of a window is the smallest hash among its grams, so it depends on the window's content alone: equal windows
have equal anchors wherever they stand. Consecutive windows with one anchor form a phrase. Two rounds of questions follow:

1. Every chunk tells the buckets how often it has each anchor. An anchor that stands once in the whole corpus
   cannot hold a repeated window and is done. A very frequent anchor is hot.
2. Every chunk sends its different phrases of repeated anchors to the anchors' buckets, and of hot anchors each different
   window to a bucket chosen by the window's content. The bucket finds which windows have an earlier occurrence.

Positions are (doc_id, start). Null ids count as the largest.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from batchloom.llm.routing import Rows, answer, ask, by_bucket, dump, load, with_answers
from batchloom.llm.texts import U64, mix, window_hashes, window_starts

SLICE = 1 << 17
LONGEST = 256
HOT = 20_000
NO_ID = np.iinfo(np.int64).max


@dataclass
class Items:
    """The items (bytes or words) of a chunk's documents one after another."""

    counts: np.ndarray
    doc_ids: np.ndarray
    values: Callable[[int, int], np.ndarray]
    content: Callable[[int, int], bytes]
    within: bool  # whether a window may also repeat one of its own document

    @property
    def first(self) -> np.ndarray:
        return np.concatenate(([0], np.cumsum(self.counts)))


def doc_ids(table: pa.Table) -> np.ndarray:
    return np.asarray(table.column("doc_id").fill_null(NO_ID)).astype(np.int64)


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    done, have = values, 1
    while have * 2 <= width:
        done = np.minimum(done[:-have], done[have:])
        have *= 2
    rest = width - have
    return np.minimum(done[: len(done) - rest], done[rest:]) if rest else done


def expand(begin: np.ndarray, times: np.ndarray) -> np.ndarray:
    """``begin``, ``begin + 1``, ... for each range."""
    return np.repeat(begin - np.cumsum(times) + times, times) + np.arange(int(times.sum()))


def cut(items: Items, size: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Phrases: the start of the first window, the number of windows, the anchor, how often the anchor stands in it.

    A phrase that holds its anchor more than once may repeat a window by itself.
    """
    valid = window_starts(items.counts, size)
    firsts, lengths, keys, often = [], [], [], []
    for low in range(0, len(valid), SLICE):
        high = min(low + SLICE, len(valid))
        at = np.flatnonzero(valid[low:high])
        if not len(at):
            continue
        grams = window_hashes(items.values(low, high + size - 1), gram)
        anchor = sliding_minimum(grams, size - gram + 1)[at]
        new = np.ones(len(at), dtype=bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)
        begin = np.flatnonzero(new)
        within = np.arange(len(at)) - np.repeat(begin, np.diff(np.append(begin, len(at))))
        begin = np.flatnonzero(within % LONGEST == 0)
        firsts.append(at[begin] + low)
        lengths.append(np.diff(np.append(begin, len(at))))
        keys.append(anchor[begin])
        if items.within:
            places = lengths[-1] + size - gram
            same = grams[expand(at[begin], places)] == np.repeat(keys[-1], places)
            often.append(np.add.reduceat(same, np.cumsum(places) - places, dtype=np.int64))
        else:
            often.append(np.ones(len(begin), dtype=np.int64))
    if not firsts:
        none = np.empty(0, dtype=np.int64)
        return none, none, none.astype(U64), none
    return np.concatenate(firsts), np.concatenate(lengths), np.concatenate(keys), np.concatenate(often)


def _short(keys: np.ndarray) -> np.ndarray:
    """48 bits of each key; a chance agreement makes a phrase travel, no more."""
    return mix(keys) & U64((1 << 48) - 1)


def ask_anchors(items: Items, size: int, gram: int, buckets: int) -> Rows:
    _, _, keys, often = cut(items, size, gram)
    own, inverse = np.unique(keys, return_inverse=True)
    counts = np.bincount(inverse, weights=often, minlength=len(own))
    _, order, bounds = by_bucket(own, buckets)
    short = _short(own[order]).view(np.uint8).reshape(-1, 8)[:, :6]
    counts = counts[order].astype(np.uint32)
    for b in range(buckets):
        i, j = bounds[b], bounds[b + 1]
        if i < j:
            yield b, dump((short[i:j].tobytes(), counts[i:j].tobytes()))


def answer_anchors(asked: list[bytes], hot: int = HOT) -> list[bytes]:
    """For each anchor asked about: 0 if it stands once, 1 if more often, 2 if it is hot."""
    rows = [load(x) for x in asked]
    counts = np.frombuffer(b"".join(c for _, c in rows), dtype=np.uint32)
    keys = np.zeros((len(counts), 8), dtype=np.uint8)
    keys[:, :6] = np.frombuffer(b"".join(k for k, _ in rows), dtype=np.uint8).reshape(-1, 6)
    _, inverse = np.unique(keys.view("<u8").ravel(), return_inverse=True)
    total = np.bincount(inverse, weights=counts)
    code = ((total > 1).astype(np.uint8) + (total > hot).astype(np.uint8))[inverse]
    sizes = [len(c) // counts.itemsize for _, c in rows]
    return [dump(code[e - n : e].tobytes()) for e, n in zip(np.cumsum(sizes), sizes, strict=True)]


@dataclass
class Repeats:
    """The phrases of a chunk that may be repeated, as occurrences of different contents."""

    first: np.ndarray  # of each occurrence: its first window
    windows: np.ndarray
    kind: np.ndarray  # of each occurrence: the number of its content
    doc: np.ndarray
    start: np.ndarray  # within the document
    contents: list[bytes]
    best: np.ndarray  # of each content: its earliest occurrence
    order: np.ndarray  # contents by bucket
    bounds: np.ndarray


def repeats(items: Items, size: int, gram: int, buckets: int, answers: dict[int, bytes]) -> Repeats:
    first, windows, keys, _ = cut(items, size, gram)
    own, inverse = np.unique(keys, return_inverse=True)
    _, order, bounds = by_bucket(own, buckets)
    code = np.zeros(len(own), dtype=np.uint8)
    for b in range(buckets):
        i, j = bounds[b], bounds[b + 1]
        if i < j:
            code[order[i:j]] = np.frombuffer(load(answers[b]), dtype=np.uint8)
    code = code[inverse]
    route = keys
    if (code == 2).any():  # every window of a hot anchor goes its own way
        times = np.where(code == 2, windows, (code > 0).astype(np.int64))
        owner = np.repeat(np.arange(len(first)), times)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(times) - times, times)
        hot = code[owner] == 2
        first = first[owner] + np.where(hot, within, 0)
        windows = np.where(hot, 1, windows[owner])
        route = keys[owner]
    else:
        hot = np.zeros(int((code > 0).sum()), dtype=bool)
        first, windows, route = first[code > 0], windows[code > 0], keys[code > 0]
    row = np.searchsorted(items.first, first, side="right") - 1
    doc, start = items.doc_ids[row], first - items.first[row]
    number: dict[bytes, int] = {}
    kind = np.empty(len(first), dtype=np.int64)
    content = items.content
    for i, (a, n) in enumerate(zip(first.tolist(), (first + windows + size - 1).tolist(), strict=True)):
        kind[i] = number.setdefault(content(a, n), len(number))
    contents = list(number)
    by_place = np.lexsort((start, doc))[::-1]
    best = np.zeros(len(contents), dtype=np.int64)
    best[kind[by_place]] = by_place  # the earliest is written last
    route = route[best]
    for i in np.flatnonzero(hot[best]):
        route[i] = xxhash.xxh64_intdigest(contents[i])
    _, order, bounds = by_bucket(route, buckets)
    return Repeats(first, windows, kind, doc, start, contents, best, order, bounds)


def ask_repeats(found: Repeats) -> Rows:
    for b in range(len(found.bounds) - 1):
        own = found.order[found.bounds[b] : found.bounds[b + 1]]
        if len(own):
            best = found.best[own]
            yield b, dump(([found.contents[i] for i in own], found.windows[best].tobytes(), found.doc[best].tobytes(), found.start[best].tobytes()))


def answer_repeats(asked: list[bytes], find: Callable) -> list[bytes]:
    """Which windows of each content occur earlier than its own earliest occurrence in the chunk that asks.

    ``find(contents, windows, docs, starts)`` gets different contents with their earliest occurrences and gives, for all
    their windows one after another, whether the window occurs earlier.
    """
    rows = [load(x) for x in asked]
    number: dict[bytes, int] = {}
    kind = np.fromiter((number.setdefault(c, len(number)) for r in rows for c in r[0]), dtype=np.int64)
    windows, docs, starts = (np.frombuffer(b"".join(r[k] for r in rows), dtype=np.int64) for k in (1, 2, 3))
    by_place = np.lexsort((starts, docs))[::-1]
    best = np.zeros(len(number), dtype=np.int64)
    best[kind[by_place]] = by_place
    earlier = find(list(number), windows[best], docs[best], starts[best], kind, windows, docs, starts)
    ends = np.cumsum(windows)
    out, i = [], 0
    for r in rows:
        n = len(r[0])
        low = int(ends[i] - windows[i])
        i += n
        out.append(dump(np.packbits(earlier[low : int(ends[i - 1])]).tobytes()))
    return out


def flagged(found: Repeats, answers: dict[int, bytes], later: np.ndarray, n_items: int, size: int) -> np.ndarray:
    """Items covered by a window with an earlier occurrence; ``later`` marks occurrences all of whose windows have one."""
    windows = found.windows[found.best]
    ends = np.cumsum(windows[found.order])
    bits = np.zeros(int(ends[-1]) if len(ends) else 0, dtype=np.uint8)
    for b in range(len(found.bounds) - 1):
        i, j = found.bounds[b], found.bounds[b + 1]
        if i < j:
            low, high = int(ends[i] - windows[found.order[i]]), int(ends[j - 1])
            bits[low:high] = np.unpackbits(np.frombuffer(load(answers[b]), dtype=np.uint8))[: high - low]
    begin = np.empty(len(windows), dtype=np.int64)
    begin[found.order] = ends - windows[found.order]
    times = found.windows
    owner = np.repeat(np.arange(len(times)), times)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(times) - times, times)
    hit = later[owner] | (bits[begin[found.kind[owner]] + within] > 0)
    at = found.first[owner[hit]] + within[hit]
    covered = np.zeros(n_items + 1, dtype=np.int64)
    covered += np.bincount(at, minlength=n_items + 1)
    covered -= np.bincount(at + size, minlength=n_items + 1)[: n_items + 1]
    return np.cumsum(covered)[:-1] > 0


def two_rounds(chunks: DataFrame, make: Callable[[pa.Table], Items], size: int, gram: int, buckets: int, find: Callable, hot: int = HOT) -> DataFrame:
    """The chunks with ``answers`` (second round) and ``known`` (first round)."""
    first = answer(ask(chunks, lambda t, _: ask_anchors(make(t), size, gram, buckets)), lambda a: answer_anchors(a, hot))
    known = with_answers(chunks, first)
    second = answer(ask(known, lambda t, a: ask_repeats(repeats(make(t), size, gram, buckets, a))), lambda a: answer_repeats(a, find))
    return with_answers(known.withColumnRenamed("answers", "known"), second)
