"""Vectorised work on the words of a batch of texts, for use inside tasks.

Words are the runs of bytes other than space, tab, newline, vertical tab, form feed and carriage return, which is what
``bytes.split()`` gives on UTF-8. Hashes are 64-bit polynomials over a fixed random table, finished by a mixer; they are
the same in every process.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

U64 = np.uint64
_RANDOM = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=U64) * U64(2) + U64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_SLICE = 1 << 20
_POWERS: dict[int, np.ndarray] = {}


def binaries(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """The texts of a string column as UTF-8; nulls are empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finisher of 64-bit values."""
    h = h ^ (h >> U64(32))
    h = h * U64(0xD6E8FEB86659FD93)
    h = h ^ (h >> U64(29))
    h = h * U64(0xBF58476D1CE4E5B9)
    return h ^ (h >> U64(32))


def _powers(base: int, n: int) -> np.ndarray:
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        with np.errstate(over="ignore"):
            steps = np.full(max(n, _SLICE + 4096), base, dtype=U64)
            steps[0] = 1
            known = np.cumprod(steps, dtype=U64)
        if n <= 4 * _SLICE:
            _POWERS[base] = known
    return known[:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of ``data[start:end]`` for each span; spans are in order and do not overlap."""
    out = np.empty(len(starts), dtype=U64)
    i = 0
    while i < len(starts):
        low = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, low + _SLICE, side="right")))
        part = data[low : int(ends[j - 1])]
        sums = np.zeros(len(part) + 1, dtype=U64)
        np.cumsum(_BYTE[part] * _powers(_BASE, len(part)), out=sums[1:])
        s, e = starts[i:j] - low, ends[i:j] - low
        out[i:j] = mix((sums[e] - sums[s]) * _powers(_BASE_INVERSE, len(part) + 1)[s] + (e - s).astype(U64))
        i = j
    return out


def byte_values(data: np.ndarray) -> np.ndarray:
    """A fixed random 64-bit value for each byte."""
    return _BYTE[data]


class Words:
    """The words of several texts, one after another.

    ``data`` holds them joined by one space, ``starts`` and ``ends`` their places there, ``counts`` the words of each
    text and ``first`` the number of its first word.
    """

    def __init__(self, texts: list[bytes]):
        parts = [t.split() for t in texts]
        self.counts = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
        self.first = np.concatenate(([0], np.cumsum(self.counts)))
        flat = list(chain.from_iterable(parts))
        lengths = np.fromiter(map(len, flat), dtype=np.int64, count=len(flat))
        self.data = b" ".join(flat)
        self.ends = np.cumsum(lengths + 1) - 1
        self.starts = self.ends - lengths
        self.flat = flat

    def __len__(self) -> int:
        return len(self.flat)

    @property
    def bytes(self) -> np.ndarray:
        return np.frombuffer(self.data, dtype=np.uint8)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.bytes, self.starts, self.ends)

    def rows(self) -> np.ndarray:
        """The number of the text that each word belongs to."""
        return np.repeat(np.arange(len(self.counts)), self.counts)


def window_hashes(values: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive 64-bit values."""
    n = len(values) - size + 1
    if n <= 0:
        return np.empty(0, dtype=U64)
    done, have = values, 1
    parts = []
    offset = 0
    powers = [U64(pow(_BASE, i, 2**64)) for i in range(size + 1)]
    while True:
        if size & have:
            parts.append((offset, have, done))
            offset += have
        if have * 2 > size:
            break
        done = done[:-have] * powers[have] + done[have:]
        have *= 2
    out = np.zeros(n, dtype=U64)
    for offset, have, run in parts:
        out = out * powers[have] + run[offset : offset + n]
    return mix(out)


def window_starts(counts: np.ndarray, size: int) -> np.ndarray:
    """Mask over all items but the last ``size - 1``: whether a window that starts there stays inside its text."""
    total = int(counts.sum())
    mask = np.ones(total, dtype=bool)
    ends = np.cumsum(counts)
    for back in range(1, size):
        at = ends - back
        mask[at[(counts >= back)]] = False
    return mask[: max(0, total - size + 1)]


def pieces(batch: pa.RecordBatch, column: str = "text", limit: int = 1 << 21):
    """Slices of a batch with about ``limit`` bytes of text each; a longer text is a slice of its own."""
    sizes = [x or 0 for x in pa.compute.binary_length(batch.column(column)).to_pylist()]
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield batch.slice(start)


class Texts:
    """A few whole texts with statistics that are worked out when first asked for, one value per text."""

    def __init__(self, texts: list[bytes]):
        self.texts = texts
        self._known: dict[str, np.ndarray] = {}

    def __len__(self) -> int:
        return len(self.texts)

    def take(self, keep: np.ndarray) -> Texts:
        return Texts([t for t, k in zip(self.texts, keep, strict=True) if k])

    def _get(self, name: str, make):
        if name not in self._known:
            self._known[name] = make()
        return self._known[name]

    @property
    def words(self) -> Words:
        return self._get("words", lambda: Words(self.texts))

    @property
    def n_words(self) -> np.ndarray:
        return self.words.counts

    def each(self, function) -> np.ndarray:
        return np.fromiter(map(function, self.texts), dtype=np.int64, count=len(self.texts))

    def count_bytes(self, members: bytes) -> np.ndarray:
        """How many bytes of each text are among ``members``."""
        return self._get(f"bytes {members!r}", lambda: self.each(lambda t: len(t) - len(t.translate(None, members))))

    @property
    def n_bytes(self) -> np.ndarray:
        return self.each(len)

    @property
    def word_chars(self) -> np.ndarray:
        """Code points inside words: bytes that neither continue a character nor are white space."""
        return self._get("chars", lambda: self.n_bytes - self.count_bytes(_NO_CHARACTER))

    @property
    def lines(self) -> tuple[np.ndarray, np.ndarray]:
        """Lines with a word, and those among them that equal an earlier one."""

        def count():
            out = np.zeros((2, len(self.texts)), dtype=np.int64)
            for i, t in enumerate(self.texts):
                found = [x for x in t.split(b"\n") if x and not x.isspace()]
                out[:, i] = len(found), len(found) - len(set(found))
            return out

        return tuple(self._get("lines", count))

    @property
    def n_repeat_words(self) -> np.ndarray:
        """Words covered by windows of five words that occur twice or more in their text, the first occurrence included."""

        def count():
            words, size = self.words, 5
            rows = words.rows()
            covered = np.zeros(len(words) + 1, dtype=np.int64)
            ok = np.flatnonzero(window_starts(words.counts, size))
            if len(ok):
                keys = mix(window_hashes(words.hashes(), size)[ok] ^ mix(rows[ok].astype(U64) + U64(1)))
                order = np.argsort(keys)
                run = keys[order]
                same = run[1:] == run[:-1]
                twice = np.zeros(len(ok), dtype=bool)
                twice[order[1:][same]] = True
                twice[order[:-1][same]] = True
                np.add.at(covered, ok[twice], 1)
                np.add.at(covered, ok[twice] + size, -1)
            hit = np.cumsum(covered)[:-1] > 0
            return np.bincount(rows[hit], minlength=len(self.texts)).astype(np.int64)

        return self._get("repeats", count)


_NO_CHARACTER = bytes(range(0x80, 0xC0)) + b" \t\n\v\f\r"
