"""Token ids of whole texts by a public byte-level tokenizer, with a cache of word pieces in each Python worker.

A text is parted at every single space between two characters that are not white space. The tokenizer's own splitting rule
starts a new unit there in any case, so the ids of the parts, one after another, are the ids of the text. Each different
part of a batch is parted into the tokenizer's units once, each different unit is encoded once per worker (the cache is
emptied when it reaches its bound), and the ids are gathered with Arrow.

The file's added tokens (an end-of-text mark, for one) have ids of their own wherever their spelling stands in a text. Texts
that hold one are parted there first, and what lies between is encoded as texts of their own.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHE_ENTRIES = 250_000
_INNER_SPACE = re.compile(r"(?<=\S) (?=\S)")
_LOADED: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of a tokenizer file, one per process."""
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


def _byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in printable}
    for i, b in enumerate(b for b in range(256) if b not in out):
        out[b] = chr(256 + i)
    return out


class Encoder:
    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = {t.content: np.array([i], dtype="<u4") for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.mark = re.compile("|".join(re.escape(x) for x in sorted(self.added, key=len, reverse=True)) or r"(?!)")
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        #: The splitting rule of the byte-level vocabulary, a fixed value.
        self.unit = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
        self.space = self.letters[ord(" ")]
        self.units: dict[str, bytes] = {}

    def _unit(self, unit: str) -> bytes:
        known = self.units.get(unit)
        if known is None:
            if unit.isascii() and unit.isprintable():
                spelt = unit.replace(" ", self.space)
            else:
                spelt = unit.encode().decode("latin-1").translate(self.letters)
            known = array("I", [t.id for t in self.model.tokenize(spelt)]).tobytes()
            if len(self.units) >= CACHE_ENTRIES:
                self.units.clear()
            if len(unit) < 64:
                self.units[unit] = known
        return known

    def _encode(self, text: str) -> bytes:
        return b"".join([self._unit(u) for u in self.unit.findall(text)])

    def _spaced(self, words: list[str]) -> pa.LargeBinaryArray:
        """Ids of each word with a space before it; no word holds a space or begins or ends with white space.

        All words are parted into units together: every word begins a unit with its space, and no other unit has one.
        """
        if not words:
            return pa.array([], pa.large_binary())
        units = self.unit.findall(" " + " ".join(words))
        coded = pa.array(units, pa.large_string()).dictionary_encode()
        different = coded.dictionary
        values = pa.array([self._unit(u) for u in different.to_pylist()], pa.large_binary()).take(coded.indices)
        opens = np.asarray(pc.starts_with(different, " ")).astype(bool)[np.asarray(coded.indices)]
        offsets = _offsets(values)[np.append(np.flatnonzero(opens), len(units))]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer(offsets), values.buffers()[2]])

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and where each text begins (one more than texts); nulls are empty."""
        texts = pc.fill_null(texts, "")
        marked = np.zeros(len(texts), dtype=bool)
        for added in self.added:
            marked |= np.asarray(pc.match_substring(texts, added)).astype(bool)
        if not marked.any():
            return self._plain_ids(texts)
        between, owners, marks = [], [], []
        for i, text in enumerate(texts.to_pylist()):
            own = self.mark.split(text) if marked[i] else [text]
            between += own
            owners += [i] * len(own)
            marks += [*(self.mark.findall(text) if marked[i] else ()), None]  # what follows each part; None ends a text
        flat, bounds = self._plain_ids(pa.array(between, pa.large_string()))
        out, lengths = [], np.zeros(len(texts), dtype=np.int64)
        for i, low, high, mark in zip(owners, bounds[:-1].tolist(), bounds[1:].tolist(), marks, strict=True):
            out.append(flat[low:high])
            if mark is not None:
                out.append(self.added[mark])
            lengths[i] += high - low + (mark is not None)
        return np.concatenate(out), np.concatenate(([0], np.cumsum(lengths)))

    def _plain_ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``ids`` of texts without added tokens."""
        split = pc.split_pattern(texts.cast(pa.large_string()), " ")
        bounds = np.asarray(split.offsets).astype(np.int64)
        coded = split.flatten().dictionary_encode()
        codes = np.asarray(coded.indices).astype(np.int64)
        plain = np.asarray(pc.equal(pc.utf8_trim_whitespace(coded.dictionary), coded.dictionary)).astype(bool)
        plain &= np.asarray(pc.binary_length(coded.dictionary)) > 0
        words = coded.dictionary.to_pylist()
        hit = np.concatenate(([0], np.cumsum(~plain[codes])))
        whole = hit[bounds[1:]] > hit[bounds[:-1]]
        if whole.any():  # white space beside a space: part these texts by the rule itself
            index = {w: i for i, w in enumerate(words)}
            lists = []
            for i in range(len(texts)):
                if whole[i]:
                    own = _INNER_SPACE.split(texts[i].as_py())
                    lists.append(np.array([index.setdefault(w, len(index)) for w in own], dtype=np.int64))
                else:
                    lists.append(codes[bounds[i] : bounds[i + 1]])
            words = list(index)
            plain = np.concatenate((plain, [bool(w) and " " not in w and w.strip() == w for w in words[len(plain) :]])).astype(bool)
            codes = np.concatenate(lists)
            bounds = np.concatenate(([0], np.cumsum([len(x) for x in lists])))
        codes = codes.copy()
        heads: dict[str, int] = {}  # the first part of a text has no space before it
        for at in bounds[:-1].tolist():
            codes[at] = len(words) + heads.setdefault(words[codes[at]], len(heads))
        used = np.zeros(len(words) + len(heads), dtype=bool)
        used[codes] = True
        easy, odd = np.flatnonzero(used[: len(words)] & plain), np.flatnonzero(used[: len(words)] & ~plain)
        where = np.zeros(len(used), dtype=np.int64)
        where[easy] = np.arange(len(easy))
        where[odd] = len(easy) + np.arange(len(odd))
        where[len(words) :] = len(easy) + len(odd) + np.arange(len(heads))
        rest = [self._encode(" " + words[i]) for i in odd] + [self._encode(h) for h in heads]
        taken = pa.concat_arrays([self._spaced([words[i] for i in easy]), pa.array(rest, pa.large_binary())]).take(pa.array(where[codes]))
        offsets = _offsets(taken)
        data = taken.buffers()[2]
        flat = np.frombuffer(data, dtype="<u4")[offsets[0] // 4 : offsets[-1] // 4] if offsets[-1] > offsets[0] else np.empty(0, dtype="<u4")
        return flat, (offsets[bounds] - offsets[0]) // 4


def _offsets(values: pa.LargeBinaryArray) -> np.ndarray:
    return np.frombuffer(values.buffers()[1], dtype=np.int64)[values.offset : values.offset + len(values) + 1]
