"""Language-model scores by the subword lattice of an existing vocabulary.

The pieces of a public subword vocabulary are the arcs of a lattice over the bytes of each word (with the vocabulary's mark
for a word's start in front); byte pieces cover whatever no piece covers. A word's probability is the sum over all its
segmentations of the product of piece probabilities, by a forward recursion in log space. A text's probability is the
product over its words and one end. The vocabulary's own order gives each piece a prior, and the pieces that the vocabulary's
own splitting puts into the training words are counted on top.

Word counts come from the corpus by questions and answers (see ``routing``): every chunk sends its different words with
their counts in training documents, the buckets add them up, score each different word once and answer. Only the counts of
the fixed vocabulary's pieces and two totals reach the driver.

Texts are lower-cased A-Z; words are parted by space, tab, newline, vertical tab, form feed and carriage return; every text
ends with one end token, null and empty texts have that alone. Documents whose CRC-32 of the id as text leaves the held-out
remainder are not learned from; a null ``doc_id`` is held out. Repeated rows count each time. An empty table gives no rows,
other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchloom.llm.routing import answer, ask, bucket_count, by_bucket, chunked, dump, load, opened, with_answers
from batchloom.llm.texts import U64, Words, binaries, span_hashes
from batchloom.sources.files import write_scratch

MARK = "▁".encode()
_START, _STEP, _WORD = 0xCBF29CE484222325, 0x100000001B3, (1 << 64) - 1
_PIECES: dict[str, tuple] = {}
PARTIAL_SUMS = 16


def vocabulary(path: str):
    """The pieces of a subword model: its processor, the bytes of each piece (None for control pieces), byte pieces."""
    if path not in _PIECES:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        spelt: list[bytes | None] = []
        single = np.full(256, -1, dtype=np.int64)
        for i in range(model.get_piece_size()):
            if model.is_byte(i):
                single[int(model.id_to_piece(i)[3:5], 16)] = i
                spelt.append(None)
            elif model.is_control(i) or model.is_unknown(i):
                spelt.append(None)
            else:
                spelt.append(model.id_to_piece(i).encode())
        _PIECES[path] = (model, spelt, single)
    return _PIECES[path]


class Lattice:
    """Piece probabilities of a vocabulary and the marginal probability of words under them."""

    def __init__(self, path: str, logs: np.ndarray):
        _, spelt, single = vocabulary(path)
        keys: dict[int, float] = {}
        prefixes = set()
        for piece, log in zip(spelt, logs, strict=True):
            if piece:
                key = _START
                for byte in piece:
                    key = (key ^ byte) * _STEP & _WORD
                    prefixes.add(key)
                keys[key] = log
        order = sorted(keys)
        self.keys = np.array(order, dtype=U64)
        self.logs = np.array([keys[k] for k in order])
        self.begins = np.zeros(1 << 22, dtype=bool)
        self.begins[np.array(sorted(prefixes), dtype=U64) >> U64(42)] = True
        self.single = logs[single]
        self.longest = max(len(p) for p in spelt if p)

    def log_probabilities(self, words: list[bytes]) -> np.ndarray:
        """Natural logarithm of each word's marginal probability."""
        out = np.empty(len(words))
        size = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + len(MARK)
        order = np.argsort(size, kind="stable")
        sizes = size[order]
        low = 0
        while low < len(order):  # words of one length at a time, in blocks of bounded memory
            n = int(sizes[low])
            high = min(int(np.searchsorted(sizes, n, side="right")), low + max(1, (1 << 20) // n))
            rows = order[low:high]
            data = np.frombuffer(b"".join([MARK + words[i] for i in rows]), dtype=np.uint8)
            out[rows] = self._forward(np.ascontiguousarray(data.reshape(len(rows), n).T))
            low = high
        return out

    def _forward(self, grid: np.ndarray) -> np.ndarray:
        """``grid[i]`` has byte i of every word; all arcs into a place are added before those that leave it."""
        n, rows = grid.shape
        alpha = np.full((n + 1, rows), -np.inf)
        alpha[0] = 0.0
        for start in range(n):
            here = alpha[start]
            alpha[start + 1] = np.logaddexp(alpha[start + 1], here + self.single[grid[start]])
            active = np.arange(rows)
            key = np.full(rows, _START, dtype=U64)
            for end in range(start, min(n, start + self.longest)):
                key = (key ^ grid[end][active]) * U64(_STEP)
                on = self.begins[key >> U64(42)]
                active, key = active[on], key[on]
                if not len(active):
                    break
                at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                hit = self.keys[at] == key
                if hit.any():
                    own = active[hit]
                    alpha[end + 1, own] = np.logaddexp(alpha[end + 1, own], here[own] + self.logs[at[hit]])
        return alpha[n]


def is_training(doc_ids: list[int | None], held_out: int, folds: int) -> np.ndarray:
    return np.array([d is not None and zlib.crc32(str(d).encode()) % folds != held_out for d in doc_ids], dtype=bool)


class ChunkWords:
    """The words of a chunk, each different one once, in buckets."""

    def __init__(self, table: pa.Table, held_out: int, folds: int, buckets: int):
        self.doc_ids = table.column("doc_id").to_pylist()
        self.train = is_training(self.doc_ids, held_out, folds)
        self.words = Words([t.lower() for t in binaries(table.column("text"))])
        coded = pa.array(self.words.flat, pa.binary()).dictionary_encode()
        self.codes = np.asarray(coded.indices).astype(np.int64)
        self.rows = self.words.rows()
        self.different = coded.dictionary.to_pylist()
        self.counts = np.bincount(self.codes[self.train[self.rows]], minlength=len(self.different)).astype(np.int64)
        ends = np.cumsum([len(w) + 1 for w in self.different], dtype=np.int64) - 1
        lengths = np.array([len(w) for w in self.different], dtype=np.int64)
        keys = span_hashes(np.frombuffer(b" ".join(self.different), dtype=np.uint8), ends - lengths, ends)
        _, self.order, self.bounds = by_bucket(keys, buckets)

    def questions(self):
        for b in range(len(self.bounds) - 1):
            own = self.order[self.bounds[b] : self.bounds[b + 1]]
            if len(own):
                yield b, dump((b" ".join([self.different[i] for i in own]), self.counts[own].tobytes()))

    def answered(self, answers: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray]:
        counts, logs = np.zeros(len(self.different), dtype=np.int64), np.zeros(len(self.different))
        for b in range(len(self.bounds) - 1):
            own = self.order[self.bounds[b] : self.bounds[b + 1]]
            if len(own):
                count, log = load(answers[b])
                counts[own], logs[own] = np.frombuffer(count, dtype=np.int64), np.frombuffer(log)
        return counts, logs


def _gathered(asked: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray, list[int]]:
    """The different words of a bucket with their counts; which word each question is; where each chunk's questions end."""
    rows = [load(x) for x in asked]
    lists = [w.split(b" ") for w, _ in rows]
    coded = pa.array([w for own in lists for w in own], pa.binary()).dictionary_encode()
    kind = np.asarray(coded.indices).astype(np.int64)
    counts = np.frombuffer(b"".join(c for _, c in rows), dtype=np.int64)
    words = coded.dictionary.to_pylist()
    total = np.zeros(len(words), dtype=np.int64)
    np.add.at(total, kind, counts)
    return words, total, kind, np.cumsum([len(x) for x in lists]).tolist()


def piece_counts(words: list[bytes], counts: np.ndarray, path: str) -> np.ndarray:
    """How often the vocabulary's own splitting puts each piece into the words."""
    model, spelt, _ = vocabulary(path)
    out = np.zeros(len(spelt), dtype=np.int64)
    for low in range(0, len(words), 20_000):
        ids = model.encode([w.decode("utf-8", "replace") for w in words[low : low + 20_000]], out_type=int, num_threads=1)
        sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        flat = np.fromiter((i for own in ids for i in own), dtype=np.int64, count=int(sizes.sum()))
        np.add.at(out, flat, np.repeat(counts[low : low + 20_000], sizes))
    return out


def piece_logs(counts: np.ndarray, ends: int, path: str) -> tuple[np.ndarray, float]:
    """Natural logarithms of the pieces' probabilities and of the end's: counts on top of a prior by the vocabulary's order."""
    _, spelt, single = vocabulary(path)
    usable = np.array([bool(p) for p in spelt])
    usable[single] = True
    prior = np.where(usable, 1.0 / (np.arange(len(spelt)) + 10.0), 0.0)
    weight = float(len(spelt))
    total = float(counts[usable].sum()) + ends + 1.0 + weight
    with np.errstate(divide="ignore"):
        return np.log((np.where(usable, counts, 0) + weight * prior / prior.sum()) / total), float(np.log((ends + 1.0) / total))


def score_texts(docs: DataFrame, vocabulary_path: str, held_out: int = 1, folds: int = 5) -> DataFrame:
    """One row per document.

    Columns: doc_id, held_out, n_tokens, n_known (tokens seen in training), train_tokens, base_score (log10 probability under
    smoothed word counts), score (log10 marginal probability under the lattice).
    """
    source = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    chunks = chunked(source, ["doc_id", "text"])
    buckets = bucket_count(docs)
    asked = write_scratch(ask(chunks, lambda t, _: ChunkWords(t, held_out, folds, buckets).questions()), "words")

    size = len(vocabulary(vocabulary_path)[1])

    def count(table: pa.Table) -> pa.Table:
        """One row: counts of the pieces in the bucket's training words, the number of these words, of different ones."""
        words, total, _, _ = _gathered(table.column("data").to_pylist())
        known = np.flatnonzero(total)
        counts = piece_counts([words[i] for i in known], total[known], vocabulary_path)
        return pa.table({"data": pa.array([dump(np.append(counts, (total.sum(), len(known))))], pa.binary())})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(size + 2, dtype=np.int64)
        for batch in batches:
            for data in batch.column("data").to_pylist():
                out += load(data)
        yield pa.RecordBatch.from_arrays([pa.array([dump(out)], pa.binary())], ["data"])

    # A row per bucket is added up in a few tasks, so the driver gets PARTIAL_SUMS rows of the fixed vocabulary's size.
    rows = asked.groupBy("bucket").applyInArrow(count, "data binary").repartition(PARTIAL_SUMS).mapInArrow(add, "data binary")
    sums = sum((load(bytes(r["data"])) for r in rows.collect()), np.zeros(size + 2, dtype=np.int64))
    counts = sums[:size]
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds))
    ends = source.where(fold != held_out).count()
    tokens, different = int(sums[size]) + ends, int(sums[size + 1]) + (ends > 0)
    logs, end_log = piece_logs(counts, ends, vocabulary_path)
    logs = logs.astype(np.float64)

    def respond(asked: list[bytes]) -> list[bytes]:
        words, total, kind, stops = _gathered(asked)
        log = Lattice(vocabulary_path, logs).log_probabilities(words)
        return [dump((total[kind[a:b]].tobytes(), log[kind[a:b]].tobytes())) for a, b in zip([0, *stops], stops, strict=False)]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own = ChunkWords(opened(row["data"]), held_out, folds, buckets)
                count, log = own.answered({a["bucket"]: a["data"] for a in row["answers"] or ()})
                n = len(own.doc_ids)
                n_tokens = own.words.counts + 1

                def summed(values, own=own, n=n):
                    return np.bincount(own.rows, weights=values[own.codes], minlength=n)

                base = summed(np.log10(count + 0.5)) + np.log10(ends + 0.5) - n_tokens * np.log10(tokens + 0.5 * (different + 1))
                columns = [
                    pa.array(own.doc_ids, pa.int64()),
                    pa.array(~own.train),
                    pa.array(n_tokens),
                    pa.array(summed(count > 0).astype(np.int64) + (ends > 0)),
                    pa.array(np.full(n, tokens, dtype=np.int64)),
                    pa.array(base),
                    pa.array((summed(log) + end_log) / np.log(10)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    scored = with_answers(chunks.repartition("chunk"), answer(asked, respond))
    return scored.mapInArrow(
        apply,
        "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    )
