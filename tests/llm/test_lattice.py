"""Lattice scores against brute force over all segmentations, and word counts against plain counting."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from batchloom.llm.lattice import MARK, Lattice, piece_counts, piece_logs, score_texts, vocabulary
from batchloom.llm.queries import QUERIES

PATH = str(public_tokenizers.path("piece_bpe_32k.model"))


def plain_words(text):
    return bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()).split()


def plain(rows):
    """The base columns of every row by plain counting."""
    train = [(d, t) for d, t in rows if d is not None and zlib.crc32(str(d).encode()) % 5 != 1]
    counts = Counter(w for _, t in train for w in plain_words(t))
    counts[None] = len(train)
    counts += Counter()
    n, v = sum(counts.values()), len(counts)
    out = []
    for d, t in rows:
        tokens = [*plain_words(t), None]
        held = d is None or zlib.crc32(str(d).encode()) % 5 == 1
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens)
        out.append((d, held, len(tokens), sum(counts[w] > 0 for w in tokens), n, base))
    return out, counts, len(train)


def plain_marginal(word, logs):
    """Sum over all segmentations, by recursion over suffixes."""
    _, spelt, single = vocabulary(PATH)
    known = {p: math.exp(logs[i]) for i, p in enumerate(spelt) if p}
    word = MARK + word
    total = [0.0] * len(word) + [1.0]
    for i in range(len(word) - 1, -1, -1):
        total[i] = math.exp(logs[single[word[i]]]) * total[i + 1]
        for j in range(i + 1, len(word) + 1):
            if word[i:j] in known:
                total[i] += known[word[i:j]] * total[j]
    return total[0]


def corpus():
    rng = random.Random(4)
    vocabulary = ["".join(rng.choices("abcdeéTh", k=rng.randint(1, 9))) for _ in range(200)]
    rows = [(i, rng.choice([" ", "\n"]).join(rng.choices(vocabulary, k=rng.randint(0, 80)))) for i in range(120)]
    return rows + [(None, "a b c"), (500, None), (501, ""), (502, " \t"), (503, "日本語 \U0001f600 x" * 30), rows[3], rows[3], (504, "z" * 5000), (505, "the " * 3000)]


def test_marginals_are_sums_over_segmentations():
    logs = np.log(np.random.default_rng(1).random(len(vocabulary(PATH)[1])) / 1000)
    words = [b"a", b"the", b"thonou", "été日本".encode(), b"internationalisation", b"\xff\xfe", b"aaaaaaaa", MARK, b"x" * 60]
    got = Lattice(PATH, logs).log_probabilities(words)
    assert np.allclose(got, [math.log(plain_marginal(w, logs)) for w in words])


def test_edges(spark):
    rows = corpus()
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, score string").repartition(3)
    got = sorted(map(tuple, score_texts(docs, PATH).collect()), key=repr)
    expected, counts, ends = plain(rows)
    assert len(got) == len(expected)
    words = [w for w in counts if w is not None]
    logs, end = piece_logs(piece_counts(words, np.array([counts[w] for w in words]), PATH), ends, PATH)
    known = {}
    texts = {}
    for d, t in rows:
        texts.setdefault(d, t)
    for g, e in zip(got, sorted(expected, key=repr), strict=True):
        assert g[:5] == e[:5]
        assert g[5] == pytest.approx(e[5])
        score = end
        for w in plain_words(texts[g[0]]):
            if w not in known:
                known[w] = Lattice(PATH, logs).log_probabilities([w])[0] if len(w) > 2000 else math.log(plain_marginal(w, logs))
            score += known[w]
        assert g[6] == pytest.approx(score / math.log(10))
    none = score_texts(docs.limit(0), PATH)
    assert none.count() == 0


def test_whole_table(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = {r.doc_id: r for r in QUERIES["op5_lm_scoring"](spark, sf_dir).collect()}
    for d, held, n, known, train, base in plain(rows)[0]:
        r = got[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, train)
        assert r.base_score == pytest.approx(base)
        assert r.score < 0
    out = [r for r in got.values() if r.held_out and r.n_tokens > 20]
    assert sum(r.score for r in out) > sum(-7 * r.n_tokens for r in out)


def test_probabilities_add_up():
    logs, end = piece_logs(np.arange(len(vocabulary(PATH)[1])), 7, PATH)
    assert np.exp(logs).sum() + math.exp(end) == pytest.approx(1.0)
