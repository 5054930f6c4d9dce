"""Byte and word deduplication against brute force."""

import hashlib
import random

import numpy as np
import pytest

from batchloom.llm.queries import QUERIES
from batchloom.llm.substring_dedup import remove_repeated_words
from batchloom.llm.suffix_dedup import remove_repeats

LAST = float("inf")


def brute_bytes(rows, size):
    least = {}
    for d, t in rows:
        d = LAST if d is None else d
        for i in range(len(t) - size + 1):
            w = t[i : i + size]
            least[w] = min(least.get(w, LAST), d)
    out = []
    for d, t in rows:
        own = LAST if d is None else d
        gone = bytearray(len(t))
        for i in range(len(t) - size + 1):
            if least[t[i : i + size]] < own:
                gone[i : i + size] = b"\1" * size
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((d, len(t), sum(gone), len([x for x in bytes(gone).split(b"\0") if x]), kept))
    return out


def brute_words(rows, size):
    least = {}
    split = [(d, t.split()) for d, t in rows]
    for d, w in split:
        for i in range(len(w) - size + 1):
            key = tuple(w[i : i + size])
            at = (LAST if d is None else d, i)
            least[key] = min(least.get(key, at), at)
    out = []
    for d, w in split:
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if least[tuple(w[i : i + size])] < (LAST if d is None else d, i):
                gone[i : i + size] = [True] * size
        out.append((d, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g)))
    return out


def corpus(seed, n=160):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdeé", k=rng.randint(1, 6))) for _ in range(40)]
    passages = [" ".join(rng.choices(vocabulary, k=rng.randint(4, 40))) for _ in range(6)]
    rows = []
    for i in range(n):
        kind = rng.random()
        if kind < 0.15 and rows:
            text = rng.choice(rows)[1]
        elif kind < 0.3 and rows:
            words = (rng.choice(rows)[1] or "x").split(" ")
            words[rng.randrange(len(words))] = "changed"
            text = " ".join(words)
        else:
            text = " ".join(rng.choices(vocabulary, k=rng.randint(0, 60)))
            if rng.random() < 0.5:
                text += rng.choice(["\n", "  ", "\t "]) + rng.choice(passages) + " " + " ".join(rng.choices(vocabulary, k=5))
        rows.append((i * 7 % n, text))
    rows += [(None, rows[3][1]), (n + 1, None), (n + 2, ""), (n + 3, "aé" * 900), (n + 4, "aé" * 300), (n + 5, "w " * 500), rows[5], rows[5]]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, kept string, n_removed int").repartition(5)


@pytest.mark.parametrize(("size", "hot"), [(50, 20_000), (12, 20_000), (12, 3), (3, 5)])
def test_bytes(spark, size, hot):
    rows = corpus(size + hot)
    got = sorted(map(repr, ((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in remove_repeats(frame(spark, rows), size, hot=hot).collect())))
    assert got == sorted(map(repr, brute_bytes([(d, (t or "").encode()) for d, t in rows], size)))


@pytest.mark.parametrize(("size", "hot"), [(20, 20_000), (4, 20_000), (4, 3), (2, 3)])
def test_words(spark, size, hot):
    rows = corpus(size + hot)
    got = sorted(map(repr, ((r.doc_id, r.n_words, r.n_removed, r.kept_text.encode()) for r in remove_repeated_words(frame(spark, rows), size, hot=hot).collect())))
    assert got == sorted(map(repr, brute_words([(d, (t or "").encode()) for d, t in rows], size)))


def words_of(rng, n):
    return " ".join(f"w{rng.randrange(10_000)}" for _ in range(n))


@pytest.mark.parametrize("order", [1, -1])
@pytest.mark.parametrize("own", [5, None])
def test_rows_that_share_an_id(spark, own, order):
    """Different texts at equal places: neither is earlier, whichever row comes first; windows at other starts are judged by these."""
    rng = random.Random(8)
    shared = words_of(rng, 40)
    rows = [
        (own, f"{shared} {words_of(rng, 24)}"), (own, f"{shared} {words_of(rng, 30)}"), (own, f"{words_of(rng, 3)} {shared}"),
        (own, f"{' '.join(shared.split()[5:30])} {words_of(rng, 9)}"), (1, words_of(rng, 50)),
    ][::order]
    for size in (20, 4):
        got = sorted((r.n_words, r.n_removed, r.kept_text.encode()) for r in remove_repeated_words(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), size).collect())
        want = sorted(w[1:] for w in brute_words([(d, t.encode()) for d, t in rows], size))
        assert got == want and any(n for _, n, _ in got) and got[0] != got[1]


def test_factors_are_greedy_overlap_at_boundaries_and_run_over_phrases(spark):
    import pyarrow as pa

    from batchloom.llm.phrases import cut
    from batchloom.llm.substring_dedup import Block, word_items

    rng = random.Random(4)
    a, b = words_of(rng, 120).split(), words_of(rng, 60).split()
    parsed = [*a[30:70], *b[10:45], *words_of(rng, 10).split(), *a[0:25]]
    block = Block(
        [" ".join(t).encode() for t in (a, b, parsed)], np.array([len(t) - 19 for t in (a, b, parsed)]), np.array([1, 2, 3]), np.zeros(3, dtype=np.int64), 20
    )
    base = len(a) - 19 + len(b) - 19
    # 40 words of a, 35 of b, 25 of a: a factor of n words has n - 19 windows.
    assert block.factors() == [(base, 21, 30), (base + 40, 16, len(a) - 19 + 10), (base + 85, 6, 0)]
    # A copy of 100 words is parted into several phrases, each of which is looked up in another block, and is removed whole.
    copy = " ".join([*words_of(rng, 30).split(), *a[10:110], *words_of(rng, 30).split()])
    items, _ = word_items(pa.table({"doc_id": [2], "text": [copy]}))
    first, _, _, _ = cut(items, 20, 8)
    assert sum(30 < f < 110 for f in first.tolist()) > 1
    got = remove_repeated_words(spark.createDataFrame([(1, " ".join(a)), (2, copy)], "doc_id long, text string")).collect()
    assert {(r.doc_id, r.n_removed) for r in got} == {(1, 0), (2, 100)}


def test_empty(spark):
    empty = frame(spark, corpus(1)).limit(0)
    assert remove_repeats(empty).count() == 0
    assert remove_repeated_words(empty, keep=("text",)).count() == 0


def test_carried_columns(spark):
    rows = corpus(2)
    got = remove_repeated_words(frame(spark, rows), keep=("text",)).collect()
    assert sorted((r.doc_id or -1, r.text or "") for r in got) == sorted((d or -1, t or "") for d, t in rows)


def _table(spark, sf_dir):
    return [(r.doc_id, (r.text or "").encode()) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]


def test_whole_table_bytes(spark, sf_dir):
    expected = {d: (n, r, s, hashlib.sha256(k).hexdigest()) for d, n, r, s, k in brute_bytes(_table(spark, sf_dir), 50)}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op7_suffix_array_dedup"](spark, sf_dir).collect()}
    assert got == expected


def test_whole_table_words(spark, sf_dir):
    expected = {d: (n, r, hashlib.sha256(k).hexdigest()) for d, n, r, k in brute_words(_table(spark, sf_dir), 20)}
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in QUERIES["op8_substring_dedup"](spark, sf_dir).collect()}
    assert got == expected
    assert any(r for _, r, _ in got.values())


def test_input_that_changes_between_runs_fails(spark):
    """Answers belong to the chunk that asked; a chunk with other rows must not take them."""
    from batchloom.llm.phrases import repeats
    from batchloom.llm.substring_dedup import word_items

    import pyarrow as pa

    items, _ = word_items(pa.table({"doc_id": [1], "text": ["a b c d e f g h"]}))
    with pytest.raises(KeyError):
        repeats(items, 4, 2, 8, {})


def test_counts_of_anchors_are_true_totals():
    import pyarrow as pa

    from batchloom.llm.phrases import answer_anchors, ask_anchors
    from batchloom.llm.routing import load
    from batchloom.llm.substring_dedup import word_items

    for times, hot in ((700, True), (100, False)):
        items, _ = word_items(pa.table({"doc_id": [1], "text": ["w " * times]}))
        asked = [data for _, data in ask_anchors(items, 20, 8, 4)]
        assert [list(load(a)) for a in answer_anchors(asked, 400)] == [[2 if hot else 1]]
