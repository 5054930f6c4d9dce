"""Packing by differencing against a plain tokenizer run, and the windows against their own rules."""

import zlib
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from test_packing import ODD, plain

from batchloom.llm.differencing import difference, level, pack_evenly, windows
from batchloom.llm.queries import QUERIES, byte_level_tokenizer


def check(rows, texts, size):
    """``rows``: tuples of the contract; ``texts``: (doc_id, text). Gives the padding of all sequences."""
    ids = {d: [*i, 0] for (d, _), i in zip(texts, plain([t or "" for _, t in texts]))}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(ids)
    for d, own in by_doc.items():
        at = 0
        for r in sorted(own, key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids[d])
            assert r.ids_crc32 == zlib.crc32(np.array(ids[d][at : at + r.length], dtype="<u4").tobytes())
            at += r.length
        assert at == len(ids[d])
    padding = 0
    for own in by_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= size
        padding += 0 if at & (at - 1) == 0 else size - at
    return padding


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert check(QUERIES["op12_packing"](spark, sf_dir).collect(), [(r.doc_id, r.text) for r in docs], 1024) == 0


def test_edges(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate([*ODD, None, None])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length string, start int").repartition(3)
    got = pack_evenly(docs, byte_level_tokenizer(), 64, keep_ids=True).collect()
    assert check(got, [(i, t) for i, t, *_ in rows], 64) == 0
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in got)
    assert pack_evenly(docs.limit(0), byte_level_tokenizer()).count() == 0


def test_repeated_rows_and_missing_ids(spark):
    docs = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (4, "d"), (4, "d")], "doc_id long, text string").coalesce(1)
    got = pack_evenly(docs, byte_level_tokenizer()).collect()
    assert sorted((r.doc_id or -1, r.doc_tokens) for r in got if r.start == 0) == [(-1, 4), (-1, 4), (4, 2), (4, 2)]
    assert sum(r.length for r in got) == 12


lengths = st.lists(st.integers(1, 64), max_size=120).map(lambda x: np.array(x, dtype=np.int64))


@settings(max_examples=100, deadline=None)
@given(lengths, st.integers(1, 40))
def test_differencing_deals_every_item_once(own, k):
    dealt = difference(own, k)
    assert len(dealt) == k
    assert sorted(i for w in dealt for i in w) == list(range(len(own)))


@settings(max_examples=60, deadline=None)
@given(lengths)
def test_windows_hold_their_capacity_and_level_without_padding(own):
    dealt = windows(own, 64)
    assert all(own[w].sum() <= 64 for w in dealt)
    sequences = level(dealt, own, 64)
    covered = [np.zeros(n, dtype=int) for n in own]
    for s in sequences:
        total = sum(n for _, _, n in s)
        assert 0 < total <= 64 and total & (total - 1) == 0
        for item, first, n in s:
            covered[item][first : first + n] += 1
    assert all((c == 1).all() for c in covered)


def two_way(numbers):
    """Differencing into two parts, as the textbook has it: replace the two largest by their difference."""
    left = sorted(numbers)
    while len(left) > 1:
        a, b = left.pop(), left.pop()
        left = sorted([*left, a - b])
    return left[0]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 1000), min_size=1, max_size=30))
def test_two_windows_differ_as_in_plain_differencing(numbers):
    own = np.array(numbers, dtype=np.int64)
    a, b = (int(own[w].sum()) for w in difference(own, 2))
    assert a - b == two_way(numbers)


def test_windows_are_nearly_equal_and_few():
    rng = np.random.default_rng(3)
    own = rng.integers(1, 1025, 1024)
    dealt = windows(own, 1024)
    sums = np.array([own[w].sum() for w in dealt])
    assert len(dealt) <= 1.06 * own.sum() / 1024
    small = rng.integers(1, 200, 1024)
    sums = np.array([small[w].sum() for w in difference(small, 100)])
    assert np.ptp(sums) <= 4
