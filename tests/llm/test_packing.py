"""Packing against a plain tokenizer run, and the plan against its own rules."""

import functools
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from batchloom.llm.packing import pack, plan
from batchloom.llm.queries import QUERIES, byte_level_tokenizer
from batchloom.llm.tokens import Encoder

ODD = ["", " ", "  ", "a  b", " a", "a ", "a \n b", "\n\nx  \n y", "it's 12 o'clock!!", "ein  wort 　 x", "é è", "a\tb  \t c",
       "<|endoftext|> x", "x <|endoftext|> y", "y <|endoftext|>", "<|endoftext|>  z<|endoftext|><|endoftext|>\n<|endoftext", "naïve café 日本語 テスト", "x" * 3000, "a b " * 2000, "\x1c \x85 z"]


@pytest.fixture(scope="module")
def encode():
    return Encoder(byte_level_tokenizer())


@functools.cache
def public():
    """The public file as it is, apart from the library's own reading of it."""
    return Tokenizer.from_file(byte_level_tokenizer())


def plain(texts):
    return [e.ids for e in public().encode_batch(texts, add_special_tokens=False)]


def coded(encode, texts):
    ids, bounds = encode.ids(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])]


def test_ids_equal_the_tokenizer(encode):
    assert coded(encode, ODD) == plain(ODD)
    assert coded(encode, ODD[::-1] + [None]) == plain(ODD[::-1] + [""])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["<|endoftext|>", *"ab \n\t1'.é 　s"]), max_size=20).map("".join), min_size=1, max_size=4))
def test_ids_of_any_text(texts):
    encode = _shared()
    assert coded(encode, texts) == plain(texts)


_ENCODERS = []


def _shared():
    if not _ENCODERS:
        _ENCODERS.append(Encoder(byte_level_tokenizer()))
    return _ENCODERS[0]


def check(rows, texts, size):
    """``rows``: tuples of the contract; ``texts``: doc_id -> text."""
    ids = {d: [*i, 2] for d, i in zip(texts, plain(list(texts.values())))}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(ids)
    for d, own in by_doc.items():
        own.sort(key=lambda r: r.piece)
        at = 0
        for n, r in enumerate(own):
            part = ids[d][at : at + r.length]
            assert (r.piece, r.start) == (n, at)
            assert r.ids_crc32 == zlib.crc32(np.array(part, dtype="<u4").tobytes())
            assert n == 0 or r.length == size
            at += r.length
        assert at == len(ids[d])
    for own in by_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= size
    return len(by_sequence), -(-sum(map(len, ids.values())) // size)


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = QUERIES["op1_best_fit_packing"](spark, sf_dir).collect()
    used, least = check(rows, {r.doc_id: r.text for r in docs.collect()}, 1024)
    assert used <= 1.02 * least + 1


def test_edges(spark):
    rows = [(i, t, "x") for i, t in enumerate([*ODD, None, None])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length string").repartition(3)
    out = pack(docs, byte_level_tokenizer(), 64, keep_ids=True)
    got = out.collect()
    check(got, {i: t or "" for i, t, _ in rows}, 64)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in got)
    assert pack(docs.limit(0), byte_level_tokenizer()).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=300))
def test_plan_uses_every_piece_once(lengths):
    size = 64
    counts = np.bincount(lengths, minlength=size + 1)
    planned = plan(counts, size)
    used = np.zeros(size + 1, dtype=np.int64)
    for own, times in planned:
        assert times > 0 and sum(own) <= size
        for v in own:
            used[v] += times
    assert used.tolist() == counts.tolist()


def test_exact_complements_fill_sequences():
    counts = np.zeros(65, dtype=np.int64)
    for v, n in ((64, 3), (40, 5), (24, 5), (30, 2), (20, 2), (14, 2), (50, 1), (7, 1), (4, 1), (3, 1)):
        counts[v] = n
    assert all(sum(own) == 64 for own, _ in plan(counts, 64))
