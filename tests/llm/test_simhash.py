"""SimHash groups against brute force."""

import random

import numpy as np
import pytest
import xxhash

from batchloom.llm.queries import QUERIES
from batchloom.llm.simhash_dedup import allocate, fingerprints_of, link_group, links, near_duplicates, scheme


def plain_fingerprint(text, k=3):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows, radius=2):
    fps = [plain_fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, f"{fps[i]:016x}", least.get(find(i))) for i, (d, _) in enumerate(rows)), key=repr)


def corpus(seed, n=120):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdEÉ", k=rng.randint(1, 6))) for _ in range(300)]
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.5:
            words = (rng.choice(rows)[1] or "x").split()
            for _ in range(rng.randint(0, 2)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            text = " ".join(words)
        else:
            text = " ".join(rng.choices(vocabulary, k=rng.choice([1, 2, 3, 5, 80, 200, 700])))
        rows.append((i, text))
    return rows + [(None, "a b c"), (None, rows[0][1]), (n, ""), (n + 1, None), (n + 2, " \n "), rows[4], rows[4]]


@pytest.mark.parametrize("crowded", [2_000, 3])
def test_edges(spark, crowded):
    rows = corpus(crowded)
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, fp string").repartition(4)
    got = sorted(map(tuple, near_duplicates(docs, crowded=crowded).collect()), key=repr)
    assert got == plain_components(rows)
    assert near_duplicates(docs.limit(0)).count() == 0


def test_whole_table(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = sorted(map(tuple, QUERIES["op10_simhash_near_dedup"](spark, sf_dir).collect()), key=repr)
    assert got == plain_components(rows)


def test_long_text():
    text = " ".join(f"w{i % 977}" for i in range(3000))
    assert fingerprints_of([text.encode(), b"", text.encode()], 3).tolist() == [plain_fingerprint(text), 0, plain_fingerprint(text)]


def _joined(pairs):
    groups = {}
    for a, b in pairs:
        merged = groups.get(a, {a}) | groups.get(b, {b})
        for x in merged:
            groups[x] = merged
    return {frozenset(g) for g in groups.values()}


def _clusters(seed, n):
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 2**63, 20, dtype=np.uint64)
    own = centres[rng.integers(0, 20, n)]
    for _ in range(3):
        own = own ^ (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64)) * (rng.random(n) < 0.6).astype(np.uint64)
    return np.unique(own)


def _brute(own, radius):
    near = np.argwhere(np.bitwise_count(own[:, None] ^ own[None, :]) <= radius)
    return _joined((int(own[a]), int(own[b])) for a, b in near if a < b)


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
@pytest.mark.parametrize("crowded", [2_000, 2])
def test_links_have_all_components(spark, radius, crowded):
    own = _clusters(radius, 500)
    for total in (len(own), 10**9):  # few fingerprints, and a choice made for very many
        parts = scheme(own, total, radius)
        nodes = spark.createDataFrame([(int(x),) for x in own.view(np.int64)], "fp long")
        got = [(r.a % 2**64, r.b % 2**64) for r in links(nodes, parts, radius, crowded).collect()]
        assert _joined(got) == _brute(own, radius)
        assert len(got) <= 64 * len(own)


def test_group_by_lookup_equals_group_by_comparison():
    own = _clusters(5, 400)
    few = link_group(own, own[:0], 2)
    assert _joined(zip(few[0].tolist(), few[1].tolist())) == _brute(own, 2)


def test_thresholds_add_up():
    total, chosen = allocate(np.array([[0, 5.0, 9], [0, 1.0, 3], [0, 2.0, 4]]), 0)
    assert (total, sum(chosen)) == (5.0, 0) or sum(chosen) == 0
    assert sum(allocate(np.random.default_rng(1).random((4, 4)), -1)[1]) == -1
