"""Leaks against brute force over all windows."""

import random
from collections import Counter

import pytest
import xxhash

from batchloom.llm.decontamination import find_leaks
from batchloom.llm.queries import QUERIES


def plain_simhash(words):
    hashes = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def bag(words, gram):
    return Counter(tuple(words[i : i + gram]) for i in range(max(1, len(words) - gram + 1)))


def brute(docs, items, radius=14, similarity=0.8, near=None):
    out, lost = [], 0
    for item_id, text in items:
        own = (text or "").lower().split()
        if not own:
            continue
        gram = min(5, len(own))
        want, print_ = bag(own, gram), plain_simhash(own)
        for doc_id, doc in docs:
            words = (doc or "").lower().split()
            if not words or not (bag(words, gram).keys() & want.keys()):
                continue
            best = None
            for start in range(max(1, len(words) - len(own) + 1)):
                window = words[start : start + len(own)]
                got = bag(window, gram)
                common = sum((got & want).values())
                like = common / (sum(got.values()) + sum(want.values()) - common)
                if like >= similarity:
                    distance = (plain_simhash(window) ^ print_).bit_count()
                    if distance > radius:
                        lost += 1
                    elif best is None or like > best[1]:
                        best = (start, like, distance)
            if best:
                out.append((doc_id, item_id, *best))
    return sorted(out, key=repr), lost


def corpus():
    rng = random.Random(3)
    vocabulary = ["".join(rng.choices("abcdeé", k=rng.randint(2, 7))) for _ in range(300)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(6, 60)))) for i in range(12)]
    items += [(50, "Three little words"), (51, None), (52, " "), (53, "one"), (54, items[0][1]), (55, "x y " * 20)]
    docs = []
    for i in range(150):
        words = rng.choices(vocabulary, k=rng.randint(0, 150))
        for _ in range(rng.randint(0, 2)):
            passage = (rng.choice(items)[1] or "").split() if rng.random() < 0.8 and i % 3 else []
            for _ in range(rng.randint(0, 2)):
                if passage:
                    passage[rng.randrange(len(passage))] = rng.choice(vocabulary)
            at = rng.randint(0, len(words))
            words[at:at] = passage
        docs.append((i, rng.choice([" ", "\n", " \t"]).join(words)))
    docs += [(None, items[2][1].upper()), (900, None), (901, ""), (902, "one"), (903, items[3][1][:-12]), docs[4], docs[4], (904, "x y " * 500)]
    return docs, [i for i in items if i[1] is not None] + [(51, None)]


@pytest.mark.parametrize("block_shingles", [50_000, 100])
def test_edges(spark, block_shingles):
    docs, items = corpus()
    d = spark.createDataFrame([(a, b, "x", 1) for a, b in docs], "doc_id long, text string, words string, n int").repartition(3)
    b = spark.createDataFrame([(a, b, "x") for a, b in items], "item_id long, text string, item string")
    got = sorted(((r.doc_id, r.item_id, r.start, r.similarity, r.distance) for r in find_leaks(d, b, block_shingles=block_shingles).collect()), key=repr)
    expected, lost = brute(docs, items)
    assert got == expected
    assert len(expected) > 30 and lost == 0


def test_nothing(spark):
    docs, items = corpus()
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    assert find_leaks(d, b.limit(0)).count() == 0
    assert find_leaks(d.limit(0), b).count() == 0


def test_whole_table(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    result = QUERIES["op6_benchmark_decontamination"](spark, sf_dir)
    got = sorted(((r.doc_id, r.item_id, r.start, r.similarity, r.distance) for r in result.collect()), key=repr)
    assert got == brute(docs, items)[0] and got


def test_similar_windows_beyond_the_radius(spark):
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdeé", k=rng.randint(2, 7))) for _ in range(2000)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([40, 59, 100])))) for i in range(300)]
    docs = []
    for i, text in items:  # cut off at one end to the least length that still has the similarity
        words = text.split()
        left = 4 + -(-(len(words) - 4) * 4 // 5)
        words = words[:left] if i % 2 else words[-left:]
        filler = rng.choices(vocabulary, k=200) if i % 3 == 0 else []
        docs.append((i, " ".join([*filler[:100], *words, *filler[100:]])))
    expected, _ = brute(docs, items, radius=64)
    assert brute(docs, items)[1] > 0 and max(d for *_, d in expected) > 14
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = sorted(((r.doc_id, r.item_id, r.start, r.similarity, r.distance) for r in find_leaks(d, b).collect()), key=repr)
    assert got == expected


def test_whole_table_without_a_radius(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    result = QUERIES["op6_benchmark_decontamination"](spark, sf_dir)
    got = sorted(((r.doc_id, r.item_id, r.start, r.similarity, r.distance) for r in result.collect()), key=repr)
    assert got == brute(docs, items, radius=64)[0] and got


def test_no_python_in_the_plan(spark, sf_dir, capsys):
    QUERIES["op6_benchmark_decontamination"](spark, sf_dir).explain("formatted")
    plan = capsys.readouterr().out
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
