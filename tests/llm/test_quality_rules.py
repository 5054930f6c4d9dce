"""Quality rules against plain counting; the cascade's order never changes a verdict."""

import re
from collections import Counter
from itertools import permutations

import numpy as np

from batchloom.llm import quality_rules as module
from batchloom.llm.quality_rules import RULES, Sample, judge, ordered, quality_rules
from batchloom.llm.queries import QUERIES
from batchloom.llm.texts import Texts

WORD = r"[^\x20\x09-\x0D]+"


def plain(text):
    words = re.findall(WORD, text or "")
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if re.search(WORD, line):
            again += line in seen
            seen.add(line)
    n = len(words)
    failed = n < 10 or 100 * len(covered) > 20 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), again, len(covered), failed


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
EDGES = [None, "", " \n\t", "a b c d e f g h i j", "é日本 x " * 40, "same line\nsame line\n same line\n\n\n", "### $$ %% || <> & * " * 30,
         "LOUD!! WORDS!! " * 20, "\x85   \x1c a", "w " * 9, "1 2 3 4 5 6 7 8 9 10 11", "long " + "x" * 50_000 + " tail" * 3]


def test_edges(spark):
    rows = [(i, t, True) for i, t in enumerate(EDGES)] + [(None, "a b c", True), (3, EDGES[3], True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept boolean").repartition(3)
    got = sorted(((r.doc_id, *(r[c] for c in COLUMNS)) for r in quality_rules(docs).collect()), key=repr)
    assert got == sorted(((d, *plain(t)) for d, t, _ in rows), key=repr)
    assert all(r.kept == (r.failed_rule is None) and not (r.base_failed and r.kept) for r in quality_rules(docs).collect())
    assert quality_rules(docs.limit(0)).count() == 0


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    got = {r.doc_id: r for r in QUERIES["op9_quality_rules"](spark, sf_dir).collect()}
    assert len(got) == len(docs)
    for d in docs:
        assert tuple(got[d.doc_id][c] for c in COLUMNS) == plain(d.text)


def test_verdicts_do_not_depend_on_the_order(spark):
    texts = Texts([(t or "").encode() for t in EDGES])
    alone = np.zeros(len(EDGES), dtype=bool)
    for rule in RULES:
        alone |= np.asarray(rule.rejects(texts), dtype=bool)
    for rules in list(permutations(RULES))[::97]:
        assert [f is not None for f in judge(texts, rules)] == alone.tolist()


def test_names_do_not_depend_on_the_order(spark, monkeypatch):
    texts = ["### $$ %% || <> & * LOUD!! WORDS!! " * 9, "LOUD!! WORDS!! 1234567 1234567 1234567 " * 9, *[t for t in EDGES if t]]
    texts = [" ".join(f"{w}{i}" if w.islower() else w + "!" * (i % 3) for i, w in enumerate(t.split())) for t in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = []
    for rules in (RULES, RULES[::-1], RULES[3:] + RULES[:3]):
        monkeypatch.setattr(module, "ordered", lambda *_, own=rules: own)
        found.append(sorted((r.doc_id, r.failed_rule or "") for r in quality_rules(docs).collect()))
    assert found[0] == found[1] == found[2]
    both = Texts(["### ABC!! DEF!! GHI!! ".encode() * 9])
    assert judge(both, RULES) != judge(both, RULES[::-1])
    for rules in list(permutations(RULES))[::97]:
        assert module.first_declared(both, judge(both, rules), RULES, rules) == judge(both, RULES)


def test_order_is_by_rejections_per_cost(spark):
    found = ordered(RULES[:3], {RULES[0].name: (2.0, 0.5), RULES[1].name: (1.0, 0.5), RULES[2].name: (0.1, 0.0)})
    assert [r.name for r in found] == [RULES[1].name, RULES[0].name, RULES[2].name]


def test_measured_on_a_sample():
    texts = Texts([(t or "").encode() for t in EDGES])
    sample = Sample(RULES, len(EDGES) + 2)
    assert set(sample.measured().values()) == {(0.0, 0.0)}
    sample.add(texts)
    assert sample.n == len(EDGES) and not sample.full
    for rule in RULES:
        cost, share = sample.measured()[rule.name]
        assert cost > 0 and share == np.count_nonzero(rule.rejects(texts)) / len(EDGES)
    sample.add(texts)
    assert sample.n == len(EDGES) + 2 and sample.full


def test_one_scan_and_nothing_moved(spark, sf_dir, capsys):
    QUERIES["op9_quality_rules"](spark, sf_dir).explain("formatted")
    plan = capsys.readouterr().out
    assert plan.count("Location:") == 1 and "Exchange" not in plan


def test_small_samples_give_the_same_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = [sorted(map(tuple, quality_rules(docs, sample_rows=n).collect())) for n in (0, 1, 10**6)]
    assert found[0] == found[1] == found[2] and len(found[0]) == docs.count()


def test_good_documents_stay_and_bad_ones_go(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = QUERIES["op9_quality_rules"](spark, folder).join(labels, "doc_id").collect()
    good, bad = [r.kept for r in rows if r.quality and r.n_words >= 10], [r.kept for r in rows if not r.quality]
    assert sum(good) > 0.98 * len(good) and sum(bad) < 0.05 * len(bad)
