"""Quality rules as a short-circuit cascade.

Every rule looks at one statistic of a whole text and may reject it. Each task measures the cost (seconds per text) and the
selectivity (share of rejected texts) of each rule on a sample, the first texts it meets that pass the base rules, and orders
the rules by rejections per second. So the table is scanned once, no sample is moved, and parts of the table that differ get
orders of their own. A text meets the rules in that order and leaves at the first one that rejects it, so that a costly
statistic is worked out only for texts that got so far. The order changes the cost, never the verdict: a text is kept if no
rule rejects it. The rule that is reported is the first one in declared order that rejects the text; rejected texts meet the
rules declared before the one that stopped them for that.

Null texts count as empty; texts without words are rejected by ``few_words``. A null ``doc_id`` stays null. Repeated rows
are judged one by one, an empty table gives no rows, other columns are read only if they are named in ``keep``.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchloom.llm.texts import Texts, binaries, pieces

UPPER = bytes(range(65, 91))
LETTERS = UPPER + bytes(range(97, 123))
DIGITS = b"0123456789"
SYMBOLS = b"#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """``rejects`` gives for a few texts which of them the rule turns down."""

    name: str
    rejects: Callable[[Texts], np.ndarray]


#: The two rules every text has to pass first, then those that the cascade orders.
BASE_RULES = (
    Rule("few_words", lambda t: t.n_words < 10),
    Rule("repeated_windows", lambda t: 100 * t.n_repeat_words > 20 * t.n_words),
)
RULES = (
    Rule("symbols", lambda t: 10 * t.count_bytes(SYMBOLS) > t.n_words),
    Rule("exclamations", lambda t: 10 * t.count_bytes(b"!") > 2 * t.n_words),
    Rule("capitals", lambda t: 10 * t.count_bytes(UPPER) > 4 * np.maximum(1, t.count_bytes(LETTERS))),
    Rule("digits", lambda t: 10 * t.count_bytes(DIGITS) > 5 * np.maximum(1, t.word_chars)),
    Rule("word_length", lambda t: (t.word_chars > 20 * t.n_words) | (t.word_chars < 2 * t.n_words)),
    Rule("repeated_lines", lambda t: 10 * t.lines[1] > 6 * np.maximum(1, t.lines[0])),
)


class Sample:
    """Seconds and rejections of each rule on the first texts that a task meets, ``limit`` at most."""

    def __init__(self, rules, limit: int):
        self.rules, self.limit, self.n = rules, limit, 0
        self.seconds = {r.name: 0.0 for r in rules}
        self.hits = {r.name: 0 for r in rules}

    @property
    def full(self) -> bool:
        return self.n >= self.limit

    def add(self, texts: Texts) -> None:
        some = texts.texts[: self.limit - self.n]
        for rule in self.rules:
            fresh = Texts(some)
            fresh.words  # noqa: B018  every text is parted into words in any case
            started = time.perf_counter()
            self.hits[rule.name] += int(np.count_nonzero(rule.rejects(fresh)))
            self.seconds[rule.name] += time.perf_counter() - started
        self.n += len(some)

    def measured(self) -> dict[str, tuple[float, float]]:
        """Cost in seconds per text and share of rejected texts of each rule."""
        n = max(1, self.n)
        return {r.name: (self.seconds[r.name] / n, self.hits[r.name] / n) for r in self.rules}


def ordered(rules, measured: dict[str, tuple[float, float]]) -> tuple[Rule, ...]:
    """The rules by rejections per second, the best first."""
    return tuple(sorted(rules, key=lambda r: -measured[r.name][1] / max(measured[r.name][0], 1e-9)))


def judge(texts: Texts, rules) -> list[str | None]:
    """The first rule that rejects each text; every rule sees only the texts left by those before it."""
    failed: list[str | None] = [None] * len(texts)
    left, at = texts, np.arange(len(texts))
    for rule in rules:
        if not len(at):
            break
        hit = np.asarray(rule.rejects(left), dtype=bool)
        if hit.any():
            for i in at[hit]:
                failed[i] = rule.name
            left, at = left.take(~hit), at[~hit]
    return failed


def first_declared(texts: Texts, failed: list[str | None], rules, cascade) -> list[str | None]:
    """The first of ``rules``, in their own order, that rejects each text which ``cascade`` found ``failed``."""
    declared, met = ({r.name: i for i, r in enumerate(x)} for x in (rules, cascade))
    named = list(failed)
    for rule in reversed(rules):
        open_ = np.array([f is not None and declared[rule.name] < declared[f] and met[rule.name] > met[f] for f in failed], dtype=bool)
        if open_.any():
            for i in np.flatnonzero(open_)[np.asarray(rule.rejects(texts.take(open_)), dtype=bool)]:
                named[i] = rule.name
    return named


def quality_rules(docs: DataFrame, rules=RULES, sample_rows: int = 200, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: base statistics, ``base_failed``, ``kept`` and the first declared rule that rejects it.

    Columns: doc_id, those of ``keep``, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, failed_rule.
    Each task measures the rules on its first ``sample_rows`` texts.
    """
    carried = ["doc_id", *[c for c in keep if c != "doc_id"]]
    source = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), *[c for c in keep if c not in ("doc_id", "text")])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample, cascade = Sample(rules, sample_rows), tuple(rules)
        for batch in batches:
            for part in pieces(batch):
                texts = Texts(binaries(part.column("text")))
                base = [np.asarray(r.rejects(texts), dtype=bool) for r in BASE_RULES]
                base_failed = base[0] | base[1]
                failed = np.full(len(texts), None, dtype=object)
                failed[base[1]] = BASE_RULES[1].name
                failed[base[0]] = BASE_RULES[0].name
                left = texts.take(~base_failed)
                if len(left) and not sample.full:
                    sample.add(left)
                    cascade = ordered(rules, sample.measured())
                failed[~base_failed] = first_declared(left, judge(left, cascade), rules, cascade)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[part.column(c) for c in carried],
                        pa.array(texts.n_words),
                        pa.array(texts.word_chars),
                        pa.array(texts.count_bytes(SYMBOLS)),
                        pa.array(texts.lines[1]),
                        pa.array(texts.n_repeat_words),
                        pa.array(base_failed),
                        pa.array([f is None for f in failed], pa.bool_()),
                        pa.array(list(failed), pa.string()),
                    ],
                    [*carried, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed_rule"],
                )

    schema = source.select(*carried).schema
    for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"):
        schema = schema.add(name, "long")
    return source.mapInArrow(apply, schema.add("base_failed", "boolean").add("kept", "boolean").add("failed_rule", "string"))
