"""Fold several kinds of facts into one row per key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchloom.functions import flag, from_cents

KIND = "kind"


@dataclass(frozen=True)
class Measure:
    """Output column ``name``: ``agg`` of ``source`` over the rows of one kind, 0 for the others.

    ``agg`` is ``sum``, ``sum0`` (a sum whose NULL is 0), ``max`` or ``present`` (1 if the kind has any row).
    With ``cents`` the source holds whole cents and the output is money.
    """

    name: str
    kind: str
    type: T.DataType
    agg: str = "sum"
    source: str | None = None
    cents: bool = False


def _present(kind: str) -> str:
    return f"__has_{kind}"


def sum_by_kind(events: DataFrame, keys: Sequence[str | Column], measures: Sequence[Measure]) -> DataFrame:
    """One grouping for all kinds: a column per measure plus a 0/1 presence column per kind.

    Rows of every kind share one shuffle and are combined before it, so a key that holds a
    large share of the facts reaches its task as one row per map task.
    """
    kinds = list(dict.fromkeys(m.kind for m in measures))
    aggs = [F.max(flag(F.col(KIND) == k)).alias(_present(k)) for k in kinds]
    for m in measures:
        if m.agg == "present":
            continue
        value = F.when(F.col(KIND) == m.kind, F.col(m.source or m.name))
        total = F.max(value) if m.agg == "max" else F.sum(value)
        aggs.append((F.coalesce(total, F.lit(0)) if m.agg == "sum0" else total).alias(m.name))
    return events.groupBy(*keys).agg(*aggs)


def combine_kinds(folded: DataFrame, keys: Sequence[str], measures: Sequence[Measure], combine: str = "max") -> DataFrame:
    """Merge the kinds as MAX (or SUM) over one row per kind that holds 0 in the other kinds' columns.

    With MAX a negative amount therefore loses to the 0 of another kind present on the same key.
    """
    if combine not in ("max", "sum"):
        raise ValueError(f"combine must be max or sum, not {combine!r}")
    kinds = list(dict.fromkeys(m.kind for m in measures))
    alone = reduce(lambda a, b: a + b, [F.col(_present(k)) for k in kinds]) == 1

    def merged(m: Measure) -> Column:
        here = F.col(_present(m.kind)) == 1
        if m.agg == "present":
            return F.col(_present(m.kind))
        value = from_cents(F.col(m.name)) if m.cents else F.col(m.name)
        shared = F.greatest(value, F.lit(0)) if combine == "max" else F.coalesce(value, F.lit(0))
        return F.when(~here, F.lit(0)).when(alone, value).otherwise(shared)

    return folded.select(*keys, *[merged(m).cast(m.type).alias(m.name) for m in measures])


def union_branches(
    branches: Mapping[str, DataFrame], keys: Sequence[str], measures: Sequence[Measure], combine: str = "max"
) -> DataFrame:
    """UNION ALL the branches by name, tag each with its kind, fold to one row per key."""
    tagged = [df.withColumn(KIND, F.lit(kind)) for kind, df in branches.items()]
    events = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    return combine_kinds(sum_by_kind(events, keys, measures), keys, measures, combine)
