"""Rank facts inside an entity without gathering one entity's facts in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def rank_by_day(facts: DataFrame, entity: str, day: str, out: str = "rank1") -> DataFrame:
    """RANK() over (partition by entity order by day), ties sharing a rank.

    Facts are counted per (entity, day) first. The running sum over days then sees at most one
    row per calendar day of an entity, however many facts it has, and is joined back.
    """
    per_day = facts.groupBy(entity, day).agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy(entity).orderBy(day).rowsBetween(Window.unboundedPreceding, -1)
    ranks = per_day.select(
        F.col(entity).alias("__e"), F.col(day).alias("__d"),
        (F.coalesce(F.sum("__n").over(earlier), F.lit(0)) + 1).alias(out),
    )
    same = facts[entity].eqNullSafe(ranks["__e"]) & facts[day].eqNullSafe(ranks["__d"])
    return facts.join(ranks, same).drop("__e", "__d")


def first_day(facts: DataFrame, entity: str, day: str, out: str) -> DataFrame:
    """The day every entity holds rank 1 on."""
    return facts.groupBy(entity).agg(F.min(day).alias(out))
