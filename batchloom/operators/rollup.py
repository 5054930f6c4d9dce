"""Month roll-ups of daily rows and their accumulation into month tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchloom.functions import any_flag, first_of_month, flag, from_cents, saturating_flag, to_cents

MONTH = "start_of_the_month_date"
#: The days of a (month, key), as an array of daily rows.
DAYS = "days"
#: The month of a daily row, where rows were brought together by it and still carry it.
DAY_MONTH = "__day_month"


def days_by_month(daily: DataFrame, key: str, day: str = "summary_date") -> DataFrame:
    """One row per (month, key) with its days, at most 31 if they do not repeat: what is stored so is rolled up without a shuffle.

    Each task's rows are in order of their keys, in which they and their days take less room.
    """
    others = [c for c in daily.columns if c not in (key, DAY_MONTH)]
    month = F.col(DAY_MONTH) if DAY_MONTH in daily.columns else first_of_month(day)
    months = daily.groupBy(month.alias(MONTH), F.col(key)).agg(F.collect_list(F.struct(*others)).alias(DAYS))
    return months.sortWithinPartitions(MONTH, key)


def days_of(months: DataFrame) -> DataFrame:
    """The daily rows of ``days_by_month``."""
    [key] = [c for c in months.columns if c not in (MONTH, DAYS)]
    return months.select(key, F.explode(DAYS).alias("day")).select(key, "day.*")


def rollup_month(
    daily: DataFrame,
    key: str,
    sums: Sequence[str],
    maxes: Sequence[str] = (),
    flags: Mapping[str, str] | None = None,
    day: str = "summary_date",
) -> DataFrame:
    """One row per (month, key): sums, maxima, and 0/1 flags saying a daily column was ever positive.

    Of ``days_by_month`` each row is rolled up by itself; its summed columns are counts or money.
    """
    if DAYS in daily.columns:
        return _rollup_days(daily, key, sums, maxes, flags or {})

    def total(c: str) -> Column:
        kind = daily.schema[c].dataType
        money = isinstance(kind, T.DecimalType) and kind.scale == 2
        return from_cents(F.sum(to_cents(F.col(c)))) if money else F.sum(c)

    aggs = [total(c).alias(c) for c in sums] + [F.max(c).alias(c) for c in maxes]
    aggs += [flag(F.max(source) > 0).alias(name) for name, source in (flags or {}).items()]
    return daily.groupBy(first_of_month(day).alias(MONTH), F.col(key)).agg(*aggs)


def _rollup_days(months: DataFrame, key: str, sums: Sequence[str], maxes: Sequence[str], flags: Mapping[str, str]) -> DataFrame:
    types = {f.name: f.dataType for f in months.schema[DAYS].dataType.elementType.fields}

    def total(c: str) -> Column:
        money = isinstance(types[c], T.DecimalType)

        def plus(before: Column, day: Column) -> Column:
            value = to_cents(day[c]) if money else day[c].cast("bigint")
            return F.coalesce(before + value, before, value)

        # One pass over the days, in which no further array is made. A sum of no values is NULL.
        added = F.aggregate(DAYS, F.lit(None).cast("bigint"), plus)
        return from_cents(added) if money else added

    def most(c: str) -> Column:
        return F.array_max(F.col(DAYS)[c])

    aggs = [total(c).alias(c) for c in sums] + [most(c).alias(c) for c in maxes]
    aggs += [flag(most(source) > 0).alias(name) for name, source in flags.items()]
    return months.select(MONTH, key, *aggs)


def accumulate(
    target: DataFrame,
    delta: DataFrame,
    keys: Sequence[str],
    adds: Sequence[str] = (),
    ors: Sequence[str] = (),
    greatests: Sequence[str] = (),
    saturates: Mapping[str, str] | None = None,
    replaces: Sequence[str] = (),
    update_stamps: Mapping[str, Column] | None = None,
    insert_stamps: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Fold ``delta`` rows into ``target`` rows of the same key; new keys are inserted as they are.

    Known keys: ``adds`` are added, ``ors`` are OR-ed, ``greatests`` keep the larger value,
    ``saturates`` maps a flag to the delta column added to it (at most 1), ``replaces`` take the
    delta value, other columns stay. Adding is not idempotent: the same delta must be applied once.
    """
    saturates, update_stamps, insert_stamps = dict(saturates or {}), dict(update_stamps or {}), dict(insert_stamps or {})
    old = target.select(*[F.col(c) if c in keys else F.col(c).alias("__t_" + c) for c in target.columns], F.lit(True).alias("__in_t"))
    new = delta.select(*keys, *[F.col(c).alias("__d_" + c) for c in delta.columns if c not in keys], F.lit(True).alias("__in_d"))
    joined = old.join(new, list(keys), "full_outer")
    in_target, in_delta = F.col("__in_t").isNotNull(), F.col("__in_d").isNotNull()

    out = []
    for field in target.schema.fields:
        c = field.name
        if c in keys:
            out.append(F.col(c))
            continue
        t, d = F.col("__t_" + c), F.col("__d_" + c) if c in delta.columns else F.lit(None)
        if c in adds:
            both = F.coalesce(t, F.lit(0)) + d
        elif c in ors:
            both = any_flag(t, d)
        elif c in greatests:
            both = F.greatest(t, d)
        elif c in saturates:
            both = saturating_flag(t, F.col("__d_" + saturates[c]))
        elif c in replaces:
            both = d
        else:
            both = update_stamps.get(c, t)
        first = insert_stamps.get(c, d)
        out.append(
            F.when(in_target & in_delta, both).when(in_delta, first).otherwise(t).cast(field.dataType).alias(c)
        )
    return joined.select(*out)


def missing_months(daily: DataFrame, target: DataFrame, key: str, day: str = "summary_date") -> DataFrame:
    """Daily rows of (month, key) pairs the month table does not hold yet, whatever their date."""
    tagged = daily.withColumn(MONTH, first_of_month(day))
    return tagged.join(target.select(MONTH, key), [MONTH, key], "left_anti").drop(MONTH)
