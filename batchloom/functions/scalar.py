"""Column expressions shared by the loads. All are built-in functions, so they stay in codegen."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def first_of_month(day: Column | str) -> Column:
    """First day of the month, as DATE."""
    return F.trunc(day, "MM")


def day_before(day: dt.date) -> Column:
    """DATE literal of the previous day."""
    return F.lit(day - dt.timedelta(days=1)).cast("date")


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also for NULL)."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def any_flag(a: Column, b: Column) -> Column:
    """Bitwise OR of two 0/1 flags; a missing flag counts as 0."""
    return F.coalesce(a, F.lit(0)).bitwiseOR(F.coalesce(b, F.lit(0))).cast("int")


def saturating_flag(old: Column, new: Column) -> Column:
    """Add a flag to an older one, never above 1."""
    return F.least(F.coalesce(old, F.lit(0)) + new, F.lit(1)).cast("int")


def to_cents(amount: Column) -> Column:
    """Money with two decimals as whole cents. Sums of BIGINT cents are exact and far cheaper than wide decimals."""
    return (amount * F.lit(100)).cast("bigint")


def from_cents(cents: Column) -> Column:
    """Whole cents back as DECIMAL(18,2)."""
    return (cents.cast("decimal(18,0)") * F.lit(Decimal("0.01"))).cast("decimal(18,2)")


def stamp(moment: dt.datetime) -> Column:
    """Run-start timestamp literal, read in the session time zone."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared columns in declared order; columns the input lacks become typed NULL."""
    present = {c.lower() for c in df.columns}
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows of the schema; the optimizer sees an empty relation."""
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(1).where(F.lit(False)).select(*none)
