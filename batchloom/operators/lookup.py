"""Foreign-key lookups and hierarchy links."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchloom.sources.files import COMPRESSION, write_scratch

#: Numbers, at most about 50 MB in memory, that are sent to the rows of another table.
_FEW = 1_000_000
#: Bytes in memory up to which Spark may send one side of a join to every task.
_SENT_BYTES = 32 << 20


def measured(side: DataFrame, counted: DataFrame | None = None) -> DataFrame:
    """A side of a join that Spark may send to every task only if its rows, counted, take little memory.

    Spark goes by the size of files, where sorted, compressed keys take a small part of what they do in the table that the driver
    builds of them. A larger side is joined by sorting. ``counted`` has the rows of the side where these are cheaper to count; that
    should be a stored table.
    """
    # A row takes about 16 bytes a column, a short text 64 more, and 32 in the table of keys.
    width = 32 + sum(80 if isinstance(f.dataType, T.StringType) else 16 for f in side.schema.fields)
    return side if (side if counted is None else counted).count() * width <= _SENT_BYTES else side.hint("merge")


def lookup(
    df: DataFrame, dim: DataFrame, on: str, key: str, take: Mapping[str, str], how: str = "left"
) -> DataFrame:
    """Add columns of ``dim`` to ``df`` where ``df.on = dim.key``.

    ``take`` maps dimension columns to output names; ``inner`` drops unmatched rows, ``left``
    leaves NULL. No broadcast is forced: Spark broadcasts the narrow dimension side only while
    the size of its files is under the threshold (``measured`` goes by its rows), and otherwise
    sort-merges, where adaptive execution splits partitions of a hot key.
    """
    narrow = dim.select(F.col(key).alias("__key"), *[F.col(c).alias(a) for c, a in take.items()])
    joined = df.join(narrow, df[on] == narrow["__key"], how)
    return joined.drop("__key")


def lookup_bucketed(
    df: DataFrame, dim: DataFrame, on: str, key: str, take: Mapping[str, str], how: str = "left"
) -> DataFrame:
    """``lookup`` in a dimension that is stored in buckets of ``key`` and too large to move.

    Only the rows found, at most one for each different key, meet ``df``. They are stored first: that join is then planned by their
    size and, unlike one with the buckets themselves, can split a hot key.
    """
    found = measured(write_scratch(matches(df, dim, on, key, take), "matches", COMPRESSION))
    joined = df.join(found, df[on] == found["__key"], how)
    return joined.drop("__key")


def matches(df: DataFrame, dim: DataFrame, on: str, key: str, take: Mapping[str, str]) -> DataFrame:
    """The dimension's rows for the different keys of ``df``, which go to the buckets; the dimension is not exchanged."""
    wanted = df.select(F.col(on).alias("__wanted")).dropna().distinct()
    narrow = dim.select(F.col(key).alias("__key"), *[F.col(c).alias(a) for c, a in take.items()])
    return wanted.join(narrow, wanted["__wanted"] == narrow["__key"]).drop("__wanted")


def of_few(rows: DataFrame, key: str, wanted: DataFrame, on: str) -> DataFrame:
    """The rows whose key is among the wanted ones, if these are few: they are sent to the rows, whose others are then not exchanged."""
    keys = wanted.select(F.col(on).alias(key)).dropna().distinct()
    # Counted, as the size of what is left of a plan's rows is unknown.
    return rows.join(F.broadcast(keys), key, "left_semi") if keys.count() <= _FEW else rows


def link_parent(df: DataFrame, parent_on: str, key: str, id_col: str, out: str, none_value: int | None = None) -> DataFrame:
    """Self lookup for a hierarchy: ``out`` is the ``id_col`` of the row whose key is ``parent_on``."""
    columns = df.columns
    linked = lookup(df.drop(out), df, parent_on, key, {id_col: out})
    if none_value is not None:
        linked = linked.withColumn(out, F.coalesce(F.col(out), F.lit(none_value)))
    return linked.select(*columns) if out in columns else linked
