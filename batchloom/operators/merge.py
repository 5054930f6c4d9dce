"""Row-level writes as DataFrame transformations: insert, update, upsert, replace by key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchloom.operators.lookup import measured

_HIT, _NEW = "__hit", "__new_"


class DuplicateKeyError(ValueError):
    """The source of a keyed write holds a key more than once."""


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Raise if a non-NULL key repeats. Counts are combined before the shuffle, so a hot key is cheap."""
    repeated = df.dropna(subset=list(keys)).groupBy(*keys).count().where(F.col("count") > 1)
    worst = repeated.limit(1).collect()
    if worst:
        raise DuplicateKeyError(f"key {worst[0].asDict()} repeats in the source of a keyed write")
    return df


def reject_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Leave out rows without a natural key."""
    return df.dropna(subset=list(keys))


def matched_keys(source: DataFrame, target: DataFrame, keys: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """Source keys already in the target, with ``carry`` columns of the target row.

    The target is reduced first: with a small batch its keys stream past a broadcast of the
    batch keys and the target is never shuffled.
    """
    return target.select(*keys, *carry).join(source.select(*keys), list(keys), "left_semi")


def new_rows(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key the target lacks (NULL keys count as lacking)."""
    return source.join(matched_keys(source, target, keys), list(keys), "left_anti")


def merge_update(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str],
    stamps: Mapping[str, Column] | None = None,
    newer_by: str | None = None,
    keep_old_if_null: Sequence[str] = (),
) -> DataFrame:
    """Overwrite ``cols`` on target rows whose key is in the source; everything else is kept.

    ``stamps`` are set on updated rows only. With ``newer_by`` a row is updated only if that
    column is later in the source. ``keep_old_if_null`` columns ignore a NULL from the source.
    Source keys must be unique (see ``require_unique``).
    """
    stamps = dict(stamps or {})
    compared = [c for c in dict.fromkeys([*cols, *([newer_by] if newer_by else [])])]
    incoming = source.select(
        *keys, *[F.col(c).alias(_NEW + c) for c in compared], F.lit(True).alias(_HIT)
    )
    joined = target.join(incoming, list(keys), "left")
    hit = F.col(_HIT).isNotNull()
    if newer_by:
        hit = hit & F.coalesce(F.col(_NEW + newer_by) > F.col(newer_by), F.lit(False))
    out = []
    for c in target.columns:
        if c in stamps:
            out.append(F.when(hit, stamps[c]).otherwise(F.col(c)).cast(target.schema[c].dataType).alias(c))
        elif c in cols:
            new = F.coalesce(F.col(_NEW + c), F.col(c)) if c in keep_old_if_null else F.col(_NEW + c)
            out.append(F.when(hit, new).otherwise(F.col(c)).cast(target.schema[c].dataType).alias(c))
        else:
            out.append(F.col(c))
    return joined.select(*out)


def merge_insert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], stamps: Mapping[str, Column] | None = None
) -> DataFrame:
    """Add source rows with a new key; target columns the source lacks become NULL."""
    fresh = new_rows(source, target, keys).withColumns(dict(stamps or {}))
    return target.unionByName(fresh.select(*[c for c in target.columns if c in fresh.columns]), allowMissingColumns=True)


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str],
    update_stamps: Mapping[str, Column] | None = None,
    insert_stamps: Mapping[str, Column] | None = None,
    newer_by: str | None = None,
) -> DataFrame:
    """Update in one full outer join: known keys take ``cols``, unknown keys are inserted whole.

    Source rows without a key are rejected. Target rows without one pass by the join, where they would all meet in one
    task.
    """
    source = reject_null_keys(source, keys)
    keyless = target.where(~reduce(and_, [F.col(k).isNotNull() for k in keys]))
    target = reject_null_keys(target, keys)
    update_stamps, insert_stamps = dict(update_stamps or {}), dict(insert_stamps or {})
    old = target.select(*[F.col(c).alias("__old_" + c) if c not in keys else F.col(c) for c in target.columns], F.lit(True).alias("__in_target"))
    incoming = source.select(
        *keys, *[F.col(c).alias(_NEW + c) for c in source.columns if c not in keys], F.lit(True).alias(_HIT)
    )
    joined = old.join(incoming, list(keys), "full_outer")
    known, hit = F.col("__in_target").isNotNull(), F.col(_HIT).isNotNull()
    if newer_by:
        hit = hit & F.coalesce(F.col(_NEW + newer_by) > F.col("__old_" + newer_by), F.lit(False))
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.col(c))
            continue
        before = F.col("__old_" + c)
        incoming_value = F.col(_NEW + c) if c in source.columns else F.lit(None)
        inserted = insert_stamps.get(c, incoming_value)
        updated = update_stamps.get(c, incoming_value if c in cols else before)
        out.append(
            F.when(~known, inserted).when(hit, updated).otherwise(before).cast(target.schema[c].dataType).alias(c)
        )
    return joined.select(*out).unionByName(keyless)


def append(target: DataFrame, new: DataFrame) -> DataFrame:
    """Keyless incremental sink: a second run of the same rows duplicates them."""
    return target.unionByName(new.select(*target.columns))


def replace_by_key(target: DataFrame, new: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Keyed incremental sink: target rows whose key is among the new rows give way to them.

    Keys with a NULL match nothing unless ``null_safe`` is set.
    """
    given = new.select(*[F.col(k).alias(_NEW + k) for k in keys]).distinct()
    same = reduce(and_, [target[k].eqNullSafe(given[_NEW + k]) if null_safe else target[k] == given[_NEW + k] for k in keys])
    return target.join(measured(given, new), same, "left_anti").unionByName(new.select(*target.columns))
