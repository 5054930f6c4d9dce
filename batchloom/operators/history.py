"""Type-2 history of one tracked column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchloom.functions import day_before
from batchloom.operators.control import Batch

_NOW = "__now"


def changed(new: Column, old: Column, null_safe: bool = False) -> Column:
    """True where the value differs. By default NULL on either side is no change."""
    if null_safe:
        return ~new.eqNullSafe(old)
    return F.coalesce(new != old, F.lit(False))


def changed_keys(
    history: DataFrame, entity: DataFrame, key: str, tracked: str, null_safe: bool = False
) -> DataFrame:
    """Active history rows whose tracked value differs from the entity, with both values."""
    current = entity.select(key, F.col(tracked).alias("new_value"))
    active = history.where(F.col("dw_active_record_ind") == 1).select(key, F.col(tracked).alias("old_value"))
    return active.join(current, key).where(changed(F.col("new_value"), F.col("old_value"), null_safe))


def updated_in(batch: Batch) -> Column:
    """True on entity rows this batch touched that are updates, not first inserts, at the source."""
    touched = (F.col("etl_batch_no") == batch.no) & (F.col("src_create_timestamp") != F.col("src_update_timestamp"))
    return F.coalesce(touched, F.lit(False))


def really_updated(entity: DataFrame, batch: Batch) -> DataFrame:
    """Entity rows this batch really updated."""
    return entity.where(updated_in(batch))


def _closing(batch: Batch) -> dict[str, Column]:
    return {
        "dw_active_record_ind": F.lit(0),
        "effective_to_date": day_before(batch.date),
        "update_etl_batch_no": batch.no_col,
        "update_etl_batch_date": batch.date_col,
        "dw_update_timestamp": batch.run_col,
    }


def _opening(key: str, tracked: str, batch: Batch) -> dict[str, Column]:
    return {
        key: F.col(key),
        tracked: F.col(_NOW),
        "effective_from_date": batch.date_col,
        "dw_active_record_ind": F.lit(1),
        "create_etl_batch_no": batch.no_col,
        "create_etl_batch_date": batch.date_col,
        "dw_create_timestamp": batch.run_col,
    }


def _join_current(
    active: DataFrame, entity: DataFrame, key: str, tracked: str, how: str, reopen: Column | None = None
) -> DataFrame:
    marks = [F.lit(True).alias("__in_entity"), (F.lit(True) if reopen is None else reopen).alias("__reopen")]
    current = entity.select(key, F.col(tracked).alias(_NOW), *marks)
    return active.withColumn("__in_history", F.lit(True)).join(current, key, how)


def _closed_where(active: DataFrame, condition: Column, batch: Batch) -> list[Column]:
    closing = _closing(batch)
    return [
        F.when(condition, closing.get(f.name, F.col(f.name))).otherwise(F.col(f.name)).cast(f.dataType).alias(f.name)
        for f in active.schema.fields
    ]


def close_changed(
    active: DataFrame, entity: DataFrame, key: str, tracked: str, batch: Batch, null_safe: bool = False
) -> DataFrame:
    """Active rows, those whose tracked value changed being closed the day before the batch."""
    joined = _join_current(active, entity, key, tracked, "left")
    differs = F.col("__in_entity").isNotNull() & changed(F.col(_NOW), F.col(tracked), null_safe)
    return joined.select(*_closed_where(active, differs, batch))


def advance_active(
    active: DataFrame,
    entity: DataFrame,
    key: str,
    tracked: str,
    batch: Batch,
    null_safe: bool = False,
    reopen: Column | None = None,
) -> DataFrame:
    """Active rows after the batch plus the rows it closed.

    One full outer join on the key does everything: an unchanged row passes through, a changed
    row comes out closed together with its successor, an entity without an active row opens one.
    Where ``reopen``, a condition on the entity, does not hold, a changed row gets no successor yet;
    the next batch finds the entity without an active row and opens one.
    """
    joined = _join_current(active, entity, key, tracked, "full_outer", reopen)
    has_row, has_entity = F.col("__in_history").isNotNull(), F.col("__in_entity").isNotNull()
    differs = has_row & has_entity & changed(F.col(_NOW), F.col(tracked), null_safe)
    opening = _opening(key, tracked, batch)
    opened = [opening.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in active.schema.fields]
    versions = F.array(
        F.struct(has_row.alias("present"), *_closed_where(active, differs, batch)),
        F.struct(((has_entity & ~has_row) | (differs & F.col("__reopen"))).alias("present"), *opened),
    )
    return (
        joined.select(F.explode(versions).alias("v"))
        .where("v.present")
        .select(*[F.col("v")[c].alias(c) for c in active.columns])
    )


def scd2(
    history: DataFrame,
    entity: DataFrame,
    key: str,
    tracked: str,
    batch: Batch,
    null_safe: bool = False,
    reopen: Column | None = None,
) -> DataFrame:
    """Close changed rows and open one active row for every entity without one; closed rows pass through."""
    is_active = F.col("dw_active_record_ind").eqNullSafe(F.lit(1))
    advanced = advance_active(history.where(is_active), entity, key, tracked, batch, null_safe, reopen)
    return history.where(~is_active).unionByName(advanced)


def scd2_close(
    history: DataFrame, entity: DataFrame, key: str, tracked: str, batch: Batch, null_safe: bool = False
) -> DataFrame:
    """Only the closing half: changed active rows end the day before the batch."""
    is_active = F.col("dw_active_record_ind").eqNullSafe(F.lit(1))
    closed = close_changed(history.where(is_active), entity, key, tracked, batch, null_safe)
    return history.where(~is_active).unionByName(closed)
