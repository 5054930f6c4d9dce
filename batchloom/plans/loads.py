"""The eight entity loads and the two histories."""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection, Mapping
from dataclasses import dataclass
from types import MappingProxyType

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchloom.functions import first_of_month
from batchloom.operators.control import Batch
from batchloom.operators.history import scd2, updated_in
from batchloom.operators.keys import assign_keys_from, assign_keys_in_groups, max_id
from batchloom.operators.lookup import link_parent, lookup, lookup_bucketed, measured, of_few
from batchloom.operators.merge import matched_keys, merge_update, reject_null_keys, require_unique
from batchloom.schemas import EMPLOYEES, PAYMENTS, Entity
from batchloom.sources.files import COMPRESSION, write_bucketed, write_scratch


@dataclass(frozen=True)
class LoadOptions:
    """Where the two ways of loading an entity differ; the defaults update a listed column set.

    whole_row: update every source column, not only the listed ones.
    newer_only: update a row only if its source update time is later.
    insert_only: never touch known keys.
    keep_unmatched: an unmatched foreign key is NULL instead of leaving the row out.
    blank_extra: columns never extracted are '' instead of NULL.
    no_manager: manager id of employees without one.
    """

    whole_row: bool = False
    newer_only: bool = False
    insert_only: bool = False
    keep_unmatched: bool = False
    blank_extra: bool = False
    no_manager: int | None = None


SCRIPT = LoadOptions()
# The model way, per table.
MODEL: dict[str, LoadOptions] = {
    "offices": LoadOptions(whole_row=True),
    "employees": LoadOptions(whole_row=True, no_manager=0),
    "customers": LoadOptions(whole_row=True),
    "payments": LoadOptions(insert_only=True, keep_unmatched=True),
    "orders": LoadOptions(whole_row=True, newer_only=True, blank_extra=True),
    "productlines": LoadOptions(whole_row=True),
    "products": LoadOptions(whole_row=True, keep_unmatched=True, blank_extra=True),
    "orderdetails": LoadOptions(insert_only=True, keep_unmatched=True),
}


# Fixed value: the month facts without a date are stored under.
UNDATED = dt.date(1900, 1, 1)

_SOURCE_STAMPS = {"create_timestamp": "src_create_timestamp", "update_timestamp": "src_update_timestamp"}


def _batch_columns(batch: Batch) -> dict[str, Column]:
    return {"etl_batch_no": batch.no_col, "etl_batch_date": batch.date_col}


def stamp_rows(rows: DataFrame, batch: Batch) -> DataFrame:
    """Source stamps under their warehouse names, plus the batch columns."""
    return rows.withColumnsRenamed(_SOURCE_STAMPS).withColumns(_batch_columns(batch))


def resolve(
    entity: Entity,
    stage: DataFrame,
    dims: Mapping[str, DataFrame],
    options: LoadOptions = SCRIPT,
    bucketed: Collection[str] = (),
    along: Mapping[str, Collection[str]] = MappingProxyType({}),
) -> DataFrame:
    """Stage rows in warehouse column names with their foreign keys, NULL where unmatched.

    ``bucketed`` names the dimensions that are stored in buckets of the key they are looked up by, ``along`` further columns to take
    from a dimension, which are no columns of the table.
    """
    rows = reject_null_keys(stage, entity.key)
    for ref in entity.references:
        take = {ref.take: ref.alias, **{c: c for c in (*ref.carry, *along.get(ref.table, ()))}}
        find = lookup_bucketed if ref.table in bucketed else lookup
        rows = find(rows, dims[ref.table], ref.on, ref.key, take, "left")
    if entity.partition and entity.partition_from:
        # Never NULL: the month also takes part in joins.
        month = F.coalesce(first_of_month(entity.partition_from), F.lit(UNDATED))
        rows = rows.withColumn(entity.partition, month)
    rows = rows.withColumnsRenamed({**dict(entity.renames), **_SOURCE_STAMPS})
    blank = F.lit("") if options.blank_extra else F.lit(None)
    for field in entity.extra.fields:
        rows = rows.withColumn(field.name, (blank if field.dataType.typeName() == "string" else F.lit(None)).cast(field.dataType))
    return rows


def resolved(
    entity: Entity,
    stage: DataFrame,
    dims: Mapping[str, DataFrame],
    options: LoadOptions = SCRIPT,
    bucketed: Collection[str] = (),
    along: Mapping[str, Collection[str]] = MappingProxyType({}),
) -> DataFrame:
    """``resolve`` stored once for the key check, the insert and the update path.

    Rows with a key of several columns stay together by the first, for which they were looked up last: checking and numbering them
    moves none of them again.
    """
    rows, label = resolve(entity, stage, dims, options, bucketed, along), f"resolved-{entity.table}"
    stored = write_bucketed(rows, label, entity.dw_key[0]) if len(entity.dw_key) > 1 else write_scratch(rows, label, COMPRESSION)
    return require_unique(stored, entity.dw_key)


def matched(entity: Entity, rows: DataFrame, path: str, options: LoadOptions) -> DataFrame:
    """Leave out rows whose foreign key must match on this path but did not."""
    if options.keep_unmatched:
        return rows
    strict = [ref.alias for ref in entity.references if getattr(ref, path) == "inner"]
    return rows.dropna(subset=strict) if strict else rows


def insert_rows(
    entity: Entity,
    rows: DataFrame,
    known: DataFrame,
    batch: Batch,
    options: LoadOptions,
    last_id: int,
) -> tuple[DataFrame, int]:
    """Rows whose key is not among the ``known`` ones, keyed after ``last_id`` and stamped; and the last id given."""
    fresh = matched(entity, rows.join(measured(known.select(*entity.dw_key)), list(entity.dw_key), "left_anti"), "insert", options)
    assign = assign_keys_in_groups if len(entity.dw_key) > 1 else assign_keys_from
    keyed, last_id = assign(fresh, entity.dw_key, entity.id_col, last_id)
    stamped = keyed.withColumns(
        {"dw_create_timestamp": batch.run_col, "dw_update_timestamp": F.lit(None).cast("timestamp"), **_batch_columns(batch)}
    )
    return stamped.select(*entity.schema.names), last_id


def known_keys(entity: Entity, rows: DataFrame, target: DataFrame, look_up: bool = False) -> DataFrame:
    """The keys of these rows that the target holds, with their month where it has one: one scan of its keys, stored.

    With ``look_up`` keys of several columns are first looked up by the first one, if few: the target's other keys are not exchanged.
    """
    if look_up and len(entity.dw_key) > 1:
        target = of_few(target, entity.dw_key[0], rows, entity.dw_key[0])
    carry = [entity.partition] if entity.partition else []
    return write_scratch(matched_keys(measured(rows.select(*entity.dw_key)), target, entity.dw_key, carry), f"known-{entity.table}", COMPRESSION)


def update_rows(
    entity: Entity, rows: DataFrame, target: DataFrame, batch: Batch, options: LoadOptions = SCRIPT
) -> DataFrame:
    """The target with known keys overwritten from the resolved stage rows."""
    if options.whole_row:
        fixed = {entity.id_col, *entity.dw_key, "src_create_timestamp", entity.partition}
        cols = [c for c in rows.columns if c not in fixed and c != "dw_reporting_employee_id"]
    else:
        cols = [*entity.update_cols, "src_update_timestamp"]
    return merge_update(
        target,
        measured(matched(entity, rows, "update", options).select(*dict.fromkeys([*entity.dw_key, *cols, "src_update_timestamp"]))),
        entity.dw_key,
        cols,
        stamps={"dw_update_timestamp": batch.run_col, **_batch_columns(batch)},
        newer_by="src_update_timestamp" if options.newer_only else None,
        keep_old_if_null=("src_update_timestamp", "dw_product_line_id") if options.whole_row else (),
    )


def load_entity(
    entity: Entity,
    stage: DataFrame,
    target: DataFrame,
    dims: Mapping[str, DataFrame],
    batch: Batch,
    options: LoadOptions = SCRIPT,
) -> DataFrame:
    """The warehouse table after the batch: known keys updated, new keys inserted with dense ids."""
    rows = resolved(entity, stage, dims, options)
    known = known_keys(entity, rows, target)
    fresh, _ = insert_rows(entity, rows, known, batch, options, max_id(target, entity.id_col))
    if entity.append_only or options.insert_only:
        kept = target
    else:
        kept = update_rows(entity, rows, target, batch, options)
    merged = kept.unionByName(fresh)
    return link_managers(merged, options.no_manager) if entity is EMPLOYEES else merged


def link_managers(employees: DataFrame, none_value: int | None = None) -> DataFrame:
    """Set every employee's manager id from the manager's natural key."""
    return link_parent(
        employees, "reportsto", "employeenumber", "dw_employee_id", "dw_reporting_employee_id", none_value
    )


def append_payments(stage: DataFrame, customers: DataFrame, batch: Batch) -> DataFrame:
    """Payments of a batch without a look at earlier ones; loading a batch twice repeats its rows."""
    take = {"dw_customer_id": "dw_customer_id"}
    found = lookup(stage, customers, "customernumber", "src_customernumber", take, "inner")
    return stamp_rows(found.withColumnsRenamed(dict(PAYMENTS.renames)), batch)


def customer_history(history: DataFrame, customers: DataFrame, batch: Batch, null_safe: bool = False) -> DataFrame:
    """Type-2 history of the credit limit."""
    return scd2(history, customers, "dw_customer_id", "creditlimit", batch, null_safe)


def customer_history_model(history: DataFrame, customers: DataFrame, batch: Batch) -> DataFrame:
    """The model way: a successor is opened at once only for customers really updated by this batch."""
    return scd2(history, customers, "dw_customer_id", "creditlimit", batch, reopen=updated_in(batch))


def product_history_model(history: DataFrame, products: DataFrame, batch: Batch) -> DataFrame:
    """The model way: a changed price is closed now and its successor opened by the next batch."""
    return scd2(history, products, "dw_product_id", "msrp", batch, reopen=F.lit(False))


def product_history(history: DataFrame, products: DataFrame, batch: Batch, null_safe: bool = False) -> DataFrame:
    """Type-2 history of the list price."""
    return scd2(history, products, "dw_product_id", "msrp", batch, null_safe)
