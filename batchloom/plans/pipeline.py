"""One batch end to end: extract, land, stage, load, summarise, log."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchloom.functions import first_of_month
from batchloom.operators.control import Batch, close_batch, open_batch
from batchloom.operators.history import scd2, updated_in
from batchloom.operators.lookup import measured, of_few
from batchloom.operators.merge import replace_by_key
from batchloom.operators.ranking import first_day
from batchloom.operators.rollup import days_by_month, days_of
from batchloom.plans import summaries
from batchloom.plans.loads import (
    MODEL,
    SCRIPT,
    UNDATED,
    LoadOptions,
    insert_rows,
    known_keys,
    link_managers,
    matched,
    resolved,
    update_rows,
)
from batchloom.schemas import EMPLOYEES, ENTITIES, ORDERDETAILS, STAGE, WAREHOUSE, Entity
from batchloom.sources.files import COMPRESSION, scratch_scope, write_bucketed, write_scratch
from batchloom.sources.landing import read_landing, write_landing
from batchloom.sources.relational import extract_since
from batchloom.sources.store import Store


def _at_once(batch: Batch) -> Column | None:
    return None


def _next_batch(batch: Batch) -> Column | None:
    return F.lit(False)


@dataclass(frozen=True)
class Way:
    """One of the two ways of running a batch: options per entity, day rules, histories and months.

    ``reopen_*`` give the condition under which a closed version gets its successor at once. ``*_months`` take the
    daily rows and the month rows from the batch's month on; ``adds_months`` says that they add to the month rows.
    """

    loads: Mapping[str, LoadOptions]
    rules: summaries.DayRules
    reopen_customers: Callable[[Batch], Column | None]
    reopen_products: Callable[[Batch], Column | None]
    customer_months: Callable[[DataFrame, DataFrame, Batch], DataFrame]
    product_months: Callable[[DataFrame, DataFrame, Batch], DataFrame]
    adds_months: bool = False


def _added(step):
    """Months by adding the batch's days, with the arguments of the recomputing functions."""
    return lambda daily, target, batch: step(target, daily, batch)


SCRIPT_WAY = Way(
    {t: SCRIPT for t in ENTITIES},
    summaries.SCRIPT,
    _at_once,
    _at_once,
    summaries.recompute_customer_months,
    summaries.recompute_product_months,
)
MODEL_WAY = Way(
    MODEL,
    summaries.MODEL,
    updated_in,
    _next_batch,
    _added(summaries.accumulate_customer_months_model),
    _added(summaries.accumulate_product_months_model),
    adds_months=True,
)


def stage_load(store: Store, landing: str, table: str, batch: Batch, attempt: str = "newest") -> None:
    """Replace a stage table by the landed rows of the batch; a file that does not parse leaves the old one."""
    store.replace_stage(table, read_landing(store.spark, landing, table, batch.date, STAGE[table], attempt))


def extract_to_stage(store: Store, landing: str, table: str, source: DataFrame, batch: Batch) -> None:
    changed = extract_since(source, STAGE[table].names, "update_timestamp", batch.date)
    write_landing(changed, landing, table, batch.date, compression="gzip")
    stage_load(store, landing, table, batch)


def load_table(store: Store, entity: Entity, batch: Batch, options: LoadOptions = SCRIPT) -> DataFrame | None:
    """Apply a stage table to its warehouse table.

    The batch is classified once: its known keys are found in one scan of the target's keys, stored, and both the insert and the
    update read them. Of a table stored by month only the months that can hold one of the keys are scanned and only those that do
    are rewritten, while new rows of other months are added to what is there; which months these are (one value per month)
    is all the driver learns. The highest id comes from the table's record and goes back into it.

    Returned are the rows the table now consists of, as they were stored before they got their ids, if it is stored by month and had
    none before; details with the prices of their products.
    """
    stage = store.read_stage(entity.table)
    if stage.isEmpty():
        return None
    month = entity.partition
    first = month is not None and not store.version(entity.table).parts
    bucketed = [ref.table for ref in entity.references if (store.buckets(ref.table) or ("",))[0] == ref.key]
    # Lines of a first load are priced from what they are looked up in, so that no summary looks products up again.
    along = {"products": summaries.PRICES} if first and entity is ORDERDETAILS else {}
    dims = {}
    for ref in entity.references:
        dim = store.read(ref.table).select(ref.key, ref.take, *ref.carry, *along.get(ref.table, ()))
        if store.part_columns(ref.table) and not first:  # a first batch refers to most rows
            dims[ref.table] = of_few(dim, ref.key, stage, ref.on)
        else:
            dims[ref.table] = dim if ref.table in bucketed else measured(dim)
    rows = resolved(entity, stage, dims, options, bucketed, along)
    last_id = store.highest_id(entity.table, entity.id_col)
    if month is None:
        target = store.read(entity.table)
    else:
        target = store.read(entity.table, only=_months_to_scan(store, entity, rows, options))
    known = known_keys(entity, rows, target, look_up=not first)
    fresh, last_id = insert_rows(entity, rows, known, batch, options, last_id)
    facts = {"max_id": {entity.id_col: last_id}}
    if entity.append_only or (options.insert_only and month):
        store.append(entity.table, fresh, facts)
        return matched(entity, rows, "insert", options) if first else None
    if month is None:
        merged = update_rows(entity, rows, target, batch, options).unionByName(fresh)
        store.replace(entity.table, link_managers(merged, options.no_manager) if entity is EMPLOYEES else merged, facts)
        return None
    touched = [store.part_name(entity.table, r[0]) for r in known.select(month).distinct().collect()]
    if touched:
        updated = update_rows(entity, rows, store.read(entity.table, only=touched), batch, options)
        fresh = updated.unionByName(fresh)
    store.append(entity.table, fresh, facts, replacing=touched)
    return matched(entity, rows, "insert", options) if first else None


def _months_to_scan(store: Store, entity: Entity, rows: DataFrame, options: LoadOptions) -> list[str]:
    """The months of a table that can hold a known key of these rows."""
    names = store.holding(entity.table, rows)
    if entity.partition_from or options.keep_unmatched:
        return names
    # The month comes from the parent row, so a known key can only be in the months of the batch.
    months = {store.part_name(entity.table, r[0]) for r in rows.select(entity.partition).distinct().collect()}
    return [n for n in names if n in months]


def load_history(
    store: Store, table: str, entity: DataFrame, key: str, tracked: str, batch: Batch, reopen: Column | None = None
) -> None:
    """Bring a history up to date with the entities that changed, in the ranges of ids they fall into.

    Looked at are the entities stamped by this batch or by one since the history's last, and those that an earlier batch closed
    without a successor. Entities without batch stamps, and those of a history without a record, are all looked at. A batch that
    is repeated builds on the state before it.
    """
    base = store.base(table, batch.no) or store.version(table)
    looked_at, applied = entity, base.facts.get("applied")
    if applied and "etl_batch_no" in entity.columns:
        stamped = F.coalesce(F.col("etl_batch_no") >= min(applied[-1] + 1, batch.no), F.lit(False))
        looked_at = entity.where(stamped)
        # What a batch left without a successor is opened by the next one, so only the newest closed rows can be waiting.
        closed = max((n for n in map(_closed_by, base.parts) if n is not None and n < batch.no), default=None)
        if closed is not None:
            waiting = store.read(table, at=base, only=[n for n in base.parts if _closed_by(n) == closed]).select(key).distinct()
            looked_at = looked_at.unionByName(entity.where(~stamped).join(measured(waiting), key, "left_semi"))
    stamps = [c for c in ("etl_batch_no", "src_create_timestamp", "src_update_timestamp") if c in entity.columns]
    looked_at = write_scratch(looked_at.select(key, tracked, *stamps), f"changed-{table}", COMPRESSION)
    touched = [store.part_name(table, None, r[0]) for r in looked_at.select(store.id_range(key)).distinct().collect()]
    touched += [n for n in base.parts if "/" not in n and _closed_by(n) is None]  # active rows from before there were ranges
    active = store.read(table, at=base, only=touched)
    after = write_scratch(scd2(active, looked_at, key, tracked, batch, reopen=reopen), table, COMPRESSION)
    store.replace_partitions(table, after, also=touched, base=base, batch_no=batch.no)


def _closed_by(part: str) -> int | None:
    """The batch that closed the rows of a history's part; None for active rows."""
    value = part.split("/")[0].split("=")[1]
    return int(value) if value.isdigit() else None


def _first_days(store: Store, table: str, batch: Batch) -> bool:
    """True if the batch's days have none to meet: they are laid out for the write by the exchange that groups them."""
    return not store.parts_since(table, batch.date)


def load_daily(store: Store, table: str, daily: DataFrame, key: str, batch: Batch, laid_out: bool = False) -> None:
    """Put the batch's days into the months they fall in; equal (day, key) rows are replaced, those of unknown customers, too."""
    days = summaries.finish_daily(daily, batch)
    absent = [f for f in WAREHOUSE[table][0].fields if f.name not in days.columns]  # measures of the other way
    fresh = days.withColumns({f.name: F.lit(None).cast(f.dataType) for f in absent})
    if _first_days(store, table, batch):
        store.replace_partitions(table, fresh, laid_out=laid_out)  # nothing to give way: the days are read once
        return
    fresh = write_scratch(fresh, table, COMPRESSION)
    if fresh.isEmpty():
        return
    kept = store.read(table, since=batch.date)
    store.replace_partitions(table, replace_by_key(kept, fresh, ["summary_date", key], null_safe=True))


def load_monthly(
    store: Store, table: str, daily_table: str, step, batch: Batch, adds: bool = False, months_of_days: DataFrame | None = None
) -> None:
    """Bring the months from the batch's month on up to date; the script way recomputes them.

    With ``adds`` the step adds to the months, so it is applied to the state without this batch: the record of the table
    lists the batches that were added. A batch that other batches have followed is not added again. ``months_of_days`` are the
    batch's days, if they are stored together by month (``days_by_month``) and all days from the batch's month on.
    """
    base = store.base(table, batch.no) if adds else None
    if adds and base is None:
        return
    days = store.read(daily_table, since=batch.date)
    # Days that are stored together by month are rolled up where they are. Of others, without months to meet, one exchange both groups the days and lays the months out for the write. A month has at most 31 days of
    # a key, so there is no hot key to combine beforehand.
    alone = not store.parts_since(table, batch.date, at=base)
    if alone and months_of_days is not None:
        days = months_of_days
    elif alone:
        [key] = {"dw_customer_id", "dw_product_id"}.intersection(days.columns)
        days = days.repartitionByRange(first_of_month("summary_date"), key)
    months = step(days, store.read(table, since=batch.date, at=base), batch)
    store.replace_partitions(table, months, base=base, batch_no=batch.no if adds else None, laid_out=alone)


def load_first_payments(store: Store, batch: Batch) -> DataFrame:
    """Fold the batch's payments into the carried first payment day of each customer; the state after it.

    Read are the months of the payments staged by this batch and the ranges of their customers. A store without the state
    builds it once from all payments. Unknown customers are one customer without an id.
    """
    table = "first_payments"
    if store.version(table).parts:
        stage = store.read_stage("payments").select(F.coalesce(first_of_month("paymentdate"), F.lit(UNDATED)).alias("month"))
        months = [store.part_name("payments", r[0]) for r in stage.distinct().collect()]
        paid = store.read("payments", only=months).where(F.col("etl_batch_no") == batch.no)
    else:
        paid = store.read("payments")
    first = write_scratch(first_day(paid, "dw_customer_id", "paymentdate", "first_paid"), table, COMPRESSION)
    touched = [store.part_name(table, r[0]) for r in first.select(store.id_range("dw_customer_id")).distinct().collect()]
    if touched:
        folded = store.read(table, only=touched).unionByName(first)
        store.replace_partitions(table, first_day(folded, "dw_customer_id", "first_paid", "first_paid"))
    return store.read(table)


def load_customer_summaries(store: Store, lines: DataFrame, batch: Batch, way: Way = SCRIPT_WAY) -> None:
    first = load_first_payments(store, batch) if way.rules.first_payment else None
    payments = store.read("payments", since=batch.date)
    alone = _first_days(store, "daily_customer_summary", batch)
    days = summaries.daily_customer_summary(
        lines, store.read("products"), payments, store.read("customers"), batch, way.rules, first, unique=True, laid_out=alone
    )
    _load_days_and_months(store, "customer", days, way.customer_months, batch, way, alone)


def load_product_summaries(store: Store, lines: DataFrame, batch: Batch, way: Way = SCRIPT_WAY) -> None:
    alone = _first_days(store, "daily_product_summary", batch)
    days = summaries.daily_product_summary(lines, store.read("products"), batch, way.rules, alone, with_month=alone)
    _load_days_and_months(store, "product", days, way.product_months, batch, way, alone)


def _load_days_and_months(store: Store, kind: str, days: DataFrame, step, batch: Batch, way: Way, alone: bool) -> None:
    """Days that are ``alone``, with none to meet, are stored together by month, and both tables are written from there without an exchange."""
    daily, key, by_month = f"daily_{kind}_summary", f"dw_{kind}_id", None
    if alone:
        by_month = write_scratch(days_by_month(days, key), f"{daily}-by-month", COMPRESSION)
        days = days_of(by_month)
    load_daily(store, daily, days, key, batch, alone)
    load_monthly(store, f"monthly_{kind}_summary", daily, step, batch, way.adds_months, by_month)


def _side_by_side(chains: Sequence[Sequence[Callable[[], None]]]) -> None:
    """Run independent chains of steps as concurrent Spark jobs; the first error is raised."""

    def run(chain: Sequence[Callable[[], None]]) -> None:
        for step in chain:
            step()

    with ThreadPoolExecutor(max_workers=len(chains)) as pool:
        running = [pool.submit(copy_context().run, run, chain) for chain in chains]
        for done in running:
            done.result()


def run_batch(
    store: Store,
    landing: str,
    sources: Mapping[str, DataFrame],
    batch: Batch,
    ended_at: dt.datetime | None = None,
    way: Way = SCRIPT_WAY,
) -> None:
    """Run one batch, the script way or the model way. An error stops it after the steps already running and leaves the batch open in the log.

    Steps that do not read each other's tables run side by side; the others keep dependency order.
    """
    def load(*tables: str) -> list[Callable[[], None]]:
        return [partial(load_table, store, ENTITIES[t], batch, way.loads[t]) for t in tables]

    with scratch_scope(store.spark):
        store.replace("batch_control_log", open_batch(store.read("batch_control_log"), batch))
        _side_by_side([[partial(extract_to_stage, store, landing, t, sources[t], batch)] for t in STAGE])
        _side_by_side([load("offices", "employees", "customers", "orders"), load("productlines", "products")])
        added: list[DataFrame | None] = []
        details = lambda: added.append(load_table(store, ENTITIES["orderdetails"], batch, way.loads["orderdetails"]))
        _side_by_side([load("payments"), [details]])
        customers, products = store.read("customers"), store.read("products")
        natural = way.rules.natural_keys
        if added[0] is not None:
            lines = summaries.first_order_lines(store.read("orders"), added[0], batch, natural)
        else:
            lines = summaries.order_lines(store.read("orders"), store.read("orderdetails"), batch, natural)
            lines = write_bucketed(lines, "order-lines", *summaries.line_key(natural))
        _side_by_side(
            [
                [partial(load_history, store, "customer_history", customers, "dw_customer_id", "creditlimit", batch, way.reopen_customers(batch))],
                [partial(load_history, store, "product_history", products, "dw_product_id", "msrp", batch, way.reopen_products(batch))],
                [partial(load_customer_summaries, store, lines, batch, way)],
                [partial(load_product_summaries, store, lines, batch, way)],
            ]
        )
        log = close_batch(store.read("batch_control_log"), batch, ended_at or dt.datetime.now().replace(microsecond=0))
        store.replace("batch_control_log", log)
        store.prune()
