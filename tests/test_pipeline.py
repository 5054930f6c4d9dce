"""Two whole batches: invariants of the warehouse, and repeating a batch."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from batchloom.plans import summaries
from batchloom.plans.fixtures import BATCH_1, BATCH_2, staged
from batchloom.plans.pipeline import load_table, run_batch
from batchloom.plans.queries import warehouse_after_two_batches
from batchloom.schemas import ENTITIES, OFFICES, STAGE, WAREHOUSE
from batchloom.sources.files import list_names, scratch_path, scratch_root
from batchloom.sources.store import Store


@pytest.fixture(scope="module")
def store(spark, sf_dir):
    return warehouse_after_two_batches(spark, sf_dir, scratch_path(spark, "run"))


def _contents(store):
    audit = {"dw_create_timestamp", "dw_update_timestamp", "create_timestamp", "etl_batch_no", "etl_batch_date"}
    out = {}
    for table in WAREHOUSE:
        if table != "batch_control_log":
            df = store.read(table)
            out[table] = sorted(repr(tuple(r)) for r in df.drop(*audit).collect())
    return out


def test_keys_are_unique_and_dense(store):
    for entity in ENTITIES.values():
        table = store.read(entity.table)
        n, ids, low, high, keys = table.agg(
            F.count(F.lit(1)), F.count_distinct(entity.id_col), F.min(entity.id_col), F.max(entity.id_col),
            F.count_distinct(*entity.dw_key),
        ).first()
        assert (n, n, 1, n, n) == (n, ids, low, high, keys), entity.table


def test_foreign_keys_are_found(store):
    for entity in ENTITIES.values():
        for ref in entity.references:
            used = store.read(entity.table).select(F.col(ref.alias).alias(ref.take)).dropna()
            assert used.join(store.read(ref.table), ref.take, "left_anti").isEmpty(), (entity.table, ref.alias)


@pytest.mark.parametrize("table, key", [("customer_history", "dw_customer_id"), ("product_history", "dw_product_id")])
def test_one_active_version_and_no_overlap(store, table, key):
    history = store.read(table)
    active = history.where("dw_active_record_ind = 1").groupBy(key).count()
    assert active.where("count <> 1").isEmpty()
    assert active.count() == store.read("customers" if key == "dw_customer_id" else "products").count()
    a, b = history.alias("a"), history.alias("b")
    overlap = a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}")).where(
        "a.effective_from_date < b.effective_from_date and coalesce(a.effective_to_date, date '9999-01-01') >= b.effective_from_date"
    )
    assert overlap.isEmpty()
    assert not history.where("dw_active_record_ind = 0").isEmpty()


@pytest.mark.parametrize(
    "daily, monthly, months",
    [
        ("daily_customer_summary", "monthly_customer_summary", summaries.customer_months),
        ("daily_product_summary", "monthly_product_summary", summaries.product_months),
    ],
)
def test_months_are_the_sum_of_their_days(store, daily, monthly, months):
    expected, got = months(store.read(daily)), store.read(monthly)
    names = expected.columns
    assert sorted(map(repr, map(tuple, expected.select(*names).collect()))) == sorted(
        map(repr, map(tuple, got.select(*names).collect()))
    )


def test_batch_log(store):
    log = store.read("batch_control_log").orderBy("etl_batch_no").collect()
    assert [(r.etl_batch_no, r.etl_batch_status) for r in log] == [(1, "C"), (2, "C")]
    assert log[0].etl_batch_end_time - log[0].etl_batch_start_time == dt.timedelta(minutes=30)


def test_ids_are_stable_and_repeating_a_batch_changes_nothing(spark, sf_dir, store):
    before = _contents(store)
    scratch = f"{scratch_root(spark)}/batchloom"
    scratch_before = set(list_names(spark, scratch))
    sources = {t: staged(spark, sf_dir, t, BATCH_2) for t in STAGE}
    run_batch(store, f"{store.root}/landing", sources, BATCH_2)
    assert _contents(store) == before
    # The batch dropped its own scratch tables.
    assert set(list_names(spark, scratch)) == scratch_before


def test_error_leaves_batch_open(spark, sf_dir):
    root = scratch_path(spark, "run")
    store = Store(spark, root)
    sources = {t: staged(spark, sf_dir, t, BATCH_1) for t in STAGE}
    sources["offices"] = sources["offices"].union(sources["offices"])
    with pytest.raises(ValueError):
        run_batch(store, f"{root}/landing", sources, BATCH_1)
    assert [r.etl_batch_status for r in store.read("batch_control_log").collect()] == ["O"]
    assert store.read("offices").isEmpty()


def test_empty_stage_publishes_nothing(spark):
    store = Store(spark, scratch_path(spark, "store"))
    load_table(store, OFFICES, BATCH_1)
    assert list_names(spark, f"{store.root}/warehouse/offices") == []
