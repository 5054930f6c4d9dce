"""Whole batches the model way, and what a reader sees of writes that did not finish."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from batchloom.operators.control import Batch
from batchloom.operators.merge import merge_upsert
from batchloom.plans import pipeline, summaries
from batchloom.plans.fixtures import BATCH_1, BATCH_2, staged
from batchloom.schemas import PRODUCTLINES, STAGE, WAREHOUSE
from batchloom.sources.files import UncommittedError, exists, scratch_path
from batchloom.sources.store import Store


@pytest.fixture(scope="module")
def store(spark, sf_dir):
    """Two batches; some customers and products come a batch after the rows that name them."""
    store = Store(spark, scratch_path(spark, "model"))
    for batch in (BATCH_1, BATCH_2):
        sources = {t: staged(spark, sf_dir, t, batch) for t in STAGE}
        if batch is BATCH_1:
            sources["products"] = sources["products"].where("productcode not like '%7'")
            sources["orders"] = sources["orders"].where("ordernumber % 61 != 5")
            sources["customers"] = sources["customers"].where("customernumber % 5 != 3")
        else:
            late = staged(spark, sf_dir, "products").where("productcode like '%7'")
            orders = staged(spark, sf_dir, "orders", BATCH_1).where("ordernumber % 61 = 5")
            sources["products"] = sources["products"].where("productcode not like '%7'").unionByName(late)
            sources["orders"] = sources["orders"].unionByName(orders).dropDuplicates(["ordernumber"])
            customers = staged(spark, sf_dir, "customers", BATCH_1).where("customernumber % 5 = 3")
            sources["customers"] = sources["customers"].unionByName(customers).dropDuplicates(["customernumber"])
            moved = F.lit(batch.run_at)
            sources = {t: df.withColumn("update_timestamp", moved) if t in ("products", "orders", "customers") else df for t, df in sources.items()}
        pipeline.run_batch(store, f"{store.root}/landing", sources, batch, batch.run_at, pipeline.MODEL_WAY)
    return store


def test_unmatched_rows_are_kept(store):
    payments, details = store.read("payments"), store.read("orderdetails")
    assert payments.where("dw_customer_id is null").count() > 0
    assert details.where("dw_product_id is null").count() > 0
    assert details.where("dw_order_id is null").count() > 0


def test_days_find_products_and_orders_by_natural_key(store):
    """Plain joins over the loaded tables, as of batch 2."""
    since = F.lit(BATCH_2.date)
    orders = store.read("orders").where(F.col("orderdate") >= since)
    details = store.read("orderdetails").select("src_ordernumber", "src_productcode", "dw_order_id", "quantityordered", "priceeach")
    products = store.read("products").select("src_productcode", "dw_product_id", "buyprice", "msrp")
    star = orders.drop("dw_order_id").join(details, "src_ordernumber").join(products, "src_productcode")
    assert star.where("dw_order_id is null").count() > 0 or orders.where("src_ordernumber % 61 = 5").count() == 0
    amount = F.sum(F.col("quantityordered") * F.col("priceeach")).cast("decimal(18,2)").alias("a")
    by_product = {tuple(r) for r in star.groupBy("orderdate", "dw_product_id").agg(amount).collect()}
    got = store.read("daily_product_summary").where(F.col("etl_batch_no") == 2).where("customer_apd = 1")
    assert {(r.summary_date, r.dw_product_id, r.product_amount) for r in got.collect()} == by_product
    known = star.where("dw_order_id is not null")
    by_customer = {tuple(r) for r in known.groupBy("orderdate", "dw_customer_id").agg(amount).collect()}
    got = store.read("daily_customer_summary").where(F.col("etl_batch_no") == 2).where("order_apd = 1")
    assert {(r.summary_date, r.dw_customer_id, r.order_amount) for r in got.collect()} == by_customer


def test_first_payments_of_unknown_customers(store):
    payments = store.read("payments")
    first = {(r[0], r[1]) for r in payments.groupBy("dw_customer_id").agg(F.min("paymentdate")).collect()}
    days = store.read("daily_customer_summary").where("new_customer_paid_apd = 1").collect()
    got = {(r.dw_customer_id, r.summary_date) for r in days}
    assert got <= first and (None in {c for c, _ in got})


def test_months_add_up_the_days(store):
    days = store.read("daily_product_summary").groupBy().agg(F.sum("product_mrp_amount")).first()[0]
    assert store.read("monthly_product_summary").groupBy().agg(F.sum("product_mrp_amount")).first()[0] == days


def test_one_active_version_per_entity(store):
    for table, key in (("customer_history", "dw_customer_id"), ("product_history", "dw_product_id")):
        active = store.read(table).where("dw_active_record_ind = 1")
        assert active.count() == active.select(key).distinct().count()


def test_repeating_a_batch_changes_nothing(spark, sf_dir, store):
    """Neither the last batch, although it adds to months, nor an earlier one is added twice."""
    audit = {"dw_create_timestamp", "dw_update_timestamp", "create_timestamp", "etl_batch_no", "etl_batch_date"}

    def contents():
        tables = [t for t in WAREHOUSE if t != "batch_control_log"]
        return {t: sorted(repr(tuple(r)) for r in store.read(t).drop(*audit).collect()) for t in tables}

    before = contents()
    sources = {t: store.read_stage(t) for t in STAGE}
    pipeline.run_batch(store, f"{store.root}/landing", sources, BATCH_2, BATCH_2.run_at, pipeline.MODEL_WAY)
    assert contents() == before
    months = {t: store.version(t).number for t in WAREHOUSE if t.startswith("monthly")}
    for table in ("customer", "product"):
        step = getattr(pipeline.MODEL_WAY, f"{table}_months")
        pipeline.load_monthly(store, f"monthly_{table}_summary", f"daily_{table}_summary", step, BATCH_1, adds=True)
    assert {t: store.version(t).number for t in months} == months


def test_history_without_active_rows(spark):
    """Every version closes and none is reopened: the old active rows must not stay."""
    store = Store(spark, scratch_path(spark, "closing"))
    entity = spark.createDataFrame([(1, 5), (2, 6)], "dw_product_id long, msrp int").withColumn("msrp", F.col("msrp").cast("decimal(10,2)"))
    first = Batch(1, dt.date(2001, 1, 1), dt.datetime(2001, 1, 1))
    second = Batch(2, dt.date(2001, 1, 2), dt.datetime(2001, 1, 2))
    pipeline.load_history(store, "product_history", entity, "dw_product_id", "msrp", first)
    pipeline.load_history(store, "product_history", entity.withColumn("msrp", F.col("msrp") + 1).withColumn("msrp", F.col("msrp").cast("decimal(10,2)")), "dw_product_id", "msrp", second, F.lit(False))
    rows = store.read("product_history").collect()
    assert len(rows) == 2 and {r.dw_active_record_ind for r in rows} == {0}


def _lines(spark, *names):
    df = spark.createDataFrame([(n,) for n in names], "productline string")
    return df.select(*[F.col("productline") if f.name == "productline" else F.lit(None).cast(f.dataType).alias(f.name) for f in PRODUCTLINES.schema.fields])


def test_publishing_does_not_need_sparks_marker(spark):
    store = Store(spark, scratch_path(spark, "markers"))
    conf = spark._jsc.hadoopConfiguration()
    conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        store.replace("productlines", _lines(spark, "a"))
        store.replace("productlines", _lines(spark, "a", "b"))
    finally:
        conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert store.read("productlines").count() == 2


def test_unfinished_versions_are_not_read(spark):
    store = Store(spark, scratch_path(spark, "unfinished"))
    folder = f"{store.root}/warehouse/productlines"
    _lines(spark, "x").write.parquet(f"{folder}/v=1/_temporary/0")
    assert store.read("productlines").count() == 0
    store.replace("productlines", _lines(spark, "a"))
    _lines(spark, "x", "y").write.parquet(f"{folder}/v=3/_temporary/0")
    assert [r.productline for r in store.read("productlines").collect()] == ["a"]


def test_data_without_any_record_is_an_error(spark):
    store = Store(spark, scratch_path(spark, "copied"))
    conf = spark._jsc.hadoopConfiguration()
    conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        _lines(spark, "x").write.parquet(f"{store.root}/warehouse/productlines/v=1")
    finally:
        conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert not exists(spark, f"{store.root}/warehouse/productlines/v=1/_SUCCESS")
    with pytest.raises(UncommittedError):
        store.read("productlines")


def test_upsert_rejects_rows_without_a_key(spark):
    target = spark.createDataFrame([(1, "a"), (None, "kept")], "k long, v string")
    source = spark.createDataFrame([(1, "b"), (2, "c"), (None, "d")], "k long, v string")
    assert sorted(map(tuple, merge_upsert(target, source, ["k"], ["v"]).collect()), key=repr) == [(1, "b"), (2, "c"), (None, "kept")]


def test_rules_of_the_ways():
    assert summaries.MODEL.natural_keys and not summaries.SCRIPT.natural_keys
