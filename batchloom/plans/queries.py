"""Registered queries: every operator and load, run over the whole given tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchloom.functions import any_flag, conform, day_before, empty_table, first_of_month, flag, from_cents, saturating_flag, to_cents
from batchloom.operators.branches import Measure, union_branches
from batchloom.operators.control import Batch, close_batch, open_batch, read_control, stamp_batch
from batchloom.operators.history import changed_keys, really_updated, scd2, scd2_close
from batchloom.operators.distinct import count_bitmaps, count_distinct_ids, distinct_bitmaps, merge_bitmaps
from batchloom.operators.keys import assign_keys, max_id
from batchloom.operators.lookup import lookup
from batchloom.operators.merge import (
    append,
    merge_insert,
    merge_update,
    merge_upsert,
    new_rows,
    reject_null_keys,
    replace_by_key,
)
from batchloom.operators.ranking import rank_by_day
from batchloom.operators.rollup import MONTH, accumulate, rollup_month
from batchloom.plans import loads, summaries
from batchloom.plans.fixtures import BATCH_1, BATCH_2, RAW, fixture, raw, staged
from batchloom.plans.pipeline import MODEL_WAY, SCRIPT_WAY, Way, load_table, run_batch
from batchloom.schemas import (
    BATCH_LOG,
    CUSTOMERS,
    EMPLOYEES,
    ENTITIES,
    MONTHLY_CUSTOMER,
    MONTHLY_PRODUCT,
    OFFICES,
    ORDERDETAILS,
    ORDERS,
    PAYMENTS,
    PRODUCTLINES,
    PRODUCTS,
    STAGE,
    WAREHOUSE,
    Entity,
    columns,
)
from batchloom.sources.files import scratch_path, size_of, write_scratch
from batchloom.sources.landing import read_landing, write_landing
from batchloom.sources.relational import extract_since
from batchloom.sources.store import Store

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def present(df: DataFrame) -> DataFrame:
    """Show dates and times as ISO text and exact decimals as doubles, so results compare across engines."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, T.TimestampType):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        out.append(c.alias(f.name))
    return df.select(*out)


def named(name: str) -> Callable[[Query], Query]:
    """Register a query under a name of its own."""

    def register(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: present(fn(spark, sf_dir))
        return fn

    return register


def query(fn: Query) -> Query:
    return named(fn.__name__)(fn)


def _empty_table(spark: SparkSession, entity: Entity) -> DataFrame:
    return empty_table(spark, entity.schema)


# --- sources and sinks -------------------------------------------------------------------------


@named("extract_since")
def extract_since_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = ["ordernumber", "orderdate", "status", "customernumber", "update_timestamp"]
    return extract_since(fixture(spark, sf_dir, "fx_orders"), wanted, "update_timestamp", dt.date(1998, 7, 16))


@query
def landing_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = raw(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    root = scratch_path(spark, "landing")
    write_landing(texts, root, "documents", BATCH_1.date)
    return read_landing(spark, root, "documents", BATCH_1.date, texts.schema)


@query
def landing_rerun_keeps_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "landing")
    for batch in (BATCH_1, BATCH_2):
        write_landing(staged(spark, sf_dir, "orders", batch), root, "orders", BATCH_1.date)
    first = read_landing(spark, root, "orders", BATCH_1.date, STAGE["orders"], attempt="first")
    return first.select("ordernumber", "orderdate", "shippeddate", "status", "customernumber", "update_timestamp")


@query
def stage_load_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "landing")
    write_landing(staged(spark, sf_dir, "products"), root, "products", BATCH_1.date)
    loaded = read_landing(spark, root, "products", BATCH_1.date, STAGE["products"])
    return loaded.select("productcode", "productname", "productscale", "quantityinstock", "buyprice", "msrp", "create_timestamp")


@query
def stage_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = Store(spark, scratch_path(spark, "store"))
    for batch in (BATCH_1, BATCH_2):
        store.replace_stage("payments", staged(spark, sf_dir, "payments", batch))
    return store.read_stage("payments").select("customernumber", "checknumber", "paymentdate", "amount")


@query
def failed_load_keeps_old(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = Store(spark, scratch_path(spark, "store"))
    customers = conform(
        staged(spark, sf_dir, "customers").withColumnRenamed("customernumber", "src_customernumber"), CUSTOMERS.schema
    )
    store.replace("customers", customers)
    try:
        broken = F.raise_error(F.lit("broken load")).cast("string")
        store.replace("customers", customers.withColumn("customername", broken))
    except Exception as error:  # the write must fail and must not replace the table
        if "broken load" not in str(error):
            raise
    else:
        raise AssertionError("the broken load did not fail")
    return store.read("customers").select("src_customernumber", "customername", "creditlimit")


@query
def incremental_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return append(fixture(spark, sf_dir, "fx_payments_b1"), fixture(spark, sf_dir, "fx_payments_b2")).select(
        "customernumber", "checknumber", "paymentdate", "amount"
    )


@query
def incremental_replace_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = fixture(spark, sf_dir, "fx_customers_b1"), fixture(spark, sf_dir, "fx_customers_b2")
    return replace_by_key(old, new, ["customernumber"])


# --- control row and batch log -----------------------------------------------------------------


def _daily_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log as if one batch had run for every order day: number, date, start at 23:00, 1 s per order."""
    days = fixture(spark, sf_dir, "fx_orders").groupBy("orderdate").agg(F.count(F.lit(1)).alias("n"))
    start = F.to_timestamp(F.col("orderdate")) + F.expr("INTERVAL '23' HOUR")
    return days.select(
        (F.datediff("orderdate", F.lit(BATCH_1.date)) + 1).cast("int").alias("etl_batch_no"),
        F.col("orderdate").alias("etl_batch_date"),
        F.lit("C").alias("etl_batch_status"),
        start.alias("etl_batch_start_time"),
        (start + F.make_dt_interval(secs=F.col("n"))).alias("etl_batch_end_time"),
    ).transform(lambda df: conform(df, BATCH_LOG))


def _next_control(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The control row of the batch after the last order day."""
    last = fixture(spark, sf_dir, "fx_orders").agg(F.max("orderdate").alias("d"))
    return last.select(
        (F.datediff("d", F.lit(BATCH_1.date)) + 2).cast("int").alias("etl_batch_no"),
        F.date_add("d", 1).alias("etl_batch_date"),
    )


def _next_batch(spark: SparkSession, sf_dir: str) -> Batch:
    batch = read_control(_next_control(spark, sf_dir), BATCH_2.run_at)
    return Batch(batch.no, batch.date, dt.datetime.combine(batch.date, dt.time(23)))


@query
def batch_control_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read the control row, then count what each order status has changed since it."""
    batch = read_control(_next_control(spark, sf_dir), BATCH_2.run_at)
    changed = F.col("update_timestamp") >= F.lit(batch.date).cast("timestamp")
    counts = fixture(spark, sf_dir, "fx_orders").groupBy("status").agg(
        F.count(F.lit(1)).alias("orders"), F.count_if(changed).alias("changed_orders")
    )
    return stamp_batch(counts, batch)


@query
def batch_log_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    return open_batch(_daily_log(spark, sf_dir), _next_batch(spark, sf_dir))


@query
def batch_log_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = _next_batch(spark, sf_dir)
    log = open_batch(_daily_log(spark, sf_dir), batch)
    return close_batch(log, batch, batch.run_at + dt.timedelta(minutes=30))


@query
def batch_stamp_crossjoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = _next_batch(spark, sf_dir)
    return stamp_batch(fixture(spark, sf_dir, "fx_orders").select("ordernumber", "status"), batch)


# --- predicates, lookups, joins ----------------------------------------------------------------


@named("reject_null_keys")
def reject_null_keys_sales_rep(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = fixture(spark, sf_dir, "fx_customers").select("customernumber", "salesrepemployeenumber", "creditlimit")
    return reject_null_keys(customers, ["salesrepemployeenumber"])


def _keyed_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixture(spark, sf_dir, "fx_customers")
    return assign_keys(rows, ["customernumber"], "dw_customer_id")


@query
def fk_lookup_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = fixture(spark, sf_dir, "fx_orders").select("ordernumber", "customernumber")
    dim = _keyed_customers(spark, sf_dir)
    return lookup(orders, dim, "customernumber", "customernumber", {"dw_customer_id": "dw_customer_id"}, "inner")


@query
def fk_lookup_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    employees = assign_keys(fixture(spark, sf_dir, "fx_employees"), ["employeenumber"], "dw_employee_id")
    customers = fixture(spark, sf_dir, "fx_customers").select("customernumber", "salesrepemployeenumber")
    return lookup(
        customers, employees, "salesrepemployeenumber", "employeenumber", {"dw_employee_id": "dw_sales_employee_id"}
    )


@query
def insert_new_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = fixture(spark, sf_dir, "fx_orders").select("ordernumber", "orderdate", "status")
    return new_rows(orders, fixture(spark, sf_dir, "fx_orders_b1"), ["ordernumber"])


@query
def employee_manager_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    employees = assign_keys(
        fixture(spark, sf_dir, "fx_employees").select("employeenumber", "lastname", "reportsto"),
        ["employeenumber"],
        "dw_employee_id",
    )
    return loads.link_managers(employees)


@query
def star_join_order_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = fixture(spark, sf_dir, "fx_orders").select("ordernumber", "orderdate", "customernumber")
    details = fixture(spark, sf_dir, "fx_orderdetails").select("ordernumber", "productcode", "quantityordered", "priceeach")
    products = fixture(spark, sf_dir, "fx_products").select("productcode", "buyprice", "msrp")
    qty = F.col("quantityordered")
    value = {"order_amount": "priceeach", "order_cost_amount": "buyprice", "order_mrp_amount": "msrp"}
    return (
        details.join(products, "productcode")
        .groupBy("ordernumber")
        .agg(*[from_cents(F.sum(to_cents(F.col(price)) * qty)).alias(name) for name, price in value.items()])
        .join(orders, "ordernumber")
    )


@query
def distinct_orders_products_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = fixture(spark, sf_dir, "fx_orders").select("ordernumber", "orderdate")
    details = fixture(spark, sf_dir, "fx_orderdetails").select("ordernumber", "productcode")
    products = assign_keys(fixture(spark, sf_dir, "fx_products").select("productcode"), ["productcode"], "dw_product_id")
    sold = lookup(orders.join(details, "ordernumber"), products, "productcode", "productcode", {"dw_product_id": "dw_product_id"})
    return count_distinct_ids(sold, ["orderdate"], {"ordernumber": "orders", "dw_product_id": "products"})


@query
def distinct_orders_products_per_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months from the bitmaps of their days: days of both batches are merged, whatever they share."""
    products = write_scratch(
        assign_keys(fixture(spark, sf_dir, "fx_products").select("productcode"), ["productcode"], "dw_product_id"), "products"
    )

    def days(batch: str) -> DataFrame:
        orders = fixture(spark, sf_dir, f"fx_orders_{batch}").select("ordernumber", "orderdate")
        details = fixture(spark, sf_dir, f"fx_orderdetails_{batch}").select("ordernumber", "productcode")
        sold = lookup(orders.join(details, "ordernumber"), products, "productcode", "productcode", {"dw_product_id": "dw_product_id"})
        return distinct_bitmaps(sold, ["orderdate"], ["ordernumber", "dw_product_id"])

    daily = days("b1").unionByName(days("b2")).withColumn("month", first_of_month("orderdate"))
    return count_bitmaps(merge_bitmaps(daily, ["month"]), ["month"], {"ordernumber": "orders", "dw_product_id": "products"})


@query
def first_payment_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    payments = fixture(spark, sf_dir, "fx_payments").select("customernumber", "checknumber", "paymentdate", "amount")
    return rank_by_day(payments, "customernumber", "paymentdate").withColumn("rank1", F.col("rank1").cast("bigint"))


@query
def scalar_functions_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = fixture(spark, sf_dir, "fx_orders")
    shipped, cancelled = flag(F.col("status") == "Shipped"), flag(F.col("status") == "Cancelled")
    weight = F.col("ordernumber").cast("decimal(12,2)")
    return o.select(
        "ordernumber",
        F.col("update_timestamp").cast("date").alias("update_day"),
        first_of_month("orderdate").alias("month_floor"),
        F.date_format("orderdate", "yyyy-MM-dd").alias("day_text"),
        F.to_date(F.date_format("orderdate", "yyyy-MM-dd"), "yyyy-MM-dd").alias("day_parsed"),
        F.date_sub("orderdate", 1).alias("day_before"),
        day_before(BATCH_2.date).alias("batch_day_before"),
        F.coalesce("shippeddate", "cancelleddate", "requireddate").alias("last_event"),
        F.when(F.col("shippeddate") > F.col("orderdate"), F.lit("late")).otherwise(F.lit("same day")).alias("delay"),
        F.greatest("shippeddate", "cancelleddate", "orderdate").alias("latest_day"),
        saturating_flag(shipped, cancelled).alias("done_flag"),
        any_flag(shipped, cancelled).alias("or_flag"),
        (weight * F.lit(3) + F.lit(1).cast("int")).cast("decimal(18,2)").alias("weight_amount"),
    )


@query
def surrogate_key_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = write_scratch(
        assign_keys(fixture(spark, sf_dir, "fx_products_s1"), ["productcode"], "dw_product_id"), "keyed"
    )
    rest = new_rows(fixture(spark, sf_dir, "fx_products_s2"), first, ["productcode"])
    second = assign_keys(rest, ["productcode"], "dw_product_id", max_id(first, "dw_product_id"))
    return first.unionByName(second).select("dw_product_id", "productcode", "productline")


# --- keyed writes ------------------------------------------------------------------------------

_CUSTOMER_UPDATES = ["salesrepemployeenumber", "creditlimit", "update_timestamp"]


def _customer_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return fixture(spark, sf_dir, "fx_customers_b1"), fixture(spark, sf_dir, "fx_customers_b2")


@named("merge_update")
def merge_update_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _customer_batches(spark, sf_dir)
    return merge_update(old, new, ["customernumber"], _CUSTOMER_UPDATES)


@named("merge_insert")
def merge_insert_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _customer_batches(spark, sf_dir)
    return merge_insert(old, new, ["customernumber"])


@named("merge_upsert")
def merge_upsert_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _customer_batches(spark, sf_dir)
    return merge_upsert(old, new, ["customernumber"], _CUSTOMER_UPDATES)


@query
def orders_upsert_if_newer(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = fixture(spark, sf_dir, "fx_orders_b1"), fixture(spark, sf_dir, "fx_orders")
    cols = ["requireddate", "shippeddate", "cancelleddate", "status", "update_timestamp"]
    return merge_upsert(old, new, ["ordernumber"], cols, newer_by="update_timestamp")


# --- entity loads, each over two batches -------------------------------------------------------


def _two_batches(
    spark: SparkSession,
    sf_dir: str,
    entity: Entity,
    dims: Callable[[Batch], dict[str, DataFrame]] = lambda batch: {},
    split: str = "b",
    options: loads.LoadOptions = loads.SCRIPT,
) -> DataFrame:
    """The published table after both batches, loaded the way ``run_batch`` loads it."""
    store = Store(spark, scratch_path(spark, f"load-{entity.table}"))
    published: dict[str, DataFrame] = {}
    for batch in (BATCH_1, BATCH_2):
        for table, dim in dims(batch).items():
            if published.get(table) is not dim:
                _publish(store, table, dim)
                published[table] = dim
        store.replace_stage(entity.table, staged(spark, sf_dir, entity.table, batch, split))
        load_table(store, entity, batch, options)
    return store.read(entity.table)


def _publish(store: Store, table: str, rows: DataFrame) -> None:
    schema, partition = WAREHOUSE[table]
    (store.replace if partition is None else store.replace_partitions)(table, conform(rows, schema))


def _once(spark: SparkSession, sf_dir: str, entity: Entity, dims: dict[str, DataFrame] | None = None) -> DataFrame:
    """The table after one batch that sees everything."""
    stage = staged(spark, sf_dir, entity.table)
    loaded = loads.load_entity(entity, stage, _empty_table(spark, entity), dims or {}, BATCH_1)
    return write_scratch(loaded, entity.table)


_AUDIT = ["src_create_timestamp", "src_update_timestamp", "dw_create_timestamp", "dw_update_timestamp", "etl_batch_no", "etl_batch_date"]


@query
def dw_offices(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _two_batches(spark, sf_dir, OFFICES, split="s")
    return table.select("dw_office_id", "officecode", *OFFICES.update_cols, *_AUDIT)


@query
def dw_offices_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _two_batches(spark, sf_dir, OFFICES, split="s", options=loads.MODEL["offices"])
    return table.select("dw_office_id", "officecode", "city", "country", "territory", *_AUDIT)


@query
def dw_employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    offices = _once(spark, sf_dir, OFFICES)
    table = _two_batches(spark, sf_dir, EMPLOYEES, lambda batch: {"offices": offices}, split="s")
    return table.select(
        "dw_employee_id", "employeenumber", *EMPLOYEES.update_cols, "dw_reporting_employee_id", *_AUDIT
    )


@query
def dw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    employees = _once(spark, sf_dir, EMPLOYEES, {"offices": _once(spark, sf_dir, OFFICES)})
    table = _two_batches(spark, sf_dir, CUSTOMERS, lambda batch: {"employees": employees}, split="w")
    return table.select("dw_customer_id", "src_customernumber", "customername", *CUSTOMERS.update_cols, *_AUDIT)


def _dim_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers keyed in one batch; their sales reps do not matter to facts."""
    return _once(spark, sf_dir, CUSTOMERS, {"employees": _empty_table(spark, EMPLOYEES)})


@query
def dw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = _dim_customers(spark, sf_dir)
    table = _two_batches(spark, sf_dir, ORDERS, lambda batch: {"customers": customers})
    return table.select(
        "dw_order_id", "src_ordernumber", "orderdate", "shippeddate", "cancelleddate", "status", "comments",
        "dw_customer_id", *_AUDIT,
    )


@query
def dw_orders_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = _dim_customers(spark, sf_dir)
    table = _two_batches(
        spark, sf_dir, ORDERS, lambda batch: {"customers": customers}, options=loads.MODEL["orders"]
    )
    return table.select(
        "dw_order_id", "src_ordernumber", "orderdate", "shippeddate", "status", "comments", "dw_customer_id", "etl_batch_no"
    )


@query
def payments_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = _dim_customers(spark, sf_dir)
    table = _two_batches(spark, sf_dir, PAYMENTS, lambda batch: {"customers": customers})
    return table.select("dw_payment_id", "checknumber", "paymentdate", "amount", "dw_customer_id", *_AUDIT)


@query
def payments_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch 2 is loaded twice, so its payments appear twice."""
    customers = _dim_customers(spark, sf_dir)
    first, second = [
        loads.append_payments(staged(spark, sf_dir, "payments", b), customers, b) for b in (BATCH_1, BATCH_2)
    ]
    return append(append(first, second), second).select(
        "dw_customer_id", "src_customernumber", "checknumber", "paymentdate", "amount", "etl_batch_no"
    )


@query
def payments_load_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of batch 1 only, so payments of later customers are kept without a customer id."""
    customers = write_scratch(
        loads.load_entity(
            CUSTOMERS, staged(spark, sf_dir, "customers", BATCH_1), _empty_table(spark, CUSTOMERS),
            {"employees": _empty_table(spark, EMPLOYEES)}, BATCH_1,
        ),
        "customers",
    )
    table = _two_batches(spark, sf_dir, PAYMENTS, lambda batch: {"customers": customers}, options=loads.MODEL["payments"])
    return table.select("dw_payment_id", "checknumber", "paymentdate", "amount", "dw_customer_id", "etl_batch_no")


@query
def dw_productlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_batches(spark, sf_dir, PRODUCTLINES, split="s").select("dw_product_line_id", "productline", *_AUDIT)


@query
def dw_productlines_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _two_batches(spark, sf_dir, PRODUCTLINES, split="s", options=loads.MODEL["productlines"])
    return table.select("dw_product_line_id", "productline", *_AUDIT)


@query
def dw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _once(spark, sf_dir, PRODUCTLINES)
    table = _two_batches(spark, sf_dir, PRODUCTS, lambda batch: {"productlines": lines}, split="s")
    return table.select(
        "dw_product_id", "src_productcode", *PRODUCTS.update_cols, *_AUDIT
    )


@query
def orderdetails_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims = {
        "products": _once(spark, sf_dir, PRODUCTS, {"productlines": _once(spark, sf_dir, PRODUCTLINES)}),
        "orders": _once(spark, sf_dir, ORDERS, {"customers": _dim_customers(spark, sf_dir)}),
    }
    table = _two_batches(spark, sf_dir, ORDERDETAILS, lambda batch: dims)
    return table.select(
        "dw_orderdetail_id", "src_ordernumber", "src_productcode", "quantityordered", "priceeach", "dw_order_id",
        "dw_product_id", "src_update_timestamp", "etl_batch_no",
    )


@query
def dw_employees_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    offices = _once(spark, sf_dir, OFFICES)
    table = _two_batches(
        spark, sf_dir, EMPLOYEES, lambda batch: {"offices": offices}, split="s", options=loads.MODEL["employees"]
    )
    return table.select("dw_employee_id", "employeenumber", "jobtitle", "dw_office_id", "dw_reporting_employee_id")


@query
def dw_customers_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    employees = _once(spark, sf_dir, EMPLOYEES, {"offices": _once(spark, sf_dir, OFFICES)})
    table = _two_batches(
        spark, sf_dir, CUSTOMERS, lambda batch: {"employees": employees}, options=loads.MODEL["customers"]
    )
    return table.select("dw_customer_id", "src_customernumber", "customername", "creditlimit", "dw_sales_employee_id", "etl_batch_no")


@query
def dw_products_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product lines of the first split only: later lines give products without a line id."""
    lines = write_scratch(
        loads.load_entity(
            PRODUCTLINES, staged(spark, sf_dir, "productlines", BATCH_1, "s"), _empty_table(spark, PRODUCTLINES), {}, BATCH_1
        ),
        "productlines",
    )
    table = _two_batches(
        spark, sf_dir, PRODUCTS, lambda batch: {"productlines": lines}, split="s", options=loads.MODEL["products"]
    )
    return table.select("dw_product_id", "src_productcode", "productdescription", "msrp", "dw_product_line_id", "etl_batch_no")


@query
def orderdetails_load_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known lines are left alone; lines of products not loaded yet are kept without a product id."""
    lines = _once(spark, sf_dir, PRODUCTLINES)
    products = write_scratch(
        loads.load_entity(
            PRODUCTS, staged(spark, sf_dir, "products", BATCH_1, "s"), _empty_table(spark, PRODUCTS), {"productlines": lines}, BATCH_1
        ),
        "products",
    )
    dims = {"products": products, "orders": _once(spark, sf_dir, ORDERS, {"customers": _dim_customers(spark, sf_dir)})}
    table = _two_batches(spark, sf_dir, ORDERDETAILS, lambda batch: dims, options=loads.MODEL["orderdetails"])
    return table.select(
        "dw_orderdetail_id", "src_ordernumber", "src_productcode", "quantityordered", "dw_order_id", "dw_product_id",
        "etl_batch_no",
    )


# --- type-2 history ----------------------------------------------------------------------------


def _limits(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Customers with their natural key as id, after batch 1 and after batch 2."""
    old, new = _customer_batches(spark, sf_dir)
    first = loads.stamp_rows(old.withColumnRenamed("customernumber", "dw_customer_id"), BATCH_1)
    second = loads.stamp_rows(new.withColumnRenamed("customernumber", "dw_customer_id"), BATCH_2)
    return first, replace_by_key(first, second, ["dw_customer_id"])


def _prices(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Products after batch 1 and after batch 2, with numeric ids in product-code order."""
    keyed = assign_keys(fixture(spark, sf_dir, "fx_products"), ["productcode"], "dw_product_id")
    raised = fixture(spark, sf_dir, "fx_products_b2")
    return keyed, merge_update(keyed, raised, ["productcode"], ["msrp", "update_timestamp"])


_HISTORY = [
    "effective_from_date", "effective_to_date", "dw_active_record_ind", "create_etl_batch_no",
    "update_etl_batch_no", "update_etl_batch_date", "dw_create_timestamp", "dw_update_timestamp",
]


def _history_of(table: str, first: DataFrame, key: str, tracked: str) -> DataFrame:
    return scd2(empty_table(first.sparkSession, WAREHOUSE[table][0]), first, key, tracked, BATCH_1)


@query
def scd2_change_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changed credit limits, once ignoring NULLs and once comparing them."""
    first, second = _limits(spark, sf_dir)
    history = _history_of("customer_history", first, "dw_customer_id", "creditlimit")
    found = [
        changed_keys(history, second, "dw_customer_id", "creditlimit", null_safe).withColumn(
            "null_safe", F.lit(int(null_safe))
        )
        for null_safe in (False, True)
    ]
    return found[0].unionByName(found[1])


@query
def changed_in_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, second = _limits(spark, sf_dir)
    return really_updated(second, BATCH_2).select("dw_customer_id", "creditlimit", "src_update_timestamp")


@named("scd2_close")
def scd2_close_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = _limits(spark, sf_dir)
    history = _history_of("customer_history", first, "dw_customer_id", "creditlimit")
    closed = scd2_close(history, second, "dw_customer_id", "creditlimit", BATCH_2)
    return closed.select("dw_customer_id", "creditlimit", *_HISTORY)


@query
def customer_history_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = _limits(spark, sf_dir)
    history = _history_of("customer_history", first, "dw_customer_id", "creditlimit")
    return loads.customer_history(history, second, BATCH_2).select("dw_customer_id", "creditlimit", *_HISTORY)


@query
def customer_history_null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = _limits(spark, sf_dir)
    history = _history_of("customer_history", first, "dw_customer_id", "creditlimit")
    after = loads.customer_history(history, second, BATCH_2, null_safe=True)
    return after.select("dw_customer_id", "creditlimit", *_HISTORY)


@query
def product_history_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = _prices(spark, sf_dir)
    history = _history_of("product_history", first, "dw_product_id", "msrp")
    return loads.product_history(history, second, BATCH_2).select("dw_product_id", "msrp", *_HISTORY)


@query
def customer_history_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = _limits(spark, sf_dir)
    history = _history_of("customer_history", first, "dw_customer_id", "creditlimit")
    return loads.customer_history_model(history, second, BATCH_2).select("dw_customer_id", "creditlimit", *_HISTORY)


@query
def product_history_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch 2 closes the changed prices; a third batch without changes opens their successors."""
    first, second = _prices(spark, sf_dir)
    history = _history_of("product_history", first, "dw_product_id", "msrp")
    closed = loads.product_history_model(history, second, BATCH_2)
    third = Batch(3, BATCH_2.date + dt.timedelta(days=1), BATCH_2.run_at + dt.timedelta(days=1))
    return loads.product_history_model(closed, second, third).select("dw_product_id", "msrp", *_HISTORY)


# --- summaries ---------------------------------------------------------------------------------


def _facts(spark: SparkSession, sf_dir: str, batch: Batch | None = None, loose: bool = False) -> dict[str, DataFrame]:
    """Fact and entity tables with natural keys as ids: everything, or the state after a batch.

    ``loose``: some payments have no customer id, and some lines were loaded before their order or their product, as
    the model way keeps them.
    """
    b1 = "_b1" if batch is BATCH_1 else ""
    products = fixture(spark, sf_dir, "fx_products")
    if batch is BATCH_2:
        products = merge_update(products, fixture(spark, sf_dir, "fx_products_b2"), ["productcode"], ["msrp"])
    details = fixture(spark, sf_dir, f"fx_orderdetails{b1}").withColumnsRenamed(
        {"ordernumber": "src_ordernumber", "productcode": "src_productcode"}
    )

    def known(column: str, unless: Column) -> Column:
        return F.when(~unless, F.col(column)) if loose else F.col(column)

    return {
        "orders": fixture(spark, sf_dir, f"fx_orders{b1}")
        .withColumnsRenamed({"ordernumber": "dw_order_id", "customernumber": "dw_customer_id"})
        .withColumn("src_ordernumber", F.col("dw_order_id")),
        "orderdetails": details.withColumns(
            {
                "dw_order_id": known("src_ordernumber", F.col("quantityordered") == 13),
                "dw_product_id": known("src_productcode", F.col("orderlinenumber") == 6),
            }
        ),
        "products": products.withColumns({"dw_product_id": F.col("productcode")}).withColumnRenamed(
            "productcode", "src_productcode"
        ),
        "payments": fixture(spark, sf_dir, f"fx_payments{b1}").withColumn(
            "dw_customer_id", known("customernumber", F.col("amount") > 300_000)
        ),
        "customers": fixture(spark, sf_dir, f"fx_customers{b1}").withColumnsRenamed(
            {"customernumber": "dw_customer_id", "create_timestamp": "src_create_timestamp"}
        ),
    }


def _lines(facts: dict[str, DataFrame], batch: Batch, rules: summaries.DayRules) -> DataFrame:
    lines = summaries.order_lines(facts["orders"], facts["orderdetails"], batch, rules.natural_keys)
    return write_scratch(lines, "order-lines")


def _by_customer(facts: dict[str, DataFrame], batch: Batch, rules: summaries.DayRules) -> DataFrame:
    others = [facts[t] for t in ("products", "payments", "customers")]
    return summaries.daily_customer_summary(_lines(facts, batch, rules), *others, batch, rules)


def _by_product(facts: dict[str, DataFrame], batch: Batch, rules: summaries.DayRules) -> DataFrame:
    return summaries.daily_product_summary(_lines(facts, batch, rules), facts["products"], batch, rules)


@query
def daily_customer_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_customer(_facts(spark, sf_dir), BATCH_1, summaries.SCRIPT)


@query
def daily_customer_summary_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_customer(_facts(spark, sf_dir, loose=True), BATCH_1, summaries.MODEL)


@query
def daily_product_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_product(_facts(spark, sf_dir), BATCH_1, summaries.SCRIPT)


@query
def daily_product_summary_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_product(_facts(spark, sf_dir, loose=True), BATCH_1, summaries.MODEL)


@query
def branch_union_customer_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two kinds of facts folded by the generic operator: orders placed and payments made per day."""
    orders = fixture(spark, sf_dir, "fx_orders").select(
        F.col("orderdate").alias("summary_date"), "customernumber", F.lit(1).alias("orders")
    )
    payments = fixture(spark, sf_dir, "fx_payments").select(
        F.col("paymentdate").alias("summary_date"), "customernumber", to_cents(F.col("amount")).alias("cents")
    )
    measures = [
        Measure("order_count", "ordered", T.LongType(), source="orders"),
        Measure("order_apd", "ordered", T.IntegerType(), "present"),
        Measure("payment_amount", "paid", T.DecimalType(18, 2), source="cents", cents=True),
        Measure("payment_apd", "paid", T.IntegerType(), "present"),
    ]
    return union_branches({"ordered": orders, "paid": payments}, ["summary_date", "customernumber"], measures)


def _two_days(spark: SparkSession, sf_dir: str, daily, rules: summaries.DayRules) -> tuple[DataFrame, DataFrame]:
    """Daily rows of batch 1, and daily rows of both batches, stored as published tables would be."""
    first, second = [
        write_scratch(daily(_facts(spark, sf_dir, b), b, rules), "daily") for b in (BATCH_1, BATCH_2)
    ]
    return first, first.unionByName(second)


_MONTH_AUDIT = {"dw_create_timestamp", "dw_update_timestamp", "etl_batch_date"}


def _two_month_batches(spark: SparkSession, sf_dir: str, daily, rules, step, schema: T.StructType) -> DataFrame:
    first, both = _two_days(spark, sf_dir, daily, rules)
    key = schema.names[0]
    id_type = first.schema[key].dataType
    target = empty_table(spark, T.StructType([T.StructField(f.name, id_type if f.name == key else f.dataType) for f in schema]))
    after_first = write_scratch(step(target, first, BATCH_1), "monthly")
    after = step(after_first, both, BATCH_2)
    return after.select(*[c for c in after.columns if c not in _MONTH_AUDIT])


@query
def monthly_customer_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_month_batches(
        spark, sf_dir, _by_customer, summaries.SCRIPT, summaries.accumulate_customer_months, MONTHLY_CUSTOMER
    )


@query
def monthly_customer_summary_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_month_batches(
        spark, sf_dir, _by_customer, summaries.MODEL, summaries.accumulate_customer_months_model, MONTHLY_CUSTOMER
    )


@query
def monthly_product_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_month_batches(
        spark, sf_dir, _by_product, summaries.SCRIPT, summaries.accumulate_product_months, MONTHLY_PRODUCT
    )


@query
def monthly_product_summary_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_month_batches(
        spark, sf_dir, _by_product, summaries.MODEL, summaries.accumulate_product_months_model, MONTHLY_PRODUCT
    )


@query
def accumulate_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payment months of batch 1, with those of batch 2 added."""
    def months(name: str) -> DataFrame:
        paid = fixture(spark, sf_dir, name).withColumn("payments", F.lit(1))
        rolled = rollup_month(
            paid, "customernumber", ["payments", "amount"], flags={"payment_apm": "payments"}, day="paymentdate"
        )
        schema = columns("start_of_the_month_date date, customernumber bigint, payments bigint, amount money_sum, payment_apm int")
        return conform(rolled, schema)

    return accumulate(
        months("fx_payments_b1"), months("fx_payments_b2"), [MONTH, "customernumber"],
        adds=["payments", "amount"], ors=["payment_apm"],
    )


# --- whole batches -----------------------------------------------------------------------------


def warehouse_after_two_batches(spark: SparkSession, sf_dir: str, root: str, way: Way = SCRIPT_WAY) -> Store:
    """Run both batches against a new warehouse under ``root``."""
    store = Store(spark, root)
    for batch in (BATCH_1, BATCH_2):
        sources = {t: staged(spark, sf_dir, t, batch) for t in STAGE}
        run_batch(store, f"{root}/landing", sources, batch, batch.run_at + dt.timedelta(minutes=30), way)
    return store


#: Warehouses that the queries below share, by application, input and way: each shows one table of a run of both batches.
_RUNS: dict[tuple[str, str, str], Store] = {}
#: Bytes of the given tables up to which a run is shared. Over larger ones every query runs both batches itself, so that what it costs
#: does not depend on the queries before it.
_SHARED_BYTES = 8 << 20


def _after_both(spark: SparkSession, sf_dir: str, name: str, way: Way) -> Store:
    if sum(size_of(spark, f"{sf_dir}/{t}.parquet") for t in RAW) > _SHARED_BYTES:
        return warehouse_after_two_batches(spark, sf_dir, scratch_path(spark, f"run-{name}"), way)
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _RUNS or not _RUNS[key].version("orders").parts:
        _RUNS[key] = warehouse_after_two_batches(spark, sf_dir, scratch_path(spark, f"run-{name}"), way)
    return _RUNS[key]


# Columns that the inputs leave NULL in every row are left out; those that only one way fills are named apart.
_UNFILLED = {
    "customers": ["contactlastname", "contactfirstname", "phone", "addressline1", "addressline2", "city", "state", "postalcode"],
    "products": ["productscale", "productvendor"],
    "daily_customer_summary": ["create_timestamp", "summary_month"],
    "daily_product_summary": ["create_timestamp", "summary_month"],
}
_ONLY_MODEL = {"daily_product_summary": ["product_amount", "cancelled_amount"]}


def shown_columns(table: str, name: str) -> list[str]:
    """The columns that a table's query shows."""
    left_out = {*_UNFILLED.get(table, ()), *(_ONLY_MODEL.get(table, ()) if name == "script" else ())}
    partition = ENTITIES[table].partition if table in ENTITIES else None
    return [c for c in WAREHOUSE[table][0].names if c not in left_out and c != partition]


def _batch_query(table: str, name: str, way: Way) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _after_both(spark, sf_dir, name, way).read(table).select(*shown_columns(table, name))

    return run


for _table in WAREHOUSE:
    if _table != "batch_control_log":
        named(f"batch_{_table}")(_batch_query(_table, "script", SCRIPT_WAY))
        named(f"batch_{_table}_model")(_batch_query(_table, "model", MODEL_WAY))


# A money or count column per warehouse table whose sum stands for its contents.
_CHECKED = {
    "offices": "dw_office_id",
    "employees": "dw_reporting_employee_id",
    "customers": "creditlimit",
    "payments": "amount",
    "orders": "dw_customer_id",
    "productlines": "dw_product_line_id",
    "products": "msrp",
    "orderdetails": "dw_product_id",
    "customer_history": "creditlimit",
    "product_history": "msrp",
    "daily_customer_summary": "order_amount",
    "daily_product_summary": "product_mrp_amount",
    "monthly_customer_summary": "order_amount",
    "monthly_product_summary": "product_mrp_amount",
}


@query
def run_two_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row count and one column sum of every warehouse table after both batches."""
    store = warehouse_after_two_batches(spark, sf_dir, scratch_path(spark, "run"))
    parts = [
        store.read(table).agg(
            F.lit(table).alias("table_name"),
            F.count(F.lit(1)).alias("row_count"),
            F.sum(column).cast("decimal(18,2)").alias("column_sum"),
        )
        for table, column in _CHECKED.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
