"""The shape of the plans: what is pushed down, pruned, joined and never done in one task."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from batchloom.functions import first_of_month
from batchloom.operators.history import scd2
from batchloom.operators.keys import assign_keys_in_groups
from batchloom.operators.lookup import of_few
from batchloom.operators.merge import new_rows
from batchloom.operators.ranking import rank_by_day
from batchloom.operators.rollup import days_by_month, days_of, rollup_month
from batchloom.plans import loads, queries, summaries
from batchloom.plans.fixtures import BATCH_2, fixture, staged
from batchloom.plans.queries import QUERIES, _facts, warehouse_after_two_batches
from batchloom.schemas import CUSTOMER_HISTORY, ORDERDETAILS
from batchloom.sources.files import scratch_path, write_bucketed, write_scratch
from batchloom.sources.relational import extract_since
from batchloom.sources.versions import Version


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """Joins as they are planned when no side is small."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_extract_filter_and_columns_reach_the_scan(spark, sf_dir):
    path = scratch_path(spark, "orders")
    fixture(spark, sf_dir, "fx_orders").write.parquet(path)
    text = plan(extract_since(spark.read.parquet(path), ["ordernumber"], "update_timestamp", dt.date(2000, 1, 1)))
    assert "GreaterThanOrEqual(update_timestamp,2000-01-01 00:00:00.0)" in text
    assert "ReadSchema: struct<ordernumber:bigint,update_timestamp:timestamp>" in text


def test_new_rows_is_an_anti_join(spark, sf_dir):
    text = plan(new_rows(fixture(spark, sf_dir, "fx_orders"), fixture(spark, sf_dir, "fx_orders_b1"), ["ordernumber"]))
    assert "LeftAnti" in text and "LeftSemi" in text


@pytest.mark.parametrize(
    "name",
    ["daily_customer_summary", "daily_product_summary", "first_payment_rank", "surrogate_key_assign", "dw_products",
     "customer_history_scd2", "monthly_product_summary", "orderdetails_load"],
)
def test_no_query_gathers_rows_in_one_task_or_crosses(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "SinglePartition" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "PythonUDF" not in text and "BatchEvalPython" not in text


def test_history_is_one_full_outer_join(no_broadcast, sf_dir):
    spark = no_broadcast
    customers = fixture(spark, sf_dir, "fx_customers").withColumnRenamed("customernumber", "dw_customer_id")
    text = plan(scd2(spark.createDataFrame([], CUSTOMER_HISTORY), customers, "dw_customer_id", "creditlimit", BATCH_2))
    assert text.count("FullOuter") <= 1


def test_daily_facts_are_combined_before_one_final_shuffle(no_broadcast, sf_dir):
    facts = _facts(no_broadcast, sf_dir)
    lines = summaries.order_lines(facts["orders"], facts["orderdetails"], BATCH_2)
    days = summaries.daily_customer_summary(lines, facts["products"], facts["payments"], facts["customers"], BATCH_2)
    top = plan(days).split("Union")[0]
    assert top.count("Exchange") == 1 and "partial_sum" in top


def test_rank_window_sees_days_not_facts(no_broadcast, sf_dir):
    text = plan(rank_by_day(fixture(no_broadcast, sf_dir, "fx_payments"), "customernumber", "paymentdate"))
    below_window = text.split("Window")[-1]
    assert "HashAggregate" in below_window and "partial_count" in below_window


def _scans(node) -> list:
    """File scans of a plan that has run, through the stages of adaptive execution."""
    kind = node.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return _scans(node.executedPlan())
    if kind.endswith("QueryStageExec"):
        return _scans(node.plan())
    if kind == "ReusedExchangeExec":
        return []
    if kind == "FileSourceScanExec":
        return [node]
    children = node.children()
    return [scan for i in range(children.size()) for scan in _scans(children.apply(i))]


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_details_of_other_months_are_not_read(spark, sf_dir, threshold):
    store = warehouse_after_two_batches(spark, sf_dir, scratch_path(spark, "run"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        lines = summaries.order_lines(store.read("orders"), store.read("orderdetails"), BATCH_2)
        assert lines.collect()
        run = lines._jdf.queryExecution().executedPlan()
        [details] = [s for s in _scans(run) if "priceeach" in s.schema().simpleString()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    recent = "orderdate >= date '2001-07-16' or cancelleddate >= date '2001-07-16' or shippeddate >= date '2001-07-16'"
    months = [r[0] for r in store.read("orders").where(recent).select("order_month").distinct().collect()]
    wanted = store.read("orderdetails").where(F.col("order_month").isin(months)).count()
    metric = lambda name: details.metrics().apply(name).value()
    assert metric("numOutputRows") == wanted < store.read("orderdetails").count()
    assert metric("numFiles") < len(store.read("orderdetails").inputFiles())
    payments = store.read("payments", since=dt.date(2001, 7, 20))
    assert plan(payments).count("payment_month=2001") <= 2 and not payments.isEmpty()


def _shuffles(df):
    return len(re.findall("(?<!Broadcast)Exchange", plan(df)))


def test_lines_are_grouped_and_joined_with_their_orders_after_one_exchange(no_broadcast, sf_dir):
    assert _shuffles(fixture(no_broadcast, sf_dir, "fx_orderdetails")) == 1
    assert _shuffles(fixture(no_broadcast, sf_dir, "fx_orderdetails_b1")) == 2  # the lines and the orders


def test_lines_of_the_second_batch_are_chosen_before_they_are_grouped(spark, sf_dir):
    chosen = fixture(spark, sf_dir, "fx_orderdetails_b2")
    optimized = chosen._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.index("Aggregate") < optimized.index("LeftSemi")  # the semi join is below the grouping
    whole = fixture(spark, sf_dir, "fx_orderdetails").join(fixture(spark, sf_dir, "fx_orders_b2").select("ordernumber"), "ordernumber")
    counted = [F.count(F.lit(1)), F.sum("quantityordered"), F.sum("priceeach"), F.sum(F.hash("ordernumber", "productcode").cast("bigint"))]
    assert chosen.agg(*counted).first() == whole.agg(*counted).first()


def test_lines_of_a_load_are_checked_and_numbered_where_they_are(no_broadcast, sf_dir):
    facts = {t: fixture(no_broadcast, sf_dir, f"fx_{t}") for t in ("orders", "products")}
    dims = {
        "orders": facts["orders"].selectExpr("ordernumber as src_ordernumber", "ordernumber as dw_order_id", "trunc(orderdate, 'MM') as order_month"),
        "products": facts["products"].selectExpr("productcode as src_productcode", "1L as dw_product_id"),
    }
    rows = loads.resolved(ORDERDETAILS, staged(no_broadcast, sf_dir, "orderdetails"), dims)
    assert _shuffles(rows.groupBy(*ORDERDETAILS.dw_key).count()) == 0
    numbered, last = assign_keys_in_groups(rows, ORDERDETAILS.dw_key, "id", 0)
    assert numbered.count() == last == rows.count() > 0
    assert _shuffles(numbered) <= 1 and "rangepartitioning" not in plan(numbered)  # at most the orders' numbers


def test_first_months_are_grouped_and_written_after_one_exchange(spark):
    days = spark.range(5_000).select(
        F.date_add(F.lit(dt.date(2020, 1, 5)), (F.col("id") % 300).cast("int")).alias("summary_date"),
        (F.col("id") % 37).alias("dw_product_id"),
        *[F.lit(1).cast("bigint").alias(c) for c in ("customer_apd", "cancelled_product_qty", "cancelled_order_apd")],
        *[F.lit(1).cast("decimal(18,2)").alias(c) for c in ("product_cost_amount", "product_mrp_amount", "cancelled_cost_amount", "cancelled_mrp_amount")],
    )
    laid = days.repartitionByRange(first_of_month("summary_date"), "dw_product_id")
    assert _shuffles(summaries.product_months(laid)) == 1


def test_first_days_are_grouped_and_written_after_one_exchange_of_events(spark, sf_dir):
    facts = _facts(spark, sf_dir)
    lines = write_scratch(summaries.order_lines(facts["orders"], facts["orderdetails"], BATCH_2), "lines")
    assert _shuffles(summaries.daily_product_summary(lines, facts["products"], BATCH_2, laid_out=True)) == 1
    others = (facts["products"], facts["payments"], facts["customers"], BATCH_2)
    text = plan(summaries.daily_customer_summary(lines, *others, unique=True, laid_out=True))
    assert text.split("Union")[0].count("rangepartitioning") == 1 == text.split("Union")[0].count("Exchange")


@pytest.mark.parametrize("natural", [False, True], ids=["script", "model"])
def test_lines_are_added_up_per_order_where_they_are(spark, sf_dir, natural):
    facts = _facts(spark, sf_dir)
    orders = facts["orders"].withColumns({"order_month": first_of_month("orderdate"), "src_ordernumber": F.col("dw_order_id")})
    details = facts["orderdetails"].select("dw_order_id", "dw_product_id", F.col("dw_product_id").alias("src_productcode"), "quantityordered", "priceeach")
    details = details.join(orders.select("dw_order_id", "order_month", "src_ordernumber"), "dw_order_id")
    lines = write_bucketed(summaries.order_lines(orders, details, BATCH_2, natural), "lines", *summaries.line_key(natural))
    assert not lines.isEmpty()
    assert _shuffles(lines.groupBy("dw_order_id", "status", *summaries.line_key(natural)).count()) == 0


def test_only_queries_over_small_input_share_a_run(spark, sf_dir, monkeypatch):
    made = []
    monkeypatch.setattr(queries, "_RUNS", {})
    monkeypatch.setattr(queries, "warehouse_after_two_batches", lambda spark, sf_dir, root, way: made.append(root) or _Loaded())
    for _ in range(2):
        queries._after_both(spark, sf_dir, "script", None)
    assert len(made) == 1
    monkeypatch.setattr(queries, "_SHARED_BYTES", 1000)
    for _ in range(2):
        queries._after_both(spark, sf_dir, "script", None)
    assert len(set(made)) == 3


class _Loaded:
    def version(self, table):
        return Version(1, {"p": ("p",)})


def test_few_orders_of_a_batch_are_sent_to_the_lines(spark, sf_dir):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4000")  # below the size of the orders
    try:
        text = plan(fixture(spark, sf_dir, "fx_orderdetails_b2"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert re.search("BroadcastHashJoin.*LeftSemi", text)


def test_first_load_joins_its_lines_where_they_are(spark, sf_dir, monkeypatch):
    """Details of a first load are neither read back from their months nor exchanged again; later batches read the table."""
    joined, whole = [], []
    first, later = summaries.first_order_lines, summaries.order_lines
    monkeypatch.setattr(summaries, "first_order_lines", lambda *a: joined.append((_shuffles(first(*a)), a)) or first(*a))
    monkeypatch.setattr(summaries, "order_lines", lambda *a: whole.append(later(*a)) or later(*a))
    store = warehouse_after_two_batches(spark, sf_dir, scratch_path(spark, "first"))
    [(moved, (_, _, batch, _))] = joined
    assert moved == 0 and batch.no == 1 and len(whole) == 1
    assert store.read("monthly_product_summary").where("etl_batch_no = 1").count() > 0


@pytest.mark.parametrize("natural", [False, True], ids=["script", "model"])
def test_lines_of_a_first_load_are_those_of_the_table(spark, natural):
    day = dt.date(2001, 7, 20)
    orders = spark.createDataFrame(
        [(1, 11, day, 5, day, None, None, "In Process"), (2, 12, None, None, dt.date(1990, 1, 1), None, day, "Cancelled"), (3, 13, day, 6, dt.date(1990, 1, 1), None, None, "Shipped")],
        "src_ordernumber long, dw_order_id long, order_month date, dw_customer_id long, orderdate date, shippeddate date, cancelleddate date, status string",
    )
    details = spark.createDataFrame(
        [(1, 11, day, "a", 1, 2, 1.5), (1, 11, day, "b", None, 3, 2.0), (2, 12, None, "a", 1, None, 2.0), (3, 13, day, "a", 1, 1, 1.0), (4, None, None, "c", 3, 1, 1.0), (1, None, None, "d", 4, 1, 1.0)],
        "src_ordernumber long, dw_order_id long, order_month date, src_productcode string, dw_product_id long, quantityordered int, priceeach double",
    ).withColumn("priceeach", F.col("priceeach").cast("decimal(10,2)"))
    rows = write_bucketed(details, "rows", "src_ordernumber")
    got = summaries.first_order_lines(orders, rows, BATCH_2, natural)
    plain = summaries.order_lines(orders.drop("order_month"), details.drop("order_month"), BATCH_2, natural)
    columns = plain.columns
    assert _shuffles(got) == 0
    assert sorted(map(repr, got.select(columns).collect())) == sorted(map(repr, plain.collect())) and got.count() == (4 if natural else 3)


def test_days_of_a_month_are_rolled_up_without_a_shuffle(spark):
    days = spark.range(3_000).select(
        F.date_add(F.lit(dt.date(2020, 1, 5)), (F.col("id") % 300).cast("int")).alias("summary_date"),
        F.when(F.col("id") % 11 > 0, F.col("id") % 11).alias("k"),
        F.when(F.col("id") % 11 != 4, F.col("id")).alias("n"),
        F.when(F.col("id") % 3 > 0, (F.col("id") % 7 - 3).cast("decimal(18,2)")).alias("amount"),
        F.when(F.col("id") % 11 != 5, (F.col("id") % 2).cast("int")).alias("seen"),
    )
    stored = write_scratch(days_by_month(days, "k"), "days")
    want, got = (rollup_month(d, "k", ["n", "amount", "seen"], ["seen_too"], {"f": "seen"}) for d in (days.withColumn("seen_too", F.col("seen")), write_scratch(days_by_month(days.withColumn("seen_too", F.col("seen")), "k"), "days")))
    assert got.schema.simpleString() == want.schema.simpleString() and _shuffles(got) == 0
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    again = days_of(stored)
    assert sorted(map(repr, again.select(days.columns).collect())) == sorted(map(repr, days.collect()))


def test_few_keys_are_sent_to_the_rows_they_are_looked_up_in(spark):
    rows = spark.range(100).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    wanted = spark.createDataFrame([(3,), (3,), (None,), (200,)], "o long")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few = of_few(rows, "k", wanted, "o")
        assert [tuple(r) for r in few.collect()] == [(3, 6)] and "BroadcastHashJoin" in plan(few)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_lines_are_sent_once_for_all_their_events_of_a_month(spark):
    days = [(1, dt.date(2001, 7, 20), dt.date(2001, 7, 22)), (2, dt.date(2001, 7, 30), dt.date(2001, 8, 2)), (3, dt.date(2001, 7, 20), None), (4, None, None)]
    lines = spark.createDataFrame(days, "k long, orderdate date, cancelleddate date")
    kinds = {"ordered": ("orderdate", F.col("orderdate") >= dt.date(2001, 7, 16)), "cancelled": ("cancelleddate", F.col("cancelleddate").isNotNull())}
    rows = summaries._line_months(lines, kinds, "k")
    assert sorted(r.k for r in rows.collect()) == [1, 2, 2, 3]
    want = summaries._events(lines, kinds, "k")
    got = summaries._events_in_month(rows, kinds, "k").drop("__day_month")
    assert sorted(map(repr, got.select(want.columns).collect())) == sorted(map(repr, want.collect()))


def test_first_days_and_months_come_from_one_exchange(spark, sf_dir, request):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    request.addfinalizer(lambda: spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    facts = _facts(spark, sf_dir)
    lines = write_scratch(summaries.order_lines(facts["orders"], facts["orderdetails"], BATCH_2), "lines")
    days = summaries.daily_product_summary(lines, facts["products"], BATCH_2, laid_out=True, with_month=True)
    assert _shuffles(days_by_month(days, "dw_product_id")) == 1
    days = summaries.daily_customer_summary(lines, facts["products"], facts["payments"], facts["customers"], BATCH_2, unique=True, laid_out=True)
    text = plan(days_by_month(days, "dw_customer_id"))
    assert text.split("Union")[0].count("rangepartitioning") == 1 == text.split("Union")[0].count("Exchange")
