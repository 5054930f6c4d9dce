"""A customer, product and day that hold a third of all rows give the same results as brute force."""

import datetime as dt
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from batchloom.operators.control import Batch
from batchloom.operators.lookup import lookup
from batchloom.operators.merge import require_unique
from batchloom.operators.ranking import rank_by_day
from batchloom.plans import summaries

DAY0 = dt.date(2020, 1, 1)
BATCH = Batch(1, DAY0, dt.datetime(2020, 6, 1))
N = 6000


@pytest.fixture(scope="module")
def tables(spark):
    n = F.col("id")
    hot = n % 3 == 0
    orders = spark.range(N).select(
        n.alias("dw_order_id"),
        F.when(hot, F.lit(0)).otherwise(n % 500).alias("dw_customer_id"),
        F.date_add(F.lit(DAY0), F.when(hot, F.lit(0)).otherwise(n % 90).cast("int")).alias("orderdate"),
        F.when(n % 2 == 0, F.date_add(F.lit(DAY0), (n % 95).cast("int"))).alias("shippeddate"),
        F.lit(None).cast("date").alias("cancelleddate"),
        F.when(n % 2 == 0, F.lit("Shipped")).otherwise(F.lit("Open")).alias("status"),
    )
    details = spark.range(N * 2).select(
        (n % N).alias("dw_order_id"),
        (F.when(hot & (n < N), F.lit(0)).otherwise(n % 400 + 1) + F.when(n < N, F.lit(0)).otherwise(F.lit(1000))).alias("dw_product_id"),
        (n % 7 + 1).cast("int").alias("quantityordered"),
        (n % 1000 / 100).cast("decimal(10,2)").alias("priceeach"),
    )
    products = spark.range(2000).select(
        n.alias("dw_product_id"), (n % 50 / 10).cast("decimal(10,2)").alias("buyprice"), (n % 70 / 10).cast("decimal(10,2)").alias("msrp")
    )
    payments = spark.range(N).select(
        F.when(hot, F.lit(0)).otherwise(n % 500).alias("dw_customer_id"),
        F.date_add(F.lit(DAY0), (n % 60).cast("int")).alias("paymentdate"),
        (n % 10000 / 100).cast("decimal(12,2)").alias("amount"),
    )
    customers = spark.range(500).select(n.alias("dw_customer_id"), F.lit(dt.datetime(2020, 2, 2)).alias("src_create_timestamp"))
    return {"orders": orders, "details": details, "products": products, "payments": payments, "customers": customers}


@pytest.fixture(params=["broadcast", "shuffle"])
def joins(request, spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if request.param == "shuffle":
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_customer_days(tables, joins):
    lines = summaries.order_lines(tables["orders"], tables["details"], BATCH)
    days = summaries.daily_customer_summary(lines, tables["products"], tables["payments"], tables["customers"], BATCH)
    got = {(r.summary_date, r.dw_customer_id): r for r in days.collect()}

    price = {r.dw_product_id: r for r in tables["products"].collect()}
    by_order = defaultdict(list)
    for d in tables["details"].collect():
        by_order[d.dw_order_id].append(d)
    count, sales, cost, items, kinds, shipped = Counter(), Counter(), Counter(), Counter(), defaultdict(set), Counter()
    for o in tables["orders"].collect():
        k = (o.orderdate, o.dw_customer_id)
        count[k] += 1
        for d in by_order[o.dw_order_id]:
            sales[k] += d.priceeach * d.quantityordered
            cost[k] += price[d.dw_product_id].buyprice * d.quantityordered
            items[k] += d.quantityordered
            kinds[k].add(d.dw_product_id)
        if o.status == "Shipped":
            shipped[o.shippeddate, o.dw_customer_id] += 1
    paid = Counter()
    for p in tables["payments"].collect():
        paid[p.paymentdate, p.dw_customer_id] += p.amount
    new = {(r.src_create_timestamp.date(), r.dw_customer_id) for r in tables["customers"].collect()}

    assert set(got) == set(count) | set(shipped) | set(paid) | new
    for k, r in got.items():
        assert (r.order_count, r.order_amount, r.order_cost_amount) == (count[k], sales[k], cost[k])
        assert (r.products_ordered_qty, r.products_items_qty) == (len(kinds[k]), items[k])
        assert (r.shipped_order_count, r.payment_amount) == (shipped[k], paid[k])


def test_product_days(tables, joins):
    lines = summaries.order_lines(tables["orders"], tables["details"], BATCH)
    got = {(r.summary_date, r.dw_product_id): r for r in summaries.daily_product_summary(lines, tables["products"], BATCH).collect()}
    price = {r.dw_product_id: r for r in tables["products"].collect()}
    day = {o.dw_order_id: o.orderdate for o in tables["orders"].collect()}
    sales, mrp = Counter(), Counter()
    for d in tables["details"].collect():
        k = (day[d.dw_order_id], d.dw_product_id)
        sales[k] += d.priceeach * d.quantityordered
        mrp[k] += price[d.dw_product_id].msrp * d.quantityordered
    assert set(got) == set(sales)
    for k, r in got.items():
        assert (r.product_cost_amount, r.product_mrp_amount) == (sales[k], mrp[k])


def test_rank_and_lookup(tables, joins):
    payments = tables["payments"]
    ranked = rank_by_day(payments, "dw_customer_id", "paymentdate")
    days = defaultdict(Counter)
    for p in payments.collect():
        days[p.dw_customer_id][p.paymentdate] += 1
    got = ranked.collect()
    assert len(got) == N
    for r in got:
        assert r.rank1 == 1 + sum(n for d, n in days[r.dw_customer_id].items() if d < r.paymentdate)
    found = lookup(payments, tables["customers"].withColumnRenamed("dw_customer_id", "key"), "dw_customer_id", "key", {"key": "found"}, "inner")
    assert found.where("found = dw_customer_id").count() == N


def test_hot_repeated_key_is_reported(tables):
    with pytest.raises(ValueError):
        require_unique(tables["payments"], ["dw_customer_id"])


def test_hot_foreign_key_is_split_over_tasks(spark, tables):
    """With thresholds scaled down to the test data, the partition of the hot key is read by several tasks."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
    }
    old = {k: spark.conf.get(k) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        dim = tables["customers"].select(F.col("dw_customer_id").alias("key"), (F.col("dw_customer_id") + 1).alias("id"))
        found = lookup(tables["payments"], dim, "dw_customer_id", "key", {"id": "found"}, "left")
        got = found.collect()
        assert len(got) == N and all(r.found == r.dw_customer_id + 1 for r in got)
        assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("rules", [summaries.SCRIPT, summaries.MODEL], ids=["script", "model"])
def test_days_laid_out_by_month_are_the_same(tables, joins, rules):
    products = tables["products"].withColumn("src_productcode", F.col("dw_product_id").cast("string"))
    details = tables["details"].withColumns(
        {"src_ordernumber": F.col("dw_order_id"), "src_productcode": F.col("dw_product_id").cast("string")}
    )
    # Some lines without a product and some orders without a customer.
    details = details.withColumn("dw_product_id", F.expr("if(dw_order_id % 11 = 3, null, dw_product_id)"))
    orders = tables["orders"].withColumns(
        {
            "src_ordernumber": F.col("dw_order_id"),
            "dw_customer_id": F.expr("if(dw_order_id % 13 = 5, null, dw_customer_id)"),
            "cancelleddate": F.expr("if(dw_order_id % 5 = 1, date_add(orderdate, 40), null)"),
        }
    )
    lines = summaries.order_lines(orders, details, BATCH, rules.natural_keys)
    customers = (lines, products, tables["payments"], tables["customers"], BATCH, rules)
    plain = sorted(summaries.daily_customer_summary(*customers).collect(), key=str)
    assert sorted(summaries.daily_customer_summary(*customers, unique=True).collect(), key=str) == plain
    assert sorted(summaries.daily_customer_summary(*customers, unique=True, laid_out=True).collect(), key=str) == plain
    # A customer's products of a day are counted once, however many orders have them.
    hot = next(r for r in plain if r.dw_customer_id == 0 and r.summary_date == DAY0)
    assert hot.products_ordered_qty < 2 * hot.order_count
    plain = sorted(summaries.daily_product_summary(lines, products, BATCH, rules).collect(), key=str)
    assert sorted(summaries.daily_product_summary(lines, products, BATCH, rules, laid_out=True).collect(), key=str) == plain
