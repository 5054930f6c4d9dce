"""What may be sent to every task, and so be built in the driver, goes by rows and not by the size of files."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from batchloom.operators import lookup as lookups
from batchloom.operators.keys import assign_keys_in_groups
from batchloom.operators.lookup import lookup, measured
from batchloom.operators.merge import replace_by_key
from batchloom.operators.rollup import days_by_month, rollup_month
from batchloom.plans import loads, summaries
from batchloom.plans.fixtures import BATCH_2, fixture, staged
from batchloom.plans.queries import _facts
from batchloom.schemas import ORDERDETAILS
from batchloom.sources.files import write_bucketed, write_scratch


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def nothing_sent(monkeypatch):
    monkeypatch.setattr(lookups, "_SENT_BYTES", 0)


def test_many_keys_in_a_small_file_are_not_sent(spark):
    """A million consecutive numbers take some KB in a file and 46 MB as a table of keys."""
    rows = write_scratch(spark.range(1_000_000).select(F.col("id").alias("key"), F.lit(1).alias("v")), "dim", "zstd")
    facts = write_scratch(spark.range(0, 2_000_000, 100_000).select(F.col("id").alias("on")), "facts")
    assert "BroadcastHashJoin" in plan(lookup(facts, rows, "on", "key", {"v": "v"}))  # by the size of its file
    found = lookup(facts, measured(rows), "on", "key", {"v": "v"})
    assert "BroadcastHashJoin" not in plan(found)
    assert found.where("v = 1").count() == 10 and found.count() == 20
    few = rows.where("key < 1000")
    assert "BroadcastHashJoin" in plan(lookup(facts, measured(few), "on", "key", {"v": "v"}))


def test_days_that_give_way_are_found_without_sending_them(spark, nothing_sent):
    old = spark.createDataFrame([(1, "a"), (None, "b"), (3, "c")], "k int, v string")
    new = write_scratch(spark.createDataFrame([(None, "x"), (3, "y")], "k int, v string"), "new")
    left = replace_by_key(old, new, ["k"], null_safe=True)
    assert "BroadcastHashJoin" not in plan(left)
    assert sorted(left.collect(), key=str) == sorted([(1, "a"), (None, "x"), (3, "y")], key=str)


def test_numbers_of_groups_are_joined_without_sending_the_groups(spark, nothing_sent):
    rows = write_bucketed(spark.range(60).selectExpr("id div 3 as k", "cast(id as string) as p"), "lines", "k")
    numbered, last = assign_keys_in_groups(rows, ("k", "p"), "id", 5)
    assert last == 65 and sorted(r[0] for r in numbered.select("id").collect()) == list(range(6, 66))
    assert plan(numbered).count("BroadcastHashJoin") <= 1  # the bases of the partitions


@pytest.fixture
def first_lines(spark, sf_dir):
    """Lines of a first load, looked up with and without their prices; products 'P1..' are unknown."""
    facts = _facts(spark, sf_dir)
    orders = facts["orders"].withColumns({"src_ordernumber": F.col("dw_order_id"), "order_month": F.trunc("orderdate", "MM")})
    stored = {
        "orders": write_scratch(orders, "orders"),
        "products": write_scratch(facts["products"].where("src_productcode not like 'P1%'"), "products"),
    }
    dims = {"orders": stored["orders"].selectExpr("src_ordernumber", "cast(dw_order_id as bigint) dw_order_id", "order_month"), "products": stored["products"]}
    stage = staged(spark, sf_dir, "orderdetails")

    def lines(natural, along):
        options = loads.MODEL["orderdetails"]
        rows = loads.resolved(ORDERDETAILS, stage, dims, options, along={"products": summaries.PRICES} if along else {})
        return summaries.first_order_lines(stored["orders"], rows, BATCH_2, natural)

    return lines, stored["products"], facts


@pytest.mark.parametrize("rules", [summaries.SCRIPT, summaries.MODEL], ids=["script", "model"])
def test_lines_priced_when_looked_up_give_the_same_days(spark, first_lines, rules):
    lines, products, facts = first_lines
    found = []
    for along in (False, True):
        own = lines(rules.natural_keys, along)
        by_product = summaries.daily_product_summary(own, products, BATCH_2, rules, laid_out=True)
        by_customer = summaries.daily_customer_summary(own, products, facts["payments"], facts["customers"], BATCH_2, rules, unique=True, laid_out=True)
        assert ("msrp" in own.columns) is along
        found.append([sorted(map(str, days.collect())) for days in (by_product, by_customer)])
    assert found[0] == found[1] and all(found[0])


def test_priced_lines_meet_no_products_again(spark, first_lines, nothing_sent):
    lines, products, _ = first_lines
    days = summaries.daily_product_summary(lines(True, True), products, BATCH_2, summaries.MODEL, laid_out=True)
    # Products were joined in two further exchanges each for their ids and their prices.
    text = plan(days)
    assert "BroadcastHashJoin" not in text and text.count("rangepartitioning") == 1 == text.count("Exchange")


def test_orders_of_the_first_batch_are_sent_to_lines_only_if_few(spark, sf_dir, monkeypatch):
    from batchloom.plans import fixtures

    rows = {tuple(r) for r in fixture(spark, sf_dir, "fx_orderdetails_b1").collect()}
    monkeypatch.setattr(fixtures, "_FEW", 0)
    sorted_in = fixture(spark, sf_dir, "fx_orderdetails_b1")
    assert "BroadcastHashJoin" not in plan(sorted_in) and {tuple(r) for r in sorted_in.collect()} == rows


def test_days_stored_by_month_are_added_up_in_one_pass(spark):
    days = [(dt.date(2020, 1, d), 1, n, m) for d, n, m in ((1, 2, "1.50"), (2, None, "2.25"), (3, 5, None))]
    days += [(dt.date(2020, 1, 4), 2, None, None), (dt.date(2020, 2, 1), 2, 7, "-0.01")]
    daily = spark.createDataFrame([(*d[:3], None if d[3] is None else Decimal(d[3])) for d in days], "summary_date date, k int, n int, m decimal(18,2)")
    rolled = rollup_month(days_by_month(daily, "k"), "k", ["n", "m"], [], {"any": "n"})
    plain = rollup_month(daily, "k", ["n", "m"], [], {"any": "n"})
    got = sorted(tuple(r) for r in rolled.collect())
    assert got == sorted(tuple(r) for r in plain.collect())
    assert (dt.date(2020, 1, 1), 2, None, None) in [r[:4] for r in got]  # a sum of no values
    assert "filter(" not in plan(rolled) and "transform(" not in plan(rolled)  # no array is made on the way
