"""Hand-made edge rows for the operators."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchloom.operators.branches import Measure, union_branches
from batchloom.operators.control import Batch, close_batch, open_batch, read_control
from batchloom.operators.history import scd2
from batchloom.operators.distinct import count_bitmaps, count_distinct_ids, distinct_bitmaps, merge_bitmaps
from batchloom.operators.keys import assign_keys, assign_keys_from, assign_keys_in_groups
from batchloom.operators.lookup import lookup
from batchloom.operators.merge import (
    DuplicateKeyError,
    append,
    merge_update,
    merge_upsert,
    new_rows,
    reject_null_keys,
    replace_by_key,
    require_unique,
)
from batchloom.operators.ranking import rank_by_day
from batchloom.operators.rollup import accumulate, rollup_month
from batchloom.plans import loads, summaries
from batchloom.schemas import BATCH_LOG, CONTROL, CUSTOMER_HISTORY, OFFICES, PRODUCTS, STAGE, columns
from batchloom.sources.files import write_bucketed

B1 = Batch(1, dt.date(2020, 1, 10), dt.datetime(2020, 1, 10, 23))
B2 = Batch(2, dt.date(2020, 1, 20), dt.datetime(2020, 1, 20, 23))
B3 = Batch(3, dt.date(2020, 1, 30), dt.datetime(2020, 1, 30, 23))


def rows(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


# --- keys --------------------------------------------------------------------------------------


def test_keys_are_dense_ordered_and_start_after_the_maximum(spark):
    df = spark.range(5000).select(F.concat(F.lit("K"), F.xxhash64("id").cast("string")).alias("nk"), F.col("id").alias("v"))
    keyed = assign_keys(df.repartition(7), ["nk"], "dw_id", 100).collect()
    assert sorted(r.dw_id for r in keyed) == list(range(101, 5101))
    assert [r.nk for r in sorted(keyed, key=lambda r: r.dw_id)] == sorted(r.nk for r in keyed)


def test_keys_of_composite_key_and_of_no_rows(spark):
    df = spark.createDataFrame([(2, "a"), (1, "b"), (1, "a")], "o bigint, p string")
    assert rows(assign_keys(df, ["o", "p"], "dw_id"), "dw_id", "o", "p") == [(1, 1, "a"), (2, 1, "b"), (3, 2, "a")]
    assert assign_keys(df.where("o > 9"), ["o", "p"], "dw_id").count() == 0


def test_keys_in_groups_are_those_of_the_sorted_rows(spark):
    n = F.col("id")
    df = spark.range(9000).select(F.when(n % 3 == 0, F.lit(7)).otherwise(n % 1000).alias("o"), F.concat(F.lit("P"), n.cast("string")).alias("p"))
    stored = write_bucketed(df, "lines", "o")
    fewer = stored.where("p not like '%5'")
    numbered, last = assign_keys_in_groups(fewer, ["o", "p"], "dw_id", 40)
    wanted, same_last = assign_keys_from(df.where("p not like '%5'"), ["o", "p"], "dw_id", 40)
    assert rows(numbered, "dw_id", "o", "p") == rows(wanted, "dw_id", "o", "p") and last == same_last == 40 + fewer.count()
    none, last = assign_keys_in_groups(stored.where("o < 0"), ["o", "p"], "dw_id", 3)
    assert none.count() == 0 and last == 3
    assert spark.sql("show tables like 'batchloom_*'").isEmpty()


# --- merge -------------------------------------------------------------------------------------


def test_repeated_source_key_raises_and_null_keys_do_not(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(DuplicateKeyError):
        require_unique(df, ["k"])
    nulls = spark.createDataFrame([(None, "a"), (None, "b")], "k int, v string")
    require_unique(nulls, ["k"])
    assert reject_null_keys(nulls, ["k"]).count() == 0


def test_new_rows_keep_null_keys(spark):
    target = spark.createDataFrame([(1,), (None,)], "k int")
    source = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    assert rows(new_rows(source, target, ["k"]), "k") == [(2,), (None,)]


def test_update_sets_null_but_keeps_old_when_told(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, v string, n int")
    source = spark.createDataFrame([(1, None)], "k int, v string")
    assert rows(merge_update(target, source, ["k"], ["v"], {"n": F.lit(9)}), "k", "v", "n") == [(1, None, 9), (2, "b", 1)]
    kept = merge_update(target, source, ["k"], ["v"], keep_old_if_null=["v"])
    assert rows(kept, "k", "v") == [(1, "a"), (2, "b")]


def test_update_only_if_newer(spark):
    target = spark.createDataFrame([(1, "old", 5), (2, "old", 5), (3, "old", None)], "k int, v string, ts int")
    source = spark.createDataFrame([(1, "new", 6), (2, "new", 5), (3, "new", 7)], "k int, v string, ts int")
    expected = [(1, "new"), (2, "old"), (3, "old")]
    assert rows(merge_update(target, source, ["k"], ["v", "ts"], newer_by="ts"), "k", "v") == expected
    assert rows(merge_upsert(target, source, ["k"], ["v", "ts"], newer_by="ts"), "k", "v") == expected


def test_upsert_inserts_whole_row_and_updates_listed_columns(spark):
    target = spark.createDataFrame([(1, "a", "x")], "k int, listed string, other string")
    source = spark.createDataFrame([(1, "b", "y"), (2, "c", "z")], "k int, listed string, other string")
    merged = merge_upsert(target, source, ["k"], ["listed"])
    assert rows(merged, "k", "listed", "other") == [(1, "b", "x"), (2, "c", "z")]


def test_append_repeats_and_replace_does_not(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    assert append(append(target, new), new).count() == 6
    once = replace_by_key(target, new, ["k"])
    assert rows(replace_by_key(once, new, ["k"]), "k", "v") == [(1, "a"), (2, "c"), (3, "d")]


# --- loads -------------------------------------------------------------------------------------


def _stage(spark, table, dicts):
    schema = STAGE[table]
    return spark.createDataFrame([tuple(d.get(n) for n in schema.names) for d in dicts], schema)


def test_unmatched_foreign_key_leaves_row_out_or_keeps_it(spark):
    stage = _stage(spark, "products", [{"productcode": "A", "productline": "L"}, {"productcode": "B", "productline": "?"}])
    lines = spark.createDataFrame([("L", 7)], "productline string, dw_product_line_id bigint")
    empty = spark.createDataFrame([], PRODUCTS.schema)
    strict = loads.load_entity(PRODUCTS, stage, empty, {"productlines": lines}, B1)
    assert rows(strict, "src_productcode", "dw_product_line_id") == [("A", 7)]
    kept = loads.load_entity(PRODUCTS, stage, empty, {"productlines": lines}, B1, loads.MODEL["products"])
    assert rows(kept, "src_productcode", "dw_product_line_id", "productdescription") == [("A", 7, ""), ("B", None, "")]


def test_unmatched_foreign_key_skips_the_update(spark):
    lines = spark.createDataFrame([("L", 7)], "productline string, dw_product_line_id bigint")
    empty = spark.createDataFrame([], PRODUCTS.schema)
    first = loads.load_entity(
        PRODUCTS, _stage(spark, "products", [{"productcode": "A", "productline": "L", "productname": "old"}]), empty,
        {"productlines": lines}, B1,
    )
    again = _stage(spark, "products", [{"productcode": "A", "productline": "?", "productname": "new"}])
    after = loads.load_entity(PRODUCTS, again, first, {"productlines": lines}, B2)
    assert rows(after, "productname", "productline", "etl_batch_no") == [("old", "L", 1)]


def test_second_load_of_a_batch_changes_no_key_and_null_keys_are_rejected(spark):
    stage = _stage(spark, "offices", [{"officecode": "1", "city": "a"}, {"officecode": "2", "city": "b"}, {"city": "?"}])
    empty = spark.createDataFrame([], OFFICES.schema)
    once = loads.load_entity(OFFICES, stage, empty, {}, B1)
    twice = loads.load_entity(OFFICES, stage, once, {}, B1)
    assert rows(twice, "dw_office_id", "officecode", "city") == [(1, "1", "a"), (2, "2", "b")]


def test_repeated_stage_key_stops_the_load(spark):
    stage = _stage(spark, "offices", [{"officecode": "1"}, {"officecode": "1"}])
    with pytest.raises(DuplicateKeyError):
        loads.load_entity(OFFICES, stage, spark.createDataFrame([], OFFICES.schema), {}, B1)


def test_managers_none_value(spark):
    staff = spark.createDataFrame(
        [(10, None, 1, None), (20, 10, 2, None), (30, 99, 3, 5)],
        "employeenumber bigint, reportsto bigint, dw_employee_id bigint, dw_reporting_employee_id bigint",
    )
    names = ("employeenumber", "dw_reporting_employee_id")
    assert rows(loads.link_managers(staff), *names) == [(10, None), (20, 1), (30, None)]
    assert rows(loads.link_managers(staff, none_value=0), *names) == [(10, 0), (20, 1), (30, 0)]


def test_lookup_keeps_columns_that_share_the_key_name(spark):
    facts = spark.createDataFrame([(1, "x"), (2, "y")], "code int, v string")
    dim = spark.createDataFrame([(1, 100)], "code int, id int")
    assert rows(lookup(facts, dim, "code", "code", {"id": "dw_id"}), "code", "v", "dw_id") == [(1, "x", 100), (2, "y", None)]


# --- history -----------------------------------------------------------------------------------


def _limits(spark, *pairs):
    return spark.createDataFrame([(k, None if v is None else Decimal(v)) for k, v in pairs], "dw_customer_id bigint, creditlimit decimal(10,2)")


def _advance(spark, states, null_safe=False):
    history = spark.createDataFrame([], CUSTOMER_HISTORY)
    for batch, pairs in zip((B1, B2, B3), states):
        history = scd2(history, _limits(spark, *pairs), "dw_customer_id", "creditlimit", batch, null_safe)
    return sorted(
        (r.dw_customer_id, r.effective_from_date.day, r.effective_to_date and r.effective_to_date.day,
         None if r.creditlimit is None else int(r.creditlimit), r.dw_active_record_ind, r.update_etl_batch_no)
        for r in history.collect()
    )


def test_history_there_and_back(spark):
    assert _advance(spark, [[(1, 5)], [(1, 6)], [(1, 5)]]) == [
        (1, 10, 19, 5, 0, 2), (1, 20, 29, 6, 0, 3), (1, 30, None, 5, 1, None),
    ]


def test_history_null_changes(spark):
    states = [[(1, None), (2, 5)], [(1, 5), (2, None)]]
    assert _advance(spark, states) == [(1, 10, None, None, 1, None), (2, 10, None, 5, 1, None)]
    assert _advance(spark, states, null_safe=True) == [
        (1, 10, 19, None, 0, 2), (1, 20, None, 5, 1, None), (2, 10, 19, 5, 0, 2), (2, 20, None, None, 1, None),
    ]


def test_history_entity_missing_from_input_stays_open(spark):
    assert _advance(spark, [[(1, 5), (2, 5)], [(2, 6)]]) == [
        (1, 10, None, 5, 1, None), (2, 10, 19, 5, 0, 2), (2, 20, None, 6, 1, None),
    ]


def test_history_two_changes_on_one_day(spark):
    history = spark.createDataFrame([], CUSTOMER_HISTORY)
    for limit in (5, 6, 7):
        history = scd2(history, _limits(spark, (1, limit)), "dw_customer_id", "creditlimit", B1)
    assert history.where("dw_active_record_ind = 1").select("creditlimit").first()[0] == 7
    assert history.count() == 3


# --- branches and months -----------------------------------------------------------------------

_M = [
    Measure("a", "x", T.DecimalType(18, 2)),
    Measure("a_flag", "x", T.IntegerType(), "present"),
    Measure("b", "y", T.DecimalType(18, 2)),
]


def test_max_combiner_loses_a_negative_only_beside_another_kind(spark):
    x = spark.createDataFrame([(1, Decimal("-5.00")), (2, Decimal("-5.00")), (3, Decimal("4.00"))], "k int, a decimal(10,2)")
    y = spark.createDataFrame([(2, Decimal("1.00")), (4, None)], "k int, b decimal(10,2)")
    folded = union_branches({"x": x, "y": y}, ["k"], _M)
    assert rows(folded, "k", "a", "a_flag", "b") == [
        (1, Decimal("-5.00"), 1, Decimal("0.00")),
        (2, Decimal("0.00"), 1, Decimal("1.00")),
        (3, Decimal("4.00"), 1, Decimal("0.00")),
        (4, Decimal("0.00"), 0, None),
    ]
    summed = union_branches({"x": x, "y": y}, ["k"], _M, combine="sum")
    assert rows(summed.where("k = 2"), "a", "b") == [(Decimal("-5.00"), Decimal("1.00"))]


def test_rank_shares_ties(spark):
    paid = spark.createDataFrame(
        [(1, dt.date(2020, 1, 2)), (1, dt.date(2020, 1, 1)), (1, dt.date(2020, 1, 1)), (2, dt.date(2020, 5, 1))],
        "c int, d date",
    )
    assert rows(rank_by_day(paid, "c", "d"), "c", "rank1") == [(1, 1), (1, 1), (1, 3), (2, 1)]


def test_rollup_and_accumulate(spark):
    schema = columns("start_of_the_month_date date, k bigint, n bigint, amount money_sum, f int")
    days = spark.createDataFrame(
        [(dt.date(2020, 1, 3), 1, 1, Decimal("0.10"), 0), (dt.date(2020, 1, 9), 1, 2, Decimal("0.25"), 1)],
        "summary_date date, k bigint, n bigint, amount decimal(18,2), day_flag int",
    )
    month = rollup_month(days, "k", ["n", "amount"], flags={"f": "day_flag"})
    assert rows(month, *schema.names) == [(dt.date(2020, 1, 1), 1, 3, Decimal("0.35"), 1)]
    target = spark.createDataFrame([(dt.date(2020, 1, 1), 1, 1, None, 0), (dt.date(2020, 1, 1), 2, 1, Decimal("1.00"), 0)], schema)
    after = accumulate(target, month, ["start_of_the_month_date", "k"], adds=["n", "amount"], ors=["f"])
    assert rows(after, "k", "n", "amount", "f") == [(1, 4, Decimal("0.35"), 1), (2, 1, Decimal("1.00"), 0)]


def _day_tables(spark):
    d = dt.date(2020, 1, 15)
    orders = spark.createDataFrame(
        [(1, 101, 1, d, d, None, "Shipped"), (2, 102, 1, d, None, d, "Open"), (3, 103, 2, d, None, None, "Open")],
        "dw_order_id bigint, src_ordernumber bigint, dw_customer_id bigint, orderdate date, shippeddate date, cancelleddate date, status string",
    )
    details = spark.createDataFrame(
        [(1, 101, 10, "P10", 2, Decimal("1.50")), (1, 101, 11, "P11", 1, Decimal("2.00")), (2, 102, 10, "P10", 1, Decimal("4.00"))],
        "dw_order_id bigint, src_ordernumber bigint, dw_product_id bigint, src_productcode string, quantityordered int, priceeach decimal(10,2)",
    )
    products = spark.createDataFrame(
        [(10, "P10", Decimal("1.00"), Decimal("3.00")), (11, "P11", Decimal("1.10"), Decimal("3.30"))],
        "dw_product_id bigint, src_productcode string, buyprice decimal(10,2), msrp decimal(10,2)",
    )
    payments = spark.createDataFrame(
        [(3, d, Decimal("7.00")), (3, d, Decimal("1.00")), (3, dt.date(2019, 1, 1), Decimal("9.00"))],
        "dw_customer_id bigint, paymentdate date, amount decimal(12,2)",
    )
    customers = spark.createDataFrame([(4, dt.datetime(2020, 1, 15, 8))], "dw_customer_id bigint, src_create_timestamp timestamp")
    return orders, details, products, payments, customers


def test_customer_day_edges(spark):
    orders, details, products, payments, customers = _day_tables(spark)
    lines = summaries.order_lines(orders, details, B1)
    script = {r.dw_customer_id: r for r in summaries.daily_customer_summary(lines, products, payments, customers, B1).collect()}
    # An order without details leaves no day; a customer whose only event is a payment has one.
    assert set(script) == {1, 3, 4}
    one = script[1]
    assert (one.order_count, one.products_ordered_qty, one.products_items_qty) == (2, 2, 4)
    assert (one.order_amount, one.order_cost_amount, one.order_mrp_amount) == (Decimal("9.00"), Decimal("4.10"), Decimal("12.30"))
    assert (one.cancelled_order_count, one.cancelled_order_amount, one.shipped_order_amount) == (1, Decimal("4.00"), Decimal("5.00"))
    assert (script[3].payment_amount, script[3].payment_apd, script[3].new_customer_paid_apd) == (Decimal("8.00"), 1, 0)
    assert (script[4].new_customer_apd, script[4].order_count) == (1, 0)
    named = summaries.order_lines(orders, details, B1, natural=True)
    model = {
        r.dw_customer_id: r
        for r in summaries.daily_customer_summary(named, products, payments, customers, B1, summaries.MODEL).collect()
    }
    # The cancelled order's status does not say so; items are counted; an earlier payment exists.
    assert (model[1].cancelled_order_count, model[1].products_items_qty) == (0, 3)
    assert model[3].new_customer_paid_apd == 0


def test_cancel_day_without_order_day(spark):
    orders, details, products, *_ = _day_tables(spark)
    moved = orders.where("dw_order_id = 2").withColumn("orderdate", F.lit(dt.date(2019, 12, 1)))
    lines = summaries.order_lines(moved, details, B1)
    day = summaries.daily_product_summary(lines, products, B1).collect()
    assert [(r.customer_apd, r.product_cost_amount, r.cancelled_cost_amount, r.cancelled_order_apd) for r in day] == [
        (1, Decimal("0.00"), Decimal("4.00"), 1)
    ]


# --- control -----------------------------------------------------------------------------------


def test_control_row_and_log_errors(spark):
    with pytest.raises(ValueError):
        read_control(spark.createDataFrame([], CONTROL), B1.run_at)
    log = spark.createDataFrame([], BATCH_LOG)
    with pytest.raises(ValueError):
        close_batch(log, B1, B1.run_at)
    closed = close_batch(open_batch(log, B1), B1, B1.run_at + dt.timedelta(hours=1))
    assert [(r.etl_batch_no, r.etl_batch_status, r.etl_batch_end_time.hour) for r in closed.collect()] == [(1, "C", 0)]
    with pytest.raises(ValueError):
        close_batch(closed, B1, B1.run_at)


# --- distinct counts ---------------------------------------------------------------------------


def test_distinct_bitmaps_count_and_merge(spark):
    facts = spark.range(40_000).select(
        (F.col("id") % 5).alias("g"),
        (F.col("id") * 7 % 70_001 - 20).alias("a"),
        F.when(F.col("id") % 3 == 0, F.col("id") % 11).alias("b"),
        F.when(F.col("id") % 5 == 1, F.lit(1)).alias("c"),
    )
    names = {"a": "n_a", "b": "n_b", "c": "n_c"}
    counted = count_distinct_ids(facts, ["g"], names)
    plain = facts.groupBy("g").agg(*[F.count_distinct(c).alias(n) for c, n in names.items()])
    assert rows(counted, "g", *names.values()) == rows(plain, "g", *names.values())
    assert "Expand" not in counted._jdf.queryExecution().executedPlan().toString()
    # Two tables of bitmaps with common ids, merged into coarser groups.
    parts = [distinct_bitmaps(facts.where(w), ["g"], list(names)) for w in ("a < 30000", "a >= 10000")]
    both = parts[0].unionByName(parts[1]).withColumn("h", F.col("g") % 2)
    merged = count_bitmaps(merge_bitmaps(both, ["h"]), ["h"], names)
    plain = facts.withColumn("h", F.col("g") % 2).groupBy("h").agg(*[F.count_distinct(c).alias(n) for c, n in names.items()])
    assert rows(merged, "h", *names.values()) == rows(plain, "h", *names.values())
    assert count_distinct_ids(facts.where("g > 9"), ["g"], names).count() == 0
    assert tuple(count_distinct_ids(facts, [], {"b": "n"}).first()) == (11,)


def test_distinct_bitmaps_of_scattered_ids_stay_as_few_as_the_facts(spark):
    # Every group meets ids far apart, in two columns: pairs of buckets and wide bitmaps would outgrow the facts.
    facts = spark.range(2_000).select(
        (F.col("id") % 4).alias("g"), (F.col("id") * 100_003).alias("a"), (F.col("id") * -70_001).alias("b")
    )
    bitmaps = distinct_bitmaps(facts, ["g"], ["a", "b"])
    assert bitmaps.groupBy("counted").count().where("count <= 2000").count() == 2
    assert bitmaps.schema["bits"].dataType.simpleString() == "bigint"
    plan = distinct_bitmaps(facts, ["g"], ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    counted = count_bitmaps(bitmaps, ["g"], {"a": "n_a", "b": "n_b"})
    assert rows(counted, "g", "n_a", "n_b") == [(g, 500, 500) for g in range(4)]
