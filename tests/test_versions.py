"""Tables stored in parts: publishing as a whole, what records know, and how much of a table a batch reads and rewrites."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from batchloom.operators.control import Batch
from batchloom.operators.history import scd2, updated_in
from batchloom.operators.keys import assign_keys_from
from batchloom.operators.lookup import lookup, lookup_bucketed, matches
from batchloom.plans import pipeline
from batchloom.schemas import CUSTOMERS, ORDERS, PAYMENTS, PRODUCT_HISTORY, STAGE, WAREHOUSE, columns
from batchloom.sources import versions
from batchloom.sources.files import list_names, scratch_path, write_text
from batchloom.sources.store import Store
from batchloom.sources.versions import Version


def batch(n):
    return Batch(n, dt.date(2020, 1, 1) + dt.timedelta(days=n), dt.datetime(2020, 1, 1) + dt.timedelta(days=n))


def padded(df, schema):
    """All columns of the schema, NULL where the rows have none."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def orders(spark, *pairs):
    rows = [(k, 100 + k, dt.date(2020, m, 1) if m else None) for k, m in pairs]
    return padded(spark.createDataFrame(rows, "dw_order_id bigint, src_ordernumber bigint, order_month date"), ORDERS.schema)


def ids(df):
    return sorted(r[0] for r in df.select("dw_order_id").collect())


@pytest.fixture
def store(spark):
    return Store(spark, scratch_path(spark, "store"), range_size=10)


class Watched(Store):
    """Notes which parts of which table are read."""

    def __init__(self, *args, **kwargs):
        super().__init__(*args, **kwargs)
        self.seen = []

    def read(self, table, since=None, only=None, at=None):
        only = None if only is None else sorted(only)
        self.seen.append((table, since, only))
        return super().read(table, since, only, at)


def jobs_of(spark, step):
    """How many Spark jobs a step starts."""
    group = f"probe-{random.random()}"
    spark.sparkContext.setJobGroup(group, "")
    try:
        value = step()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return value, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


# --- publishing --------------------------------------------------------------------------------


def test_a_write_that_fails_half_way_changes_nothing(spark, store):
    store.replace_partitions("orders", orders(spark, (1, 1), (2, 2)))
    broken = orders(spark, (3, 1), (4, 2), (5, 3)).withColumn(
        "status", F.when(F.col("dw_order_id") == 5, F.raise_error(F.lit("lost"))).cast("string")
    )
    for write in (store.replace_partitions, store.append):
        with pytest.raises(Exception, match="lost"):
            write("orders", broken)
        assert ids(store.read("orders")) == [1, 2]
    # Data that was written whole, but whose record was not, is not read either.
    orders(spark, (6, 1)).write.partitionBy("order_month").parquet(f"{store.root}/warehouse/orders/w=9")
    assert ids(store.read("orders")) == [1, 2]
    store.replace_partitions("orders", orders(spark, (7, 2), (8, None)))
    assert ids(store.read("orders")) == [1, 7, 8]
    store.prune(keep=1)
    assert ids(store.read("orders")) == [1, 7, 8]
    assert {n for n in list_names(spark, f"{store.root}/warehouse/orders") if n.startswith("w=")} == {"w=1", "w=10"}


def test_months_that_are_not_touched_keep_their_files(spark, store):
    store.replace_partitions("orders", orders(spark, (1, 1), (2, 2), (3, None)))
    before = {f for f in store.read("orders").inputFiles() if "=2020-02-01" not in f}
    store.replace_partitions("orders", orders(spark, (4, 2)))
    store.append("orders", orders(spark, (5, 2), (6, 4)))
    assert before < set(store.read("orders").inputFiles())
    assert ids(store.read("orders")) == [1, 3, 4, 5, 6]
    assert ids(store.read("orders", since=dt.date(2020, 2, 20))) == [3, 4, 5, 6]
    store.replace_partitions("orders", orders(spark, (7, 4)), also=[store.part_name("orders", None), store.part_name("orders", "2020-01-01")])
    assert ids(store.read("orders")) == [4, 5, 7]
    store.replace_partitions("orders", orders(spark))
    assert ids(store.read("orders")) == [4, 5, 7]


def test_a_record_that_is_cut_off_is_none_and_a_taken_number_is_an_error(spark, store):
    store.replace_partitions("orders", orders(spark, (1, 1)))
    folder = f"{store.root}/warehouse/orders"
    write_text(spark, f"{folder}/_versions/{2:012d}.json", '{"parts": {"order_mon')
    assert store.version("orders").number == 1 and ids(store.read("orders")) == [1]
    with pytest.raises(Exception, match="exists"):
        versions.write_record(spark, folder, Version(1))
    with pytest.raises(Exception, match="exists"):
        store.append("orders", orders(spark, (2, 1)))
    versions.drop_records(spark, folder, [2])
    store.append("orders", orders(spark, (3, 1)))
    assert ids(store.read("orders")) == [1, 3]


def test_tables_from_before_there_were_records(spark, store):
    orders(spark, (1, 1), (2, 2), (3, None)).write.partitionBy("order_month").parquet(f"{store.root}/warehouse/orders")
    assert ids(store.read("orders")) == [1, 2, 3] and store.highest_id("orders", "dw_order_id") == 3
    store.append("orders", orders(spark, (4, 2)))
    store.replace_partitions("orders", orders(spark, (5, 1)))
    assert ids(store.read("orders")) == [2, 3, 4, 5]
    store.prune()
    store.prune(keep=1)
    assert ids(store.read("orders")) == [2, 3, 4, 5]
    assert "order_month=2020-01-01" not in list_names(spark, f"{store.root}/warehouse/orders")


# --- what records know -------------------------------------------------------------------------


def test_the_highest_id_is_read_from_the_record(spark, store):
    store.append("orders", orders(spark, (1, 1), (9, 2)), {"max_id": {"dw_order_id": 9}})
    assert jobs_of(spark, lambda: store.highest_id("orders", "dw_order_id")) == (9, 0)
    store.append("orders", orders(spark, (12, 2)))  # by a writer that does not know
    assert jobs_of(spark, lambda: store.highest_id("orders", "dw_order_id"))[0] == 12
    customers = padded(spark.createDataFrame([(5,)], "dw_customer_id bigint"), CUSTOMERS.schema)
    assert jobs_of(spark, lambda: store.highest_id("customers", "dw_customer_id")) == (0, 0)
    store.replace("customers", customers, {"max_id": {"dw_customer_id": 5}})
    assert jobs_of(spark, lambda: store.highest_id("customers", "dw_customer_id")) == (5, 0)
    store.replace("customers", customers)
    assert store.highest_id("customers", "dw_customer_id") == 5


def test_keys_know_the_last_id(spark):
    rows = spark.createDataFrame([("b",), ("a",), ("c",)], "k string")
    keyed, last = assign_keys_from(rows, ["k"], "id", 7)
    assert last == 10 and sorted(map(tuple, keyed.collect())) == [("a", 8), ("b", 9), ("c", 10)]
    assert assign_keys_from(rows.limit(0), ["k"], "id", 7)[1] == 7


def test_months_that_cannot_hold_a_key(spark, store):
    store.replace_partitions("orders", orders(spark, (1, 1), (5, 1), (6, 2), (9, 2), (20, 3)))
    store.append("orders", orders(spark, (30, 2)))
    keys = lambda *k: spark.createDataFrame([(x,) for x in k], "src_ordernumber bigint")
    month = lambda m: store.part_name("orders", dt.date(2020, m, 1))
    assert store.holding("orders", keys(103)) == [month(1)]
    assert sorted(store.holding("orders", keys(105, 120, 500))) == [month(1), month(2), month(3)]
    assert store.holding("orders", keys(500, None)) == [] and store.holding("orders", keys()) == []
    unknown = padded(spark.createDataFrame([(40, dt.date(2020, 4, 1))], "dw_order_id bigint, order_month date"), ORDERS.schema)
    store.append("orders", unknown)
    assert store.holding("orders", keys(500)) == []  # only NULL keys: nothing can match
    found = store.version("orders")
    ranges = {f: r for f, r in found.facts["ranges"].items() if "2020-03" not in f}
    versions.write_record(spark, f"{store.root}/warehouse/orders", Version(found.number + 1, found.parts, {**found.facts, "ranges": ranges}))
    assert store.holding("orders", keys(500)) == [month(3)]


def _staged_orders(spark, store, *rows):
    schema = STAGE["orders"]
    stamp = dt.datetime(2020, 1, 1)
    made = spark.createDataFrame([(n, dt.date(2020, m, 5), s, 1, stamp, stamp) for n, m, s in rows], "ordernumber bigint, orderdate date, status string, customernumber bigint, create_timestamp timestamp, update_timestamp timestamp")
    store.replace_stage("orders", padded(made, schema))


def test_a_batch_is_classified_by_one_scan_of_the_keys_of_its_months(spark):
    store = Watched(spark, scratch_path(spark, "store"))
    store.replace("customers", padded(spark.createDataFrame([(1, 1)], "dw_customer_id bigint, src_customernumber bigint"), CUSTOMERS.schema))
    _staged_orders(spark, store, *[(100 * m + k, m, "Open") for m in range(1, 7) for k in range(5)])
    pipeline.load_table(store, ORDERS, batch(1))
    _staged_orders(spark, store, (203, 2, "Shipped"), (605, 6, "Open"), (700, 7, "Open"))
    store.seen.clear()
    pipeline.load_table(store, ORDERS, batch(2))
    month = lambda m: store.part_name("orders", dt.date(2020, m, 1))
    # The only month that can hold a known key is scanned for keys and rewritten; new rows are added to the others.
    assert [only for table, _, only in store.seen if table == "orders"] == [[month(2)], [month(2)]]
    parts = store.version("orders").parts
    assert {m: len(parts[month(m)]) for m in range(1, 8)} == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 6: 2, 7: 1}
    rows = store.read("orders").collect()
    assert len(rows) == 32 and {r.dw_order_id for r in rows} == set(range(1, 33))
    assert [r.status for r in rows if r.src_ordernumber == 203] == ["Shipped"]
    assert jobs_of(spark, lambda: store.highest_id("orders", "dw_order_id")) == (32, 0)


# --- histories ---------------------------------------------------------------------------------

ENTITY = "dw_product_id bigint, msrp decimal(10,2), etl_batch_no int, src_create_timestamp timestamp, src_update_timestamp timestamp"


def entities(spark, state):
    made, moved = dt.datetime(2019, 1, 1), dt.datetime(2019, 6, 1)
    rows = [(k, v, n, made, moved if updated else made) for k, (v, n, updated) in state.items()]
    return spark.createDataFrame([(k, F"{v}.00", n, a, b) for k, v, n, a, b in rows], "k bigint, v string, n int, a timestamp, b timestamp").select(
        F.col("k").alias("dw_product_id"), F.col("v").cast("decimal(10,2)").alias("msrp"), F.col("n").alias("etl_batch_no"),
        F.col("a").alias("src_create_timestamp"), F.col("b").alias("src_update_timestamp"),
    )


def versions_of(df):
    return sorted(repr(tuple(r)) for r in df.select(*PRODUCT_HISTORY.names).collect())


def test_a_batch_rewrites_only_the_ranges_of_its_ids(spark, store):
    state = {k: (k, 1, False) for k in range(1, 101)}
    pipeline.load_history(store, "product_history", entities(spark, state), "dw_product_id", "msrp", batch(1))
    part = lambda r: store.part_name("product_history", None, r)
    assert set(store.version("product_history").parts) == {part(r) for r in range(11)}
    before = {f for f in store.read("product_history").inputFiles() if f.split("id_range=")[1].split("/")[0] != "4"}
    state[44] = (1000, 2, True)
    pipeline.load_history(store, "product_history", entities(spark, state), "dw_product_id", "msrp", batch(2))
    after = set(store.read("product_history").inputFiles())
    assert len(before) >= 10 and before < after
    assert {f.split("id_range=")[1].split("/")[0] for f in after - before} == {"4"}
    got = store.read("product_history").where("dw_product_id = 44").orderBy("effective_from_date").collect()
    assert [(r.dw_active_record_ind, r.update_etl_batch_no) for r in got] == [(0, 2), (1, None)]


@pytest.mark.parametrize("way", ["at once", "next batch", "really updated"])
def test_a_history_by_ranges_equals_one_that_compares_everything(spark, store, way):
    rng = random.Random(way)
    state, plain = {}, spark.createDataFrame([], PRODUCT_HISTORY)
    for n in range(1, 6):
        for k in rng.sample(range(1, 40), 8):
            state[k] = (rng.choice([None, 5, 6, 7]) or 4, n, rng.random() < 0.7)
        now = entities(spark, state)
        reopen = {"at once": None, "next batch": F.lit(False), "really updated": updated_in(batch(n))}[way]
        load = lambda: pipeline.load_history(store, "product_history", now, "dw_product_id", "msrp", batch(n), reopen)
        load()
        plain = spark.createDataFrame(scd2(plain, now, "dw_product_id", "msrp", batch(n), reopen=reopen).collect(), PRODUCT_HISTORY)
        assert versions_of(store.read("product_history")) == versions_of(plain)
        if n in (2, 5):  # a batch that is repeated
            load()
            assert versions_of(store.read("product_history")) == versions_of(plain)
        store.prune(keep=1)
    assert store.version("product_history").facts["applied"] == [1, 2, 3, 4, 5]


def test_a_history_from_before_there_were_ranges(spark, store):
    state = {k: (k, 1, False) for k in range(1, 31)}
    first = scd2(spark.createDataFrame([], PRODUCT_HISTORY), entities(spark, state), "dw_product_id", "msrp", batch(1))
    first.write.partitionBy("update_etl_batch_no").parquet(f"{store.root}/warehouse/product_history")
    state[7] = (70, 2, True)
    now = entities(spark, state)
    pipeline.load_history(store, "product_history", now, "dw_product_id", "msrp", batch(2))
    assert versions_of(store.read("product_history")) == versions_of(scd2(first, now, "dw_product_id", "msrp", batch(2)))


# --- first payments ----------------------------------------------------------------------------


def test_first_payment_days_are_carried(spark):
    store = Watched(spark, scratch_path(spark, "store"), range_size=10)
    rng = random.Random(1)
    known = []
    for n in range(1, 5):
        paid = [(f"c{n}-{i}", rng.choice([None, *range(1, 35)]), dt.date(2020, rng.randint(1, 12) if n == 3 else n, rng.randint(1, 28))) for i in range(12)]
        known += paid
        rows = spark.createDataFrame(paid, "checknumber string, dw_customer_id bigint, paymentdate date")
        store.replace_stage("payments", padded(rows, STAGE["payments"]))
        stored = rows.withColumns({"payment_month": F.trunc("paymentdate", "month"), "etl_batch_no": F.lit(n)})
        store.append("payments", padded(stored, PAYMENTS.schema))
        store.seen.clear()
        state = pipeline.load_first_payments(store, batch(n))
        first = {}
        for _, customer, day in known:
            first[customer] = min(first.get(customer, day), day)
        assert {r[0]: r[1] for r in state.collect()} == first
        months = {store.part_name("payments", d.replace(day=1)) for _, _, d in paid}
        assert [set(only or ()) for table, _, only in store.seen if table == "payments"] == [months if n > 1 else set()]
        pipeline.load_first_payments(store, batch(n))
        assert {r[0]: r[1] for r in store.read("first_payments").collect()} == first


def test_every_part_column_is_declared():
    for table in WAREHOUSE:
        assert all(c == "id_range" or c in WAREHOUSE[table][0].names for c in Store.part_columns(table))
    assert columns("a int").names == ["a"]


# --- buckets -----------------------------------------------------------------------------------


def _customers(spark, *numbers):
    rows = spark.createDataFrame([(n, 1000 + n, "x" * 40) for n in numbers], "dw_customer_id bigint, src_customernumber bigint, customername string")
    return padded(rows, CUSTOMERS.schema)


def test_large_snapshots_are_stored_in_buckets_and_looked_up_without_moving_them(spark):
    small, large = Store(spark, scratch_path(spark, "store")), Store(spark, scratch_path(spark, "store"), bucket_bytes=3000)
    for store in (small, large):
        store.replace("customers", _customers(spark, *range(200)))
        assert store.buckets("customers") is None  # its size is known from the next publish on
        store.replace("customers", store.read("customers").unionByName(_customers(spark, 900)), {"max_id": {"dw_customer_id": 900}})
        assert store.read("customers").count() == 201 and store.read("customers").schema == CUSTOMERS.schema
        assert store.highest_id("customers", "dw_customer_id") == 900
    assert small.buckets("customers") is None
    key, number = large.buckets("customers")
    assert key == "src_customernumber" and number >= 4 and number & (number - 1) == 0
    assert spark.catalog.listTables() == []
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = spark.createDataFrame([(i, 1000 + i % 300 if i % 3 else 1007) for i in range(3000)] + [(-1, None)], "id bigint, customer bigint")
        take = {"dw_customer_id": "dw_customer_id"}
        found = lookup_bucketed(facts, large.read("customers"), "customer", "src_customernumber", take)
        plain = lookup(facts, small.read("customers"), "customer", "src_customernumber", take)
        assert sorted(map(repr, found.collect())) == sorted(map(repr, plain.collect()))
        text = matches(facts, large.read("customers"), "customer", "src_customernumber", take)._jdf.queryExecution().executedPlan().toString()
        side = text[text.rindex("Sort [__key") :]  # the dimension's side is printed last
        assert "Bucketed: true" in side and "Exchange" not in side and "Exchange" in text
        # Loading facts and the dimension itself goes through the buckets, too, and gives the same rows.
        for store in (small, large):
            _staged_orders(spark, store, *[(i, 1 + i % 12, "Open") for i in range(50)])
            stage = store.read_stage("orders").withColumn("customernumber", (1000 + F.col("ordernumber") * 5).cast(STAGE["orders"]["customernumber"].dataType))
            store.replace_stage("orders", stage)
            pipeline.load_table(store, ORDERS, batch(1))
            changed = _customers(spark).sparkSession.createDataFrame([(1005, 7), (1300, 8)], "customernumber bigint, creditlimit int")
            store.replace("employees", padded(spark.range(0), WAREHOUSE["employees"][0]))
            store.replace_stage("customers", padded(changed, STAGE["customers"]))
            pipeline.load_table(store, CUSTOMERS, batch(2))
        for table in ("orders", "customers"):
            assert sorted(map(repr, large.read(table).collect())) == sorted(map(repr, small.read(table).collect()))
        assert large.read("orders").where("dw_customer_id is not null").count() == 40 and large.read("customers").count() == 202
        assert large.buckets("customers")[1] >= 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
