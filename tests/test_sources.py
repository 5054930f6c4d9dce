"""Landing CSV, stage, store and relational reads."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from batchloom.plans.fixtures import BATCH_1
from batchloom.plans.pipeline import stage_load
from batchloom.schemas import ORDERS, PRODUCTLINES, STAGE, columns
from batchloom.sources.files import exists, list_names, scratch_path, scratch_root, scratch_scope, size_of, write_scratch
from batchloom.sources.landing import LandingMissing, cut_by_bytes, read_csv, read_landing, write_landing
from batchloom.sources.relational import UnslicedRead, day_slices, extract_since, key_slices, slices_of
from batchloom.sources.store import Store

DAY = dt.date(2020, 1, 1)
SCHEMA = columns("id int, text string, amount money, day date, at timestamp")


def test_csv_keeps_every_value(spark):
    whole, fraction = dt.datetime(2020, 1, 2, 3, 4, 5), dt.datetime(2020, 1, 2, 3, 4, 5, 123456)
    data = [
        (1, 'say "hi"', Decimal("1.10"), DAY, whole),
        (2, "a,b", Decimal("-0.01"), DAY, fraction),
        (3, "two\nlines\r\nthree", None, None, None),
        (4, "", None, None, None),
        (5, None, None, None, None),
        (6, " padded ", None, None, None),
        (7, 'back\\slash "and" quote\\', None, None, None),
    ]
    root = scratch_path(spark, "landing")
    write_landing(spark.createDataFrame(data, SCHEMA), root, "t", DAY)
    got = read_landing(spark, root, "t", DAY, SCHEMA).orderBy("id").collect()
    # An empty text is an empty field, and an empty field is NULL.
    assert [tuple(r) for r in got] == [tuple(None if v == "" else v for v in row) for row in data]


def _write_text(spark, text):
    path = scratch_path(spark, "csv")
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    return path


def test_date_columns_accept_a_time_part(spark):
    path = _write_text(spark, "id,text,amount,day,at\n1,x,2.50,2020-01-01 00:00:00,2020-01-01 10:00:00")
    assert tuple(read_csv(spark, path, SCHEMA).first()) == (1, "x", Decimal("2.50"), DAY, dt.datetime(2020, 1, 1, 10))


@pytest.mark.parametrize("text", ["text,id,amount,day,at\nx,1,2,2020-01-01,", "id,text,amount,day,at\noops,x,2,2020-01-01,"])
def test_wrong_header_or_value_is_an_error(spark, text):
    with pytest.raises(Exception):
        read_csv(spark, _write_text(spark, text), SCHEMA).collect()


def test_landing_attempts_are_kept(spark):
    root = scratch_path(spark, "landing")
    schema = columns("id int")
    with pytest.raises(LandingMissing):
        read_landing(spark, root, "t", DAY, schema)
    first, second = (spark.createDataFrame([(i,)], schema) for i in (1, 2))
    paths = [write_landing(df, root, "t", DAY) for df in (first, second)]
    assert len(set(paths)) == 2
    assert read_landing(spark, root, "t", DAY, schema).first().id == 2
    assert read_landing(spark, root, "t", DAY, schema, attempt="first").first().id == 1


def test_landing_skips_an_attempt_that_never_committed(spark):
    root = scratch_path(spark, "landing")
    schema = columns("id int")
    write_landing(spark.createDataFrame([(1,)], schema), root, "t", DAY)
    broken = spark.createDataFrame([(2,)], schema).withColumn("id", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception):
        write_landing(broken, root, "t", DAY)
    assert read_landing(spark, root, "t", DAY, schema).first().id == 1


def test_stage_keeps_old_rows_when_a_file_does_not_parse(spark):
    root = scratch_path(spark, "run")
    store = Store(spark, root)
    good = spark.createDataFrame([("L", None, None)], STAGE["productlines"])
    write_landing(good, root, "productlines", BATCH_1.date)
    stage_load(store, root, "productlines", BATCH_1)
    write_landing(good.withColumn("update_timestamp", F.lit("never")), root, "productlines", BATCH_1.date)
    with pytest.raises(Exception):
        stage_load(store, root, "productlines", BATCH_1)
    assert store.read_stage("productlines").count() == 1


def test_store_snapshots_and_prune(spark):
    store = Store(spark, scratch_path(spark, "store"))
    assert store.read("productlines").schema == PRODUCTLINES.schema and store.read("orders").isEmpty()
    for n in (1, 2, 3):
        df = spark.createDataFrame([(n,)], "dw_product_line_id bigint")
        for name in PRODUCTLINES.schema.names[1:]:
            df = df.withColumn(name, F.lit(None).cast(PRODUCTLINES.schema[name].dataType))
        store.replace("productlines", df)
    store.prune(keep=1)
    assert [r[0] for r in store.read("productlines").select("dw_product_line_id").collect()] == [3]


def test_replace_partitions_touches_only_its_months(spark):
    store = Store(spark, scratch_path(spark, "store"))

    def orders(*pairs):
        df = spark.createDataFrame([(k, dt.date(2020, m, 1)) for k, m in pairs], "dw_order_id bigint, order_month date")
        missing = [f for f in ORDERS.schema.fields if f.name not in df.columns]
        return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])

    store.replace_partitions("orders", orders((1, 1), (2, 2)))
    store.replace_partitions("orders", orders((3, 2)))
    assert sorted(r[0] for r in store.read("orders").select("dw_order_id").collect()) == [1, 3]
    with pytest.raises(ValueError):
        store.replace("orders", orders((4, 4)))


def test_scratch_uses_the_named_folder_and_a_scope_drops_its_tables(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    with scratch_scope(spark):
        path = scratch_path(spark, "x")
        spark.range(1).write.parquet(path)
        assert write_scratch(spark.range(3).toDF("id"), "y").count() == 3
        assert exists(spark, path)
    assert not exists(spark, path)


def test_extract_is_inclusive_and_projects(spark):
    df = spark.createDataFrame([(1, dt.datetime(2020, 1, 1)), (2, dt.datetime(2019, 12, 31, 23, 59))], "id int, ts timestamp")
    assert extract_since(df, ["id"], "ts", DAY).collect() == [(1,)]


def test_day_slices_cover_everything_once():
    slices = day_slices("ts", DAY, dt.date(2020, 1, 11), 4)
    assert slices == [
        "ts >= DATE '2020-01-01' AND ts < DATE '2020-01-05'",
        "ts >= DATE '2020-01-05' AND ts < DATE '2020-01-09'",
        "ts >= DATE '2020-01-09'",
    ]
    assert day_slices("ts", DAY, DAY, 1) == ["ts >= DATE '2020-01-01'"]
    with pytest.raises(ValueError):
        day_slices("ts", DAY, DAY, 0)


def test_wide_rows_give_many_files_and_come_back(spark):
    root = scratch_path(spark, "landing")
    data = [(i, 'x"\n,' * (4000 if i % 7 == 0 else i % 5), None, None, None) for i in range(60)]
    df = spark.createDataFrame(data, SCHEMA).coalesce(2)
    path = write_landing(df, root, "t", DAY, limit=30_000)
    fs = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.listFiles(spark._jvm.org.apache.hadoop.fs.Path(path), True)
    sizes = []
    while found.hasNext():
        file = found.next()
        if file.getPath().getName().endswith(".csv"):
            sizes.append(file.getLen())
    row = 4000 * 5 + 100
    assert len(sizes) > 6 and max(sizes) <= 30_000 + row
    got = read_landing(spark, root, "t", DAY, SCHEMA).orderBy("id").collect()
    assert [tuple(r) for r in got] == [tuple(None if v == "" else v for v in r) for r in data]
    write_landing(df.limit(0), root, "empty", DAY)
    assert read_landing(spark, root, "empty", DAY, SCHEMA).count() == 0


def test_landing_is_cut_without_a_shuffle_over_batches_and_compressed(spark):
    root = scratch_path(spark, "landing")
    df = spark.range(4_000, numPartitions=2).select(
        F.col("id").cast("int").alias("id"), F.repeat(F.lit("x"), (F.col("id") % 90).cast("int")).alias("text")
    )
    schema = columns("id int, text string")
    assert "Exchange" not in cut_by_bytes(df, 10_000)._jdf.queryExecution().executedPlan().toString()
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")  # the sum goes on from batch to batch
    try:
        plain = write_landing(df, root, "t", DAY, limit=10_000)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    files = [f for f in list_names(spark, plain) if f.startswith("file=")]
    sizes = [size_of(spark, f"{plain}/{f}") for f in files]
    assert 15 < len(files) < 40 and max(sizes) <= 10_000 + 200
    packed = write_landing(df, root, "t", DAY, limit=10_000, compression="gzip")
    assert 0 < size_of(spark, packed) < size_of(spark, plain) / 2
    for attempt in ("first", "newest"):
        got = read_landing(spark, root, "t", DAY, schema, attempt)
        assert got.count() == 4_000 and got.agg(F.sum(F.length("text"))).first()[0] == sum(i % 90 for i in range(4_000))


def test_key_slices_cover_every_key_once():
    for bounds, rows in (((5, 104, 100), 10), ((1, 3, 50), 10), ((-7, 1000, 33), 10), ((0, 0, 99), 10)):
        slices = key_slices("k", bounds, rows)
        assert len(slices) <= -(-bounds[2] // rows)
        for k in (None, -100, *range(bounds[0] - 1, bounds[1] + 2), 10**6):
            text = [s.replace("k IS NULL", str(k is None)).replace("OR", "or").replace("AND", "and").replace(" = ", " == ") for s in slices]
            value = bounds[0] - 1 if k is None else k  # NULL compares as neither; the first slice names it
            hits = [eval(s, {"k": value}) for s in text]
            assert sum(hits) == 1 and (k is not None or hits[0])
    assert key_slices("k", (None, None, 0)) == ["1 = 1"] and key_slices("k", (1, 9, 9), 10) == ["1 = 1"]
    with pytest.raises(ValueError):
        key_slices("k", (1, 9, 9), 0)


def test_a_large_table_is_not_read_over_one_connection():
    asked = []

    def source(row):
        return lambda query: (asked.append(query), row)[1]

    assert slices_of(source((1, 100, 100)), "shop.orders", None, "id", 50) == ["(id < 51 OR id IS NULL)", "id >= 51"]
    assert "MIN(id)" in asked[0] and "FROM shop.orders" in asked[0]
    assert slices_of(source((Decimal(1), Decimal(9), 9)), "t", None, "id", 50) == ["1 = 1"]
    assert slices_of(source((40,)), "t", None, None, 50) == ["1 = 1"]
    assert slices_of(source(None), "t", ["a = 1"], None) == ["a = 1"]
    with pytest.raises(UnslicedRead):
        slices_of(source((51,)), "t", None, None, 50)
