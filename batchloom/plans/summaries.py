"""Daily and monthly customer and product summaries."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchloom.functions import first_of_month, to_cents
from batchloom.operators.branches import KIND, Measure, combine_kinds, sum_by_kind
from batchloom.operators.control import Batch
from batchloom.operators.lookup import measured
from batchloom.operators.ranking import first_day
from batchloom.operators.rollup import DAY_MONTH, DAYS, MONTH, accumulate, missing_months, rollup_month
from batchloom.schemas import MONEY_SUM, MONTHLY_CUSTOMER, MONTHLY_PRODUCT
from batchloom.sources.files import COMPRESSION, write_bucketed, write_scratch

_COUNT, _FLAG = T.LongType(), T.IntegerType()
# Order status texts.
SHIPPED, CANCELLED = "Shipped", "Cancelled"
#: Columns of products that lines are priced by.
PRICES = ("buyprice", "msrp")


@dataclass(frozen=True)
class DayRules:
    """Where the two ways of building the daily tables differ; the defaults follow the script way.

    count_items: products_items_qty counts lines instead of adding quantities.
    cancelled_needs_status: a cancelled date counts only on orders whose status says so.
    first_payment: new_customer_paid_apd marks a customer's first payment day instead of being 0.
    price_as_cost: the product "cost" columns hold quantity x sales price; otherwise they hold
        quantity x buying price and the sales amounts get columns of their own.
    cancel_is_active: customer_apd is 1 on a day that only has cancellations.
    combine: how the product branches are merged.
    natural_keys: products, and for product days orders, are found by their natural keys, as lines loaded before them
        have no ids. ``lines`` must then be ``order_lines(..., natural=True)``.
    """

    count_items: bool = False
    cancelled_needs_status: bool = False
    first_payment: bool = False
    price_as_cost: bool = True
    cancel_is_active: bool = True
    combine: str = "max"
    natural_keys: bool = False


SCRIPT = DayRules()
MODEL = DayRules(
    count_items=True,
    cancelled_needs_status=True,
    first_payment=True,
    price_as_cost=False,
    cancel_is_active=False,
    combine="sum",
    natural_keys=True,
)


def _since(day: str, batch: Batch) -> Column:
    return F.col(day) >= batch.date_col


def _cancelled(batch: Batch, rules: DayRules) -> Column:
    on_time = _since("cancelleddate", batch)
    return on_time & (F.col("status") == CANCELLED) if rules.cancelled_needs_status else on_time


def _shipped(batch: Batch) -> Column:
    return _since("shippeddate", batch) & (F.col("status") == SHIPPED)


def _heads(orders: DataFrame, batch: Batch, *key: str) -> DataFrame:
    """Orders placed, cancelled or shipped since the batch date."""
    wanted = _since("orderdate", batch) | _since("cancelleddate", batch) | _since("shippeddate", batch)
    return orders.where(wanted).select(*key, "dw_customer_id", "orderdate", "shippeddate", "cancelleddate", "status")


def order_lines(orders: DataFrame, orderdetails: DataFrame, batch: Batch, natural: bool = False) -> DataFrame:
    """Lines of the orders placed, cancelled or shipped since the batch date, with their amount in cents.

    Orders are filtered and stored before the join. When both tables carry their order month, the months of these
    orders (one value per month is all the driver learns) become a plain filter on the details, so that the partitions
    of other months are never listed or read, whichever way the join runs. Both daily tables and each of their groupings
    read these lines, so callers store them once (``write_scratch``) instead of joining again for every reader, or in buckets of the
    columns they are joined by (``line_key``), so that adding them up per order moves none of them.

    ``natural`` joins by the order's number instead of its id, as details loaded before their order have no id; such
    lines keep a NULL ``dw_order_id``, and every line keeps ``src_productcode``.
    """
    month = [c for c in ("order_month",) if c in orders.columns and c in orderdetails.columns]
    key = "src_ordernumber" if natural else "dw_order_id"
    heads = _heads(orders, batch, key, *month)
    named = ["dw_order_id", "src_productcode"] if natural else []
    if month:
        heads = measured(write_scratch(heads, "order-heads", COMPRESSION))
        months = [r[0] for r in heads.select(*month).distinct().collect()]
        here = F.col("order_month").isin([m for m in months if m is not None])
        # A line without an order id was stored without its order's month, too.
        orderdetails = orderdetails.where(here | F.col("order_month").isNull() if natural else here)
    together = line_key(natural) if month or natural else [key]
    lines = orderdetails.select(key, *([] if natural else month), *named, "dw_product_id", "quantityordered", "priceeach")
    return _in_cents(heads.join(lines, together)).drop(*(month if natural else ()))


def first_order_lines(orders: DataFrame, rows: DataFrame, batch: Batch, natural: bool = False) -> DataFrame:
    """``order_lines`` of a table of details that was empty before the batch, from the ``rows`` the batch has brought.

    These are stored in buckets of their order's number, and so are the orders here: every reader joins them where they are, and the
    details are neither read back from their months, exchanged nor stored again. Details find their order by its number, so
    joining by the number, for lines that have an id, is joining by the id. Prices that the rows were looked up with stay with the lines,
    which then neither need to find their products by code nor to look for their prices.
    """
    heads = measured(write_bucketed(_heads(orders, batch, "src_ordernumber"), "order-heads", "src_ordernumber"))
    named = [*(["src_productcode"] if natural else []), *[c for c in PRICES if c in rows.columns]]
    lines = rows.select("src_ordernumber", "dw_order_id", *named, "dw_product_id", "quantityordered", "priceeach")
    return _in_cents(heads.join(lines if natural else lines.dropna(subset=["dw_order_id"]), "src_ordernumber"))


def _in_cents(lines: DataFrame) -> DataFrame:
    return lines.withColumn("cents", to_cents(F.col("priceeach")) * F.col("quantityordered")).drop("priceeach")


def line_key(natural: bool = False) -> list[str]:
    """The columns that ``order_lines`` of tables stored by month are joined by."""
    return ["src_ordernumber"] if natural else ["dw_order_id", "order_month"]


def with_known_products(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Lines with the product id their product has by now, found by the product's code."""
    if _priced(lines):  # looked up in this batch
        return lines
    now = measured(products.select("src_productcode", "dw_product_id"))
    return lines.drop("dw_product_id").join(now, "src_productcode", "left")


def _priced(lines: DataFrame) -> bool:
    return set(PRICES) <= set(lines.columns)


def with_prices(lines: DataFrame, products: DataFrame, how: str = "left") -> DataFrame:
    """Lines with their product's prices and with ``known``, true where there is such a product; ``inner`` leaves the others out."""
    if _priced(lines):
        lines = lines.withColumn("known", F.when(F.col("dw_product_id").isNotNull(), F.lit(True)))
        return lines.where("known") if how == "inner" else lines
    prices = measured(products.select("dw_product_id", *PRICES))
    return lines.join(prices.withColumn("known", F.lit(True)), "dw_product_id", how)


def _events(df: DataFrame, events: dict[str, tuple[str, Column]], *keep: str) -> DataFrame:
    """One row per fact and kind: ``events`` maps a kind to its day column and its condition."""
    structs = [
        F.when(cond, F.struct(F.lit(kind).alias(KIND), F.col(day).alias("summary_date")))
        for kind, (day, cond) in events.items()
    ]
    exploded = df.select(*keep, F.explode(F.array(*structs)).alias("event")).where("event is not null")
    return exploded.select("event.kind", "event.summary_date", *keep)


def daily_customer_summary(
    lines: DataFrame,
    products: DataFrame,
    payments: DataFrame,
    customers: DataFrame,
    batch: Batch,
    rules: DayRules = SCRIPT,
    first_payments: DataFrame | None = None,
    unique: bool = False,
    laid_out: bool = False,
) -> DataFrame:
    """One row per (day, customer) with order, cancel, ship, payment and new-customer measures.

    ``lines`` are the ``order_lines`` of the batch. They are reduced per order for the counts and amounts of all three order events, and per
    (day, customer, product) for the product measures, so the distinct counts become plain sums
    over pre-aggregated rows. Everything meets in a single grouping by (day, customer).

    Rules that mark a customer's first payment find its day in ``first_payments`` (dw_customer_id, first_paid), or, without it, in
    ``payments``, which must then be all payments.

    ``unique`` says that no product and no (order, product) repeats, as in loaded tables: the product measures are then added up per
    order, too (see ``_per_order``). ``laid_out`` brings the facts together by month and customer in one exchange, ready to be written.
    """
    ordered, cancelled, shipped = _since("orderdate", batch), _cancelled(batch, rules), _shipped(batch)
    customer = "dw_customer_id"
    if rules.natural_keys:
        lines = with_known_products(lines.where(F.col("dw_order_id").isNotNull()), products)

    kinds = {"cancelled": ("cancelleddate", cancelled), "shipped": ("shippeddate", shipped)}
    if unique:
        per_order, repeats = _per_order(lines, products, ordered, rules)
        order_events = _events(per_order, kinds, customer, "cents").withColumn("orders", F.lit(1))
        placed = _events(per_order, {"ordered": ("orderdate", ordered & (F.col("product_lines") > 0))}, customer, *_PER_ORDER)
        product_events = placed.withColumn("orders", F.lit(1)).unionByName(repeats, allowMissingColumns=True)
    else:
        per_order = lines.groupBy("dw_order_id", customer, "orderdate", "shippeddate", "cancelleddate", "status").agg(
            F.sum("cents").alias("cents"), F.count("dw_product_id").alias("product_lines")
        )
        order_events = _events(
            per_order,
            {
                "ordered": ("orderdate", ordered & (F.col("product_lines") > 0)),
                **kinds,
            },
            customer,
            "cents",
        ).withColumn("orders", F.lit(1))

        # dw_product_id only ever comes from products, so a non-NULL id always finds its product.
        per_product = (
            lines.where(ordered & F.col("dw_product_id").isNotNull())
            .groupBy(F.col("orderdate").alias("summary_date"), customer, "dw_product_id")
            .agg(
                F.sum("cents").alias("sales"),
                F.sum("quantityordered").alias("qty"),
                F.count("quantityordered").alias("n_lines"),
            )
        )
        prices = products.select("dw_product_id", "buyprice", "msrp")
        product_events = per_product.join(prices, "dw_product_id").select(
            F.lit("ordered").alias(KIND),
            "summary_date",
            customer,
            "sales",
            (to_cents(F.col("buyprice")) * F.col("qty")).alias("cost"),
            (to_cents(F.col("msrp")) * F.col("qty")).alias("mrp"),
            F.lit(1).alias("products"),
            F.col("n_lines" if rules.count_items else "qty").alias("items"),
        )

    paid = (
        payments.where(_since("paymentdate", batch))
        .groupBy(F.col("paymentdate").alias("summary_date"), customer)
        .agg(F.sum(to_cents(F.col("amount"))).alias("cents"))
    )
    if rules.first_payment:
        # Payments without a known customer are ranked together, as one customer.
        first = first_day(payments, customer, "paymentdate", "first_paid") if first_payments is None else measured(first_payments)
        first = first.withColumnRenamed(customer, "__payer")
        paid = paid.join(first, paid[customer].eqNullSafe(first["__payer"]), "left").withColumn(
            "first", F.when(F.col("summary_date") == F.col("first_paid"), F.lit(1)).otherwise(F.lit(0))
        ).drop("first_paid", "__payer")
    else:
        paid = paid.withColumn("first", F.lit(0))
    paid_events = paid.withColumn(KIND, F.lit("paid"))

    new_events = customers.where(
        F.col("src_create_timestamp") >= batch.date_col.cast("timestamp")
    ).select(
        F.lit("new").alias(KIND), F.col("src_create_timestamp").cast("date").alias("summary_date"), customer
    )

    events = (
        order_events.unionByName(product_events, allowMissingColumns=True)
        .unionByName(paid_events, allowMissingColumns=True)
        .unionByName(new_events, allowMissingColumns=True)
    )
    measures = [
        Measure("order_count", "ordered", _COUNT, source="orders"),
        Measure("order_apd", "ordered", _FLAG, "present"),
        Measure("order_amount", "ordered", MONEY_SUM, "sum0", "sales", cents=True),
        Measure("order_cost_amount", "ordered", MONEY_SUM, source="cost", cents=True),
        Measure("order_mrp_amount", "ordered", MONEY_SUM, source="mrp", cents=True),
        Measure("products_ordered_qty", "ordered", _COUNT, source="products"),
        Measure("products_items_qty", "ordered", _COUNT, source="items"),
        Measure("cancelled_order_count", "cancelled", _COUNT, source="orders"),
        Measure("cancelled_order_amount", "cancelled", MONEY_SUM, source="cents", cents=True),
        Measure("cancelled_order_apd", "cancelled", _FLAG, "present"),
        Measure("shipped_order_count", "shipped", _COUNT, source="orders"),
        Measure("shipped_order_amount", "shipped", MONEY_SUM, source="cents", cents=True),
        Measure("shipped_order_apd", "shipped", _FLAG, "present"),
        Measure("payment_apd", "paid", _FLAG, "present"),
        Measure("payment_amount", "paid", MONEY_SUM, source="cents", cents=True),
        Measure("new_customer_apd", "new", _FLAG, "present"),
        Measure("new_customer_paid_apd", "paid", _FLAG, "max", "first"),
    ]
    keys = ["summary_date", customer]
    folded = sum_by_kind(_by_month(events, customer), [_month_of_day(), *keys], measures) if laid_out else sum_by_kind(events, keys, measures)
    return combine_kinds(folded, keys, measures, "max")


#: Product measures of an order.
_PER_ORDER = ("sales", "cost", "mrp", "products", "items")


def _month_of_day() -> Column:
    return first_of_month("summary_date").alias(DAY_MONTH)


def _by_month(events: DataFrame, key: str) -> DataFrame:
    """Events brought together by month and key, so that they are grouped by day and written by month where they are."""
    return events.repartitionByRange(first_of_month("summary_date"), key)


def _per_order(lines: DataFrame, products: DataFrame, ordered: Column, rules: DayRules) -> tuple[DataFrame, DataFrame]:
    """One stored row per order with its amounts and product measures; and what the products of a (day, customer) count too often.

    Adding the products of orders up counts a product again for every further order of that day. Only customers with several orders
    on a day can have such products, so only their lines are grouped by product; the events have the number to take off.
    """
    customer = "dw_customer_id"
    lines = with_prices(lines, products).withColumns({"buy": to_cents(F.col("buyprice")), "list": to_cents(F.col("msrp"))})
    quantity = F.col("quantityordered")
    order = ["dw_order_id", customer, "orderdate", "shippeddate", "cancelleddate", "status"]
    # The columns that lines are stored by are the order's, too, and let them stay where they are.
    stored_by = [c for c in ("src_ordernumber", "order_month") if c in lines.columns]
    per_order = lines.groupBy(*order, *stored_by).agg(
        F.sum("cents").alias("cents"),
        F.count("dw_product_id").alias("product_lines"),
        F.sum(F.when(F.col("known"), F.col("cents"))).alias("sales"),
        F.sum(F.col("buy") * quantity).alias("cost"),
        F.sum(F.col("list") * quantity).alias("mrp"),
        F.count("known").alias("products"),
        (F.count if rules.count_items else F.sum)(F.when(F.col("known"), quantity)).alias("items"),
    )
    per_order = write_scratch(per_order.drop("dw_order_id", *stored_by), "per-order", COMPRESSION)
    placed = per_order.where(ordered & (F.col("products") > 0))
    several = placed.groupBy(F.col("orderdate").alias("__day"), F.col(customer).alias("__customer")).count().where("count > 1")
    several = measured(write_scratch(several.drop("count"), "several-orders", COMPRESSION))  # mostly few
    same = (lines["orderdate"] == several["__day"]) & lines[customer].eqNullSafe(several["__customer"])
    repeats = (
        lines.where(ordered & F.col("known"))
        .join(several, same, "left_semi")
        .groupBy(F.col("orderdate").alias("summary_date"), customer, "dw_product_id")
        .agg((F.lit(1) - F.count(F.lit(1))).alias("products"))
        .where("products < 0")
    )
    return per_order, repeats.drop("dw_product_id").withColumn(KIND, F.lit("ordered"))


def _line_months(df: DataFrame, days: dict[str, tuple[str, Column]], key: str, *keep: str) -> DataFrame:
    """Rows brought together by key and month, once for each different month of their events, which ``_events_in_month`` finds there.

    ``days`` are as in ``_events``. Events of a row mostly fall into one month, so that it is sent once for all of them.
    """
    days_of_kinds = [F.when(cond, F.col(day)).alias(_day_of(kind)) for kind, (day, cond) in days.items()]
    months = F.array_distinct(F.filter(F.array(*[F.when(cond, first_of_month(day)) for day, cond in days.values()]), lambda m: m.isNotNull()))
    return df.select(key, *keep, *days_of_kinds, F.explode(months).alias(DAY_MONTH)).repartitionByRange(DAY_MONTH, key)


def _events_in_month(rows: DataFrame, kinds: Iterable[str], *keep: str) -> DataFrame:
    here = {kind: (_day_of(kind), first_of_month(_day_of(kind)) == F.col(DAY_MONTH)) for kind in kinds}
    return _events(rows, here, DAY_MONTH, *keep)


def _day_of(kind: str) -> str:
    return f"__{kind}_day"


def daily_product_summary(
    lines: DataFrame, products: DataFrame, batch: Batch, rules: DayRules = SCRIPT, laid_out: bool = False, with_month: bool = False
) -> DataFrame:
    """One row per (day, product) with sales and cancellation measures of the ``order_lines``.

    Quantities and sales are added up per (day, product) before the product prices are joined:
    a price is constant within the group, so quantity sums times price give the same amounts and
    a best-selling product joins one row per day.

    ``laid_out`` multiplies each line by its prices instead, for products that do not repeat, and brings the lines together by month
    and product in one exchange, ready to be written. ``with_month`` keeps the month they were brought together by (``DAY_MONTH``).
    """
    ordered, cancelled = _since("orderdate", batch), _cancelled(batch, rules)
    if rules.natural_keys:
        lines = with_known_products(lines, products)
    month = [DAY_MONTH] if laid_out and with_month else []
    keys = ["summary_date", "dw_product_id"]
    days = {"ordered": ("orderdate", ordered), "cancelled": ("cancelleddate", cancelled)}
    # (order, product) is the key of the details, so counting lines counts orders.
    if laid_out:
        amounts = {"sales": F.col("cents"), "mrp": to_cents(F.col("msrp")) * F.col("quantityordered")}
        if not rules.price_as_cost:
            amounts["cost"] = to_cents(F.col("buyprice")) * F.col("quantityordered")
        priced_lines = with_prices(lines, products, "inner").withColumns(amounts)
        rows = _line_months(priced_lines, days, "dw_product_id", *amounts)
        events = _events_in_month(rows, days, "dw_product_id", *amounts).withColumn("orders", F.lit(1))
        sums = [Measure(f"{kind}_{amount}", kind, _COUNT, source=amount) for kind in days for amount in amounts]
        sums.append(Measure("cancelled_orders", "cancelled", _COUNT, source="orders"))
        priced = sum_by_kind(events, [DAY_MONTH, *keys], sums)
    else:
        known = lines.where(F.col("dw_product_id").isNotNull())
        events = _events(known, days, "dw_product_id", "quantityordered", "cents").withColumn("orders", F.lit(1))
        sums = [
            Measure("ordered_qty", "ordered", _COUNT, source="quantityordered"),
            Measure("ordered_sales", "ordered", _COUNT, source="cents"),
            Measure("cancelled_orders", "cancelled", _COUNT, source="orders"),
            Measure("cancelled_qty", "cancelled", _COUNT, source="quantityordered"),
            Measure("cancelled_sales", "cancelled", _COUNT, source="cents"),
        ]
        priced = sum_by_kind(events, keys, sums).join(measured(products.select("dw_product_id", *PRICES)), "dw_product_id")
        priced = priced.withColumns(
            {f"{kind}_cost": F.col(f"{kind}_qty") * to_cents(F.col("buyprice")) for kind in ("ordered", "cancelled")}
        ).withColumns({f"{kind}_mrp": F.col(f"{kind}_qty") * to_cents(F.col("msrp")) for kind in ("ordered", "cancelled")})

    def column(name: str, kind: str, source: str, type_: T.DataType = MONEY_SUM) -> tuple[str, Measure]:
        return source, Measure(name, kind, type_, cents=type_ is MONEY_SUM)

    if rules.price_as_cost:
        wanted = [
            column("product_cost_amount", "ordered", "ordered_sales"),
            column("product_mrp_amount", "ordered", "ordered_mrp"),
            column("cancelled_product_qty", "cancelled", "cancelled_orders", _COUNT),
            column("cancelled_cost_amount", "cancelled", "cancelled_sales"),
            column("cancelled_mrp_amount", "cancelled", "cancelled_mrp"),
        ]
    else:
        wanted = [
            column("product_cost_amount", "ordered", "ordered_cost"),
            column("product_amount", "ordered", "ordered_sales"),
            column("product_mrp_amount", "ordered", "ordered_mrp"),
            column("cancelled_product_qty", "cancelled", "cancelled_orders", _COUNT),
            column("cancelled_amount", "cancelled", "cancelled_sales"),
            column("cancelled_cost_amount", "cancelled", "cancelled_cost"),
            column("cancelled_mrp_amount", "cancelled", "cancelled_mrp"),
        ]
    named = priced.select(
        *month, *keys, "__has_ordered", "__has_cancelled", *[F.col(source).alias(m.name) for source, m in wanted]
    )
    measures = [
        Measure("customer_apd", "ordered", _FLAG, "present"),
        *[m for _, m in wanted],
        Measure("cancelled_order_apd", "cancelled", _FLAG, "present"),
    ]
    result = combine_kinds(named, [*month, *keys], measures, rules.combine)
    return result.withColumn("customer_apd", F.lit(1)) if rules.cancel_is_active else result


def finish_daily(daily: DataFrame, batch: Batch) -> DataFrame:
    """Add the audit columns and the month a daily row is stored under."""
    return daily.withColumns(
        {
            "create_timestamp": batch.run_col,
            "etl_batch_no": batch.no_col,
            "etl_batch_date": batch.date_col,
            "summary_month": first_of_month("summary_date"),
        }
    )


_CUSTOMER_ADDS = (
    "order_count", "order_amount", "order_cost_amount", "order_mrp_amount", "products_ordered_qty",
    "products_items_qty", "cancelled_order_count", "cancelled_order_amount", "shipped_order_count",
    "shipped_order_amount", "payment_amount",
)
_CUSTOMER_APDS = ("order_apd", "cancelled_order_apd", "shipped_order_apd", "payment_apd", "new_customer_apd")
_CUSTOMER_FLAGS = {apd.replace("_apd", "_apm"): apd for apd in _CUSTOMER_APDS}
_PRODUCT_ADDS = (
    "product_cost_amount", "product_mrp_amount", "cancelled_product_qty", "cancelled_cost_amount",
    "cancelled_mrp_amount",
)
_PRODUCT_APDS = ("customer_apd", "cancelled_order_apd")
_PRODUCT_FLAGS = {apd.replace("_apd", "_apm"): apd for apd in _PRODUCT_APDS}


def customer_months(daily: DataFrame, days_active: bool = True) -> DataFrame:
    """Customer months: ``*_apd`` is the number of active days, or 0/1 with ``days_active=False``."""
    sums = [*_CUSTOMER_ADDS, *(_CUSTOMER_APDS if days_active else ())]
    rolled = rollup_month(
        daily, "dw_customer_id", sums, () if days_active else _CUSTOMER_APDS, _CUSTOMER_FLAGS
    )
    return rolled.withColumns({"new_customer_paid_apd": F.lit(0), "new_customer_paid_apm": F.lit(0)})


def product_months(daily: DataFrame, days_active: bool = True) -> DataFrame:
    """Product months; see ``customer_months``."""
    sums = [*_PRODUCT_ADDS, *(_PRODUCT_APDS if days_active else ())]
    return rollup_month(daily, "dw_product_id", sums, () if days_active else _PRODUCT_APDS, _PRODUCT_FLAGS)


def _days_since(daily: DataFrame, batch: Batch) -> DataFrame:
    """The daily rows of the batch, also of days that are stored together by month (``days_by_month``)."""
    if DAYS not in daily.columns:
        return daily.where(_since("summary_date", batch))
    return daily.withColumn(DAYS, F.filter(DAYS, lambda day: day["summary_date"] >= batch.date_col)).where(F.size(DAYS) > 0)


def _stamps(batch: Batch) -> tuple[dict[str, Column], dict[str, Column]]:
    batch_cols = {"etl_batch_no": batch.no_col, "etl_batch_date": batch.date_col}
    return (
        {"dw_update_timestamp": batch.run_col, **batch_cols},
        {"dw_create_timestamp": batch.run_col, **batch_cols},
    )


def _accumulate_script(target: DataFrame, daily: DataFrame, batch: Batch, key: str, months, adds, apds, flags) -> DataFrame:
    """Add the batch's days to known months, then insert missing months from all their days."""
    on_update, on_insert = _stamps(batch)
    known = target.select(MONTH, key)
    in_batch = months(daily.where(_since("summary_date", batch)))
    delta = in_batch.join(known, [MONTH, key], "left_semi")
    missing = months(missing_months(daily, target, key))
    return accumulate(
        target,
        delta.unionByName(missing),
        [MONTH, key],
        adds=[*adds, *apds],
        ors=list(flags),
        update_stamps=on_update,
        insert_stamps=on_insert,
    )


def accumulate_customer_months(target: DataFrame, daily: DataFrame, batch: Batch) -> DataFrame:
    return _accumulate_script(
        target, daily, batch, "dw_customer_id", customer_months, _CUSTOMER_ADDS, _CUSTOMER_APDS, _CUSTOMER_FLAGS
    )


def accumulate_product_months(target: DataFrame, daily: DataFrame, batch: Batch) -> DataFrame:
    return _accumulate_script(
        target, daily, batch, "dw_product_id", product_months, _PRODUCT_ADDS, _PRODUCT_APDS, _PRODUCT_FLAGS
    )


def accumulate_customer_months_model(target: DataFrame, daily: DataFrame, batch: Batch) -> DataFrame:
    """Model way: only the batch's days; counts of new customers and orders replace the old values."""
    on_update, on_insert = _stamps(batch)
    delta = customer_months(_days_since(daily, batch), days_active=False)
    replaced = ["order_count", "new_customer_apd", "new_customer_apm", "new_customer_paid_apd", "new_customer_paid_apm"]
    return accumulate(
        target,
        delta,
        [MONTH, "dw_customer_id"],
        adds=[c for c in _CUSTOMER_ADDS if c not in replaced],
        greatests=[c for c in _CUSTOMER_APDS if c not in replaced],
        saturates={m: d for m, d in _CUSTOMER_FLAGS.items() if m not in replaced},
        replaces=replaced,
        update_stamps={**on_update, **on_insert},
        insert_stamps={**on_update, **on_insert},
    )


def accumulate_product_months_model(target: DataFrame, daily: DataFrame, batch: Batch) -> DataFrame:
    """Model way for products; the batch's days are rolled up first, so a month stays one row."""
    on_update, on_insert = _stamps(batch)
    delta = product_months(_days_since(daily, batch), days_active=False)
    return accumulate(
        target,
        delta,
        [MONTH, "dw_product_id"],
        adds=_PRODUCT_ADDS,
        greatests=_PRODUCT_APDS,
        saturates=_PRODUCT_FLAGS,
        update_stamps={**on_update, **on_insert},
        insert_stamps={**on_update, **on_insert},
    )


def recompute_months(months: DataFrame, target: DataFrame, schema: T.StructType, key: str, batch: Batch) -> DataFrame:
    """Month rows built from all their days, keeping the creation stamp of rows that already exist."""
    created = measured(target.select(MONTH, key, F.col("dw_create_timestamp").alias("__created")))
    known = F.col("__created").isNotNull()
    return (
        months.join(created, [MONTH, key], "left")
        .withColumns(
            {
                "dw_create_timestamp": F.coalesce(F.col("__created"), batch.run_col),
                "dw_update_timestamp": F.when(known, batch.run_col),
                "etl_batch_no": batch.no_col,
                "etl_batch_date": batch.date_col,
            }
        )
        .select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    )


def recompute_customer_months(daily: DataFrame, target: DataFrame, batch: Batch) -> DataFrame:
    return recompute_months(customer_months(daily), target, MONTHLY_CUSTOMER, "dw_customer_id", batch)


def recompute_product_months(daily: DataFrame, target: DataFrame, batch: Batch) -> DataFrame:
    return recompute_months(product_months(daily), target, MONTHLY_PRODUCT, "dw_product_id", batch)
