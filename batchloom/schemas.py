"""Declared tables: stage columns, warehouse columns, keys and foreign keys.

Nothing is inferred from files. Identifiers are lower case throughout.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

MONEY_SUM = T.DecimalType(18, 2)

_TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "money": T.DecimalType(10, 2),
    "money12": T.DecimalType(12, 2),
    "money_sum": MONEY_SUM,
}


def columns(text: str) -> T.StructType:
    """``"a int, b string"`` as a schema of nullable columns."""
    fields = [part.split() for part in text.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind], True) for name, kind in fields])


_SOURCE_STAMPS = ", create_timestamp timestamp, update_timestamp timestamp"

# Column lists of the eight source tables, in landing-file order.
STAGE: dict[str, T.StructType] = {
    "offices": columns(
        "officecode string, city string, phone string, addressline1 string, addressline2 string, "
        "state string, country string, postalcode string, territory string" + _SOURCE_STAMPS
    ),
    "employees": columns(
        "employeenumber bigint, lastname string, firstname string, extension string, email string, "
        "officecode string, reportsto bigint, jobtitle string" + _SOURCE_STAMPS
    ),
    "customers": columns(
        "customernumber bigint, customername string, contactlastname string, contactfirstname string, "
        "phone string, addressline1 string, addressline2 string, city string, state string, "
        "postalcode string, country string, salesrepemployeenumber bigint, creditlimit money" + _SOURCE_STAMPS
    ),
    "payments": columns(
        "customernumber bigint, checknumber string, paymentdate date, amount money12" + _SOURCE_STAMPS
    ),
    "orders": columns(
        "ordernumber bigint, orderdate date, requireddate date, shippeddate date, status string, "
        "customernumber bigint" + _SOURCE_STAMPS + ", cancelleddate date"
    ),
    "orderdetails": columns(
        "ordernumber bigint, productcode string, quantityordered int, priceeach money, orderlinenumber int"
        + _SOURCE_STAMPS
    ),
    "productlines": columns("productline string" + _SOURCE_STAMPS),
    "products": columns(
        "productcode string, productname string, productline string, productscale string, "
        "productvendor string, quantityinstock int, buyprice money, msrp money" + _SOURCE_STAMPS
    ),
}

CONTROL = columns("etl_batch_no int, etl_batch_date date")
BATCH_LOG = columns(
    "etl_batch_no int, etl_batch_date date, etl_batch_status string, "
    "etl_batch_start_time timestamp, etl_batch_end_time timestamp"
)

AUDIT = columns(
    "src_create_timestamp timestamp, src_update_timestamp timestamp, "
    "dw_create_timestamp timestamp, dw_update_timestamp timestamp, "
    "etl_batch_no int, etl_batch_date date"
)


@dataclass(frozen=True)
class Reference:
    """Foreign key: column ``on`` finds ``key`` in warehouse table ``table`` and yields ``take``.

    ``insert`` and ``update`` say what an unmatched row does on each path: ``inner`` leaves
    the row out, ``left`` keeps it with a NULL key, ``None`` means the path ignores the key.
    """

    table: str
    on: str
    key: str
    take: str
    alias: str
    insert: str | None = "inner"
    update: str | None = "inner"
    carry: tuple[str, ...] = ()


@dataclass(frozen=True)
class Entity:
    """How one stage table becomes one warehouse table."""

    table: str
    key: tuple[str, ...]
    id_col: str
    update_cols: tuple[str, ...]
    renames: tuple[tuple[str, str], ...] = ()
    references: tuple[Reference, ...] = ()
    extra: T.StructType = T.StructType([])
    partition: str | None = None
    partition_from: str | None = None
    append_only: bool = False

    @property
    def dw_key(self) -> list[str]:
        names = dict(self.renames)
        return [names.get(k, k) for k in self.key]

    @property
    def schema(self) -> T.StructType:
        names = dict(self.renames)
        fields = [T.StructField(self.id_col, T.LongType())]
        for field in STAGE[self.table].fields:
            if field.name not in ("create_timestamp", "update_timestamp"):
                fields.append(T.StructField(names.get(field.name, field.name), field.dataType))
        fields += [T.StructField(ref.alias, T.LongType()) for ref in self.references]
        fields += list(self.extra.fields) + list(AUDIT.fields)
        if self.partition:
            fields.append(T.StructField(self.partition, T.DateType()))
        return T.StructType(fields)


# Fixed values from here on: keys, updated columns and new names of the eight entities.
OFFICES = Entity(
    "offices",
    ("officecode",),
    "dw_office_id",
    ("city", "phone", "addressline1", "addressline2", "state", "country", "postalcode", "territory"),
)
EMPLOYEES = Entity(
    "employees",
    ("employeenumber",),
    "dw_employee_id",
    (
        "lastname", "firstname", "extension", "email", "officecode", "reportsto", "jobtitle", "dw_office_id",
    ),
    references=(Reference("offices", "officecode", "officecode", "dw_office_id", "dw_office_id"),),
    extra=columns("dw_reporting_employee_id bigint"),
)
CUSTOMERS = Entity(
    "customers",
    ("customernumber",),
    "dw_customer_id",
    (
        "contactlastname", "contactfirstname", "phone", "addressline1", "addressline2", "city", "state",
        "postalcode", "country", "salesrepemployeenumber", "creditlimit", "dw_sales_employee_id",
    ),
    renames=(("customernumber", "src_customernumber"),),
    references=(
        Reference(
            "employees", "salesrepemployeenumber", "employeenumber", "dw_employee_id", "dw_sales_employee_id",
            insert="left", update="left",
        ),
    ),
)
PAYMENTS = Entity(
    "payments",
    ("checknumber",),
    "dw_payment_id",
    (),
    renames=(("customernumber", "src_customernumber"),),
    references=(
        Reference("customers", "customernumber", "src_customernumber", "dw_customer_id", "dw_customer_id"),
    ),
    partition="payment_month",
    partition_from="paymentdate",
    append_only=True,
)
ORDERS = Entity(
    "orders",
    ("ordernumber",),
    "dw_order_id",
    ("requireddate", "cancelleddate", "shippeddate", "status", "comments"),
    renames=(("ordernumber", "src_ordernumber"), ("customernumber", "src_customernumber")),
    references=(
        Reference(
            "customers", "customernumber", "src_customernumber", "dw_customer_id", "dw_customer_id", update=None
        ),
    ),
    extra=columns("comments string"),
    partition="order_month",
    partition_from="orderdate",
)
PRODUCTLINES = Entity("productlines", ("productline",), "dw_product_line_id", ())
PRODUCTS = Entity(
    "products",
    ("productcode",),
    "dw_product_id",
    (
        "productname", "productline", "productscale", "productvendor", "productdescription",
        "quantityinstock", "buyprice", "msrp", "dw_product_line_id",
    ),
    renames=(("productcode", "src_productcode"),),
    references=(
        Reference("productlines", "productline", "productline", "dw_product_line_id", "dw_product_line_id"),
    ),
    extra=columns("productdescription string"),
)
ORDERDETAILS = Entity(
    "orderdetails",
    ("ordernumber", "productcode"),
    "dw_orderdetail_id",
    (
        "dw_order_id", "dw_product_id", "quantityordered", "priceeach", "orderlinenumber",
        "src_create_timestamp",
    ),
    renames=(("ordernumber", "src_ordernumber"), ("productcode", "src_productcode")),
    references=(
        Reference("products", "productcode", "src_productcode", "dw_product_id", "dw_product_id"),
        Reference(
            "orders", "ordernumber", "src_ordernumber", "dw_order_id", "dw_order_id", carry=("order_month",)
        ),
    ),
    partition="order_month",
)

# Dependency order: each table only looks up tables before it.
ENTITIES: dict[str, Entity] = {
    e.table: e
    for e in (OFFICES, EMPLOYEES, CUSTOMERS, PAYMENTS, ORDERS, PRODUCTLINES, PRODUCTS, ORDERDETAILS)
}


# Fixed values from here on: column lists of the histories and summaries.
def _history(id_col: str, tracked: str) -> T.StructType:
    return columns(
        f"{id_col} bigint, {tracked} money, effective_from_date date, effective_to_date date, "
        "dw_active_record_ind int, create_etl_batch_no int, create_etl_batch_date date, "
        "update_etl_batch_date date, dw_create_timestamp timestamp, dw_update_timestamp timestamp, "
        "update_etl_batch_no int"
    )


CUSTOMER_HISTORY = _history("dw_customer_id", "creditlimit")
PRODUCT_HISTORY = _history("dw_product_id", "msrp")

_DAY_BATCH = ", create_timestamp timestamp, etl_batch_no int, etl_batch_date date"
_MONTH_BATCH = (
    ", dw_create_timestamp timestamp, dw_update_timestamp timestamp, etl_batch_no int, etl_batch_date date"
)

DAILY_CUSTOMER = columns(
    "summary_date date, dw_customer_id bigint, order_count bigint, order_apd int, "
    "order_amount money_sum, order_cost_amount money_sum, order_mrp_amount money_sum, "
    "products_ordered_qty bigint, products_items_qty bigint, cancelled_order_count bigint, "
    "cancelled_order_amount money_sum, cancelled_order_apd int, shipped_order_count bigint, "
    "shipped_order_amount money_sum, shipped_order_apd int, payment_apd int, payment_amount money_sum, "
    "new_customer_apd int, new_customer_paid_apd int" + _DAY_BATCH + ", summary_month date"
)
DAILY_PRODUCT = columns(
    "summary_date date, dw_product_id bigint, customer_apd int, product_cost_amount money_sum, "
    "product_mrp_amount money_sum, cancelled_product_qty bigint, cancelled_cost_amount money_sum, "
    "cancelled_mrp_amount money_sum, cancelled_order_apd int, product_amount money_sum, cancelled_amount money_sum"
    + _DAY_BATCH + ", summary_month date"
)
MONTHLY_CUSTOMER = columns(
    "dw_customer_id bigint, order_count bigint, order_apd bigint, order_apm int, order_amount money_sum, "
    "order_cost_amount money_sum, order_mrp_amount money_sum, products_ordered_qty bigint, "
    "products_items_qty bigint, cancelled_order_count bigint, cancelled_order_amount money_sum, "
    "cancelled_order_apd bigint, cancelled_order_apm int, shipped_order_count bigint, "
    "shipped_order_amount money_sum, shipped_order_apd bigint, shipped_order_apm int, payment_apd bigint, "
    "payment_apm int, payment_amount money_sum, new_customer_apd bigint, new_customer_apm int, "
    "new_customer_paid_apd bigint, new_customer_paid_apm int" + _MONTH_BATCH + ", start_of_the_month_date date"
)
MONTHLY_PRODUCT = columns(
    "dw_product_id bigint, customer_apd bigint, customer_apm int, product_cost_amount money_sum, "
    "product_mrp_amount money_sum, cancelled_product_qty bigint, cancelled_cost_amount money_sum, "
    "cancelled_mrp_amount money_sum, cancelled_order_apd bigint, cancelled_order_apm int"
    + _MONTH_BATCH + ", start_of_the_month_date date"
)

# Warehouse table -> (schema, column it is stored by, or None).
WAREHOUSE: dict[str, tuple[T.StructType, str | None]] = {
    **{name: (e.schema, e.partition) for name, e in ENTITIES.items()},
    "customer_history": (CUSTOMER_HISTORY, "update_etl_batch_no"),
    "product_history": (PRODUCT_HISTORY, "update_etl_batch_no"),
    "daily_customer_summary": (DAILY_CUSTOMER, "summary_month"),
    "daily_product_summary": (DAILY_PRODUCT, "summary_month"),
    "monthly_customer_summary": (MONTHLY_CUSTOMER, "start_of_the_month_date"),
    "monthly_product_summary": (MONTHLY_PRODUCT, "start_of_the_month_date"),
    "batch_control_log": (BATCH_LOG, None),
}

# Carried state that is no table of the warehouse: the first payment day of every customer.
STATE: dict[str, tuple[T.StructType, str | None]] = {
    "first_payments": (columns("dw_customer_id bigint, first_paid date"), None),
}

# Tables whose rows are stored by range of an id, so that a batch rewrites only the ranges it touches.
RANGED: dict[str, str] = {
    "customer_history": "dw_customer_id",
    "product_history": "dw_product_id",
    "first_payments": "dw_customer_id",
}

# Snapshots that are stored in buckets of their natural key once they are large, so that looking keys up moves only the batch.
BUCKETED: dict[str, str] = {e.table: e.dw_key[0] for e in ENTITIES.values() if not e.partition}

# The key column whose least and largest value is recorded for each month of a fact table.
RANGE_KEYS: dict[str, str] = {e.table: e.dw_key[0] for e in ENTITIES.values() if e.partition}
