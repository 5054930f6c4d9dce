"""The registered queries as SQL for DuckDB over the same tables.

Each statement inlines the fixture views it needs. Results are shown as in ``queries.present``:
dates and times as ISO text, exact decimals as doubles.
"""

from __future__ import annotations

from collections.abc import Sequence

from batchloom.plans.fixtures import cte

ORACLES: dict[str, str] = {}

_B1, _B2 = "1995-01-01", "2001-07-16"
_RUN1, _RUN2 = "2001-07-15 23:00:00", "2001-07-16 23:00:00"

# How a column is shown: d date, t timestamp, m money, nothing for text and whole numbers.
_SHOWN = {"d": "strftime({c}, '%Y-%m-%d')", "t": "strftime({c}, '%Y-%m-%d %H:%M:%S')", "m": "cast({c} as double)"}


def show(columns: str, sql: str) -> str:
    """``columns`` is ``"name name:d name:m ..."``; the kind after the colon says how it is shown."""
    out = []
    for item in columns.split():
        name, _, kind = item.partition(":")
        out.append(f"{_SHOWN[kind].format(c=name)} as {name}" if kind else name)
    return f"select {', '.join(out)} from ({sql}) result"


def oracle(name: str, columns: str, sql: str, views: Sequence[str] = (), steps: Sequence[tuple[str, str]] = ()) -> None:
    """Register ``with <views>, <steps> select <columns> from (<sql>)``."""
    parts = ([cte(*views)] if views else []) + [f"{n} as ({text})" for n, text in steps]
    ORACLES[name] = (f"with {', '.join(parts)} " if parts else "") + show(columns, sql)


# --- sources and sinks -------------------------------------------------------------------------

oracle(
    "extract_since",
    "ordernumber orderdate:d status customernumber update_timestamp:t",
    "select * from fx_orders where update_timestamp >= timestamp '1998-07-16'",
    ["fx_orders"],
)
oracle("landing_csv_roundtrip", "doc_id text lang source n_chars", "select * from documents")
oracle(
    "landing_rerun_keeps_first",
    "ordernumber orderdate:d shippeddate:d status customernumber update_timestamp:t",
    "select * from fx_orders_b1",
    ["fx_orders_b1"],
)
oracle(
    "stage_load_csv",
    "productcode productname productscale quantityinstock buyprice:m msrp:m create_timestamp:t",
    "select *, cast(null as varchar) as productscale from fx_products",
    ["fx_products"],
)
oracle("stage_replace", "customernumber checknumber paymentdate:d amount:m", "select * from fx_payments_b2", ["fx_payments_b2"])
oracle(
    "failed_load_keeps_old",
    "src_customernumber customername creditlimit:m",
    "select customernumber as src_customernumber, customername, creditlimit from fx_customers",
    ["fx_customers"],
)
oracle(
    "incremental_append",
    "customernumber checknumber paymentdate:d amount:m",
    "select * from fx_payments_b1 union all select * from fx_payments_b2",
    ["fx_payments_b1", "fx_payments_b2"],
)
_CUSTOMER = "customernumber customername country salesrepemployeenumber creditlimit:m create_timestamp:t update_timestamp:t"
_CUSTOMERS_12 = ["fx_customers_b1", "fx_customers_b2"]
oracle(
    "incremental_replace_by_key",
    _CUSTOMER,
    """select * from fx_customers_b2 union all
       select * from fx_customers_b1 where customernumber not in (select customernumber from fx_customers_b2)""",
    _CUSTOMERS_12,
)

# --- control row and batch log -----------------------------------------------------------------

_CONTROL = (
    "control",
    f"""select cast(date_diff('day', date '{_B1}', max(orderdate)) + 2 as int) as etl_batch_no,
               cast(max(orderdate) + 1 as date) as etl_batch_date from fx_orders""",
)
_LOG = (
    "log",
    f"""select cast(date_diff('day', date '{_B1}', orderdate) + 1 as int) as etl_batch_no, orderdate as etl_batch_date,
               'C' as etl_batch_status, orderdate + interval 23 hour as etl_batch_start_time,
               orderdate + interval 23 hour + to_seconds(count(*)) as etl_batch_end_time
        from fx_orders group by orderdate""",
)
_LOG_COLUMNS = "etl_batch_no etl_batch_date:d etl_batch_status etl_batch_start_time:t etl_batch_end_time:t"
oracle(
    "batch_control_read",
    "status orders changed_orders etl_batch_no etl_batch_date:d",
    """select status, count(*) as orders, count(*) filter (where update_timestamp >= etl_batch_date) as changed_orders,
              etl_batch_no, etl_batch_date
       from fx_orders cross join control group by status, etl_batch_no, etl_batch_date""",
    ["fx_orders"],
    [_CONTROL],
)
oracle(
    "batch_log_open",
    _LOG_COLUMNS,
    """select * from log union all
       select etl_batch_no, etl_batch_date, 'O', etl_batch_date + interval 23 hour, null from control""",
    ["fx_orders"],
    [_CONTROL, _LOG],
)
oracle(
    "batch_log_close",
    _LOG_COLUMNS,
    """select * from log union all
       select etl_batch_no, etl_batch_date, 'C', etl_batch_date + interval 23 hour,
              etl_batch_date + interval 23 hour + interval 30 minute from control""",
    ["fx_orders"],
    [_CONTROL, _LOG],
)
oracle(
    "batch_stamp_crossjoin",
    "ordernumber status etl_batch_no etl_batch_date:d",
    "select * from fx_orders cross join control",
    ["fx_orders"],
    [_CONTROL],
)

# --- predicates, lookups, joins ----------------------------------------------------------------

oracle(
    "reject_null_keys",
    "customernumber salesrepemployeenumber creditlimit:m",
    "select * from fx_customers where salesrepemployeenumber is not null",
    ["fx_customers"],
)
oracle(
    "fk_lookup_inner",
    "ordernumber customernumber dw_customer_id",
    """select ordernumber, o.customernumber, dw_customer_id from fx_orders o
       join (select customernumber, row_number() over (order by customernumber) as dw_customer_id from fx_customers) c
         on o.customernumber = c.customernumber""",
    ["fx_orders", "fx_customers"],
)
oracle(
    "fk_lookup_left",
    "customernumber salesrepemployeenumber dw_sales_employee_id",
    """select customernumber, salesrepemployeenumber, n as dw_sales_employee_id from fx_customers
       left join (select employeenumber, row_number() over (order by employeenumber) as n from fx_employees) e
         on salesrepemployeenumber = employeenumber""",
    ["fx_customers", "fx_employees"],
)
oracle(
    "insert_new_anti",
    "ordernumber orderdate:d status",
    "select * from fx_orders o where not exists (select 1 from fx_orders_b1 b where b.ordernumber = o.ordernumber)",
    ["fx_orders", "fx_orders_b1"],
)
oracle(
    "employee_manager_link",
    "employeenumber lastname reportsto dw_employee_id dw_reporting_employee_id",
    """select e.*, m.dw_employee_id as dw_reporting_employee_id
       from keyed e left join keyed m on e.reportsto = m.employeenumber""",
    ["fx_employees"],
    [
        (
            "keyed",
            """select employeenumber, lastname, reportsto, row_number() over (order by employeenumber) as dw_employee_id
               from fx_employees""",
        )
    ],
)
oracle(
    "star_join_order_value",
    "ordernumber orderdate:d customernumber order_amount:m order_cost_amount:m order_mrp_amount:m",
    """select ordernumber, orderdate, customernumber, sum(priceeach * quantityordered) as order_amount,
              sum(buyprice * quantityordered) as order_cost_amount, sum(msrp * quantityordered) as order_mrp_amount
       from fx_orders join fx_orderdetails using (ordernumber) join fx_products using (productcode) group by all""",
    ["fx_orders", "fx_orderdetails", "fx_products"],
)
oracle(
    "distinct_orders_products_per_day",
    "orderdate:d orders products",
    """select orderdate, count(distinct ordernumber) as orders, count(distinct productcode) as products
       from fx_orders join fx_orderdetails using (ordernumber) group by orderdate""",
    ["fx_orders", "fx_orderdetails"],
)
oracle(
    "distinct_orders_products_per_month",
    "month:d orders products",
    """select cast(date_trunc('month', orderdate) as date) as month, count(distinct ordernumber) as orders,
              count(distinct productcode) as products
       from (select ordernumber, orderdate, productcode from fx_orders_b1 join fx_orderdetails_b1 using (ordernumber)
             union all select ordernumber, orderdate, productcode from fx_orders_b2 join fx_orderdetails_b2 using (ordernumber)) sold
       group by all""",
    ["fx_orders_b1", "fx_orderdetails_b1", "fx_orders_b2", "fx_orderdetails_b2"],
)
oracle(
    "first_payment_rank",
    "customernumber checknumber paymentdate:d amount:m rank1",
    "select *, rank() over (partition by customernumber order by paymentdate) as rank1 from fx_payments",
    ["fx_payments"],
)
oracle(
    "scalar_functions_probe",
    """ordernumber update_day:d month_floor:d day_text day_parsed:d day_before:d batch_day_before:d last_event:d delay
       latest_day:d done_flag or_flag weight_amount:m""",
    f"""select ordernumber, cast(update_timestamp as date) as update_day,
               cast(date_trunc('month', orderdate) as date) as month_floor, strftime(orderdate, '%Y-%m-%d') as day_text,
               orderdate as day_parsed, orderdate - interval 1 day as day_before,
               date '{_B2}' - interval 1 day as batch_day_before,
               coalesce(shippeddate, cancelleddate, requireddate) as last_event,
               case when shippeddate > orderdate then 'late' else 'same day' end as delay,
               greatest(shippeddate, cancelleddate, orderdate) as latest_day,
               least(cast(status = 'Shipped' as int) + cast(status = 'Cancelled' as int), 1) as done_flag,
               cast(status = 'Shipped' as int) | cast(status = 'Cancelled' as int) as or_flag,
               cast(ordernumber as decimal(12,2)) * 3 + 1 as weight_amount
        from fx_orders""",
    ["fx_orders"],
)
oracle(
    "surrogate_key_assign",
    "dw_product_id productcode productline",
    """select * from first union all
       select row_number() over (order by productcode) + (select max(dw_product_id) from first), productcode, productline
       from fx_products_s2 where productcode not in (select productcode from first)""",
    ["fx_products_s1", "fx_products_s2"],
    [
        (
            "first",
            "select row_number() over (order by productcode) as dw_product_id, productcode, productline from fx_products_s1",
        )
    ],
)

# --- keyed writes ------------------------------------------------------------------------------

_UPDATED_CUSTOMERS = """
    select o.customernumber, o.customername, o.country,
           case when n.customernumber is null then o.salesrepemployeenumber else n.salesrepemployeenumber end as salesrepemployeenumber,
           case when n.customernumber is null then o.creditlimit else n.creditlimit end as creditlimit,
           o.create_timestamp, coalesce(n.update_timestamp, o.update_timestamp) as update_timestamp
    from fx_customers_b1 o left join fx_customers_b2 n on o.customernumber = n.customernumber"""
_NEW_CUSTOMERS = """
    select * from fx_customers_b2 n
    where not exists (select 1 from fx_customers_b1 o where o.customernumber = n.customernumber)"""
oracle("merge_update", _CUSTOMER, _UPDATED_CUSTOMERS, _CUSTOMERS_12)
oracle("merge_insert", _CUSTOMER, f"select * from fx_customers_b1 union all {_NEW_CUSTOMERS}", _CUSTOMERS_12)
oracle("merge_upsert", _CUSTOMER, f"{_UPDATED_CUSTOMERS} union all {_NEW_CUSTOMERS}", _CUSTOMERS_12)
oracle(
    "orders_upsert_if_newer",
    """ordernumber orderdate:d requireddate:d shippeddate:d cancelleddate:d status customernumber
       create_timestamp:t update_timestamp:t""",
    """select case when b.ordernumber is null or o.update_timestamp > b.update_timestamp then o else b end as r,
              unnest(r) from fx_orders o left join fx_orders_b1 b on o.ordernumber = b.ordernumber""",
    ["fx_orders", "fx_orders_b1"],
)

# --- entity loads ------------------------------------------------------------------------------


def _once(table: str, key: str, id_col: str, source: str) -> tuple[str, str]:
    """Ids of a table loaded in one batch that sees everything."""
    return f"{table}_k", f"select row_number() over (order by {key}) as {id_col}, * from {source}"


def _states(
    name: str,
    id_col: str,
    keys: Sequence[str],
    stages: tuple[str, str],
    updates: Sequence[str],
    fixed: Sequence[str] = (),
    update_if: str = "true",
    insert_if: str = "true",
    insert_only: bool = False,
) -> list[tuple[str, str]]:
    """CTEs ``<name>_1`` and ``<name>_2``: the table after each batch.

    ``stages`` are resolved stage relations; ``updates`` columns change on known keys, ``fixed``
    columns are set on insert only.
    """
    order = ", ".join(keys)
    stamps = "create_timestamp as src_create_timestamp, update_timestamp as src_update_timestamp"

    def inserted(stage: str, no: int, day: str, run: str, base: str, where: str) -> str:
        return f"""select {base} row_number() over (order by {order}) as {id_col}, {', '.join([*keys, *fixed, *updates])},
                          {stamps}, timestamp '{run}' as dw_create_timestamp, cast(null as timestamp) as dw_update_timestamp,
                          {no} as etl_batch_no, date '{day}' as etl_batch_date
                   from {stage} where {insert_if} and {where}"""

    on = " and ".join(f"t.{k} = s.{k}" for k in keys)
    hit = f"s.{keys[0]} is not null"
    changed = [f"case when {hit} then s.{c} else t.{c} end as {c}" for c in updates]
    kept = f"""select t.{id_col}, {', '.join([f't.{c}' for c in [*keys, *fixed]] + changed)}, t.src_create_timestamp,
                      case when {hit} then s.update_timestamp else t.src_update_timestamp end as src_update_timestamp,
                      t.dw_create_timestamp,
                      case when {hit} then timestamp '{_RUN2}' else t.dw_update_timestamp end as dw_update_timestamp,
                      case when {hit} then 2 else t.etl_batch_no end as etl_batch_no,
                      case when {hit} then date '{_B2}' else t.etl_batch_date end as etl_batch_date
               from {name}_1 t left join (select * from {stages[1]} where {update_if}) s on {on}"""
    if insert_only:
        kept = f"select * from {name}_1"
    unknown = f"({order}) not in (select ({order}) from {name}_1)" if len(keys) > 1 else f"{order} not in (select {order} from {name}_1)"
    second = inserted(stages[1], 2, _B2, _RUN2, f"(select max({id_col}) from {name}_1) +", unknown)
    return [
        (f"{name}_1", inserted(stages[0], 1, _B1, _RUN1, "", "true")),
        (f"{name}_2", f"{kept} union all {second}"),
    ]


_AUDIT = (
    "src_create_timestamp:t src_update_timestamp:t dw_create_timestamp:t dw_update_timestamp:t etl_batch_no etl_batch_date:d"
)

_OFFICE_UPDATES = "city phone addressline1 addressline2 state country postalcode territory".split()
_EMPLOYEE_UPDATES = "lastname firstname extension email officecode reportsto jobtitle dw_office_id".split()
_CUSTOMER_COLUMNS = "contactlastname contactfirstname phone addressline1 addressline2 city state postalcode".split()

oracle(
    "dw_offices",
    f"dw_office_id officecode {' '.join(_OFFICE_UPDATES)} {_AUDIT}",
    "select * from offices_2",
    ["fx_offices_s1", "fx_offices_s2"],
    _states("offices", "dw_office_id", ["officecode"], ("fx_offices_s1", "fx_offices_s2"), _OFFICE_UPDATES),
)
oracle(
    "dw_offices_model",
    f"dw_office_id officecode city country territory {_AUDIT}",
    "select * from offices_2",
    ["fx_offices_s1", "fx_offices_s2"],
    _states("offices", "dw_office_id", ["officecode"], ("fx_offices_s1", "fx_offices_s2"), ["city", "country", "territory"]),
)

_OFFICES_K = _once("offices", "officecode", "dw_office_id", "fx_offices")


def _resolved(name: str, stage: str, joins: str, ids: str) -> tuple[str, str]:
    return name, f"select s.*, {ids} from {stage} s {joins}"


_TO_OFFICE = "left join offices_k o on s.officecode = o.officecode"
oracle(
    "dw_employees",
    f"dw_employee_id employeenumber {' '.join(_EMPLOYEE_UPDATES)} dw_reporting_employee_id {_AUDIT}",
    """select e.*, m.dw_employee_id as dw_reporting_employee_id
       from employees_2 e left join employees_2 m on e.reportsto = m.employeenumber""",
    ["fx_offices", "fx_employees_s1", "fx_employees_s2"],
    [
        _OFFICES_K,
        _resolved("e1", "fx_employees_s1", _TO_OFFICE, "dw_office_id"),
        _resolved("e2", "fx_employees_s2", _TO_OFFICE, "dw_office_id"),
        *_states(
            "employees", "dw_employee_id", ["employeenumber"], ("e1", "e2"),
            _EMPLOYEE_UPDATES,
            update_if="dw_office_id is not null", insert_if="dw_office_id is not null",
        ),
    ],
)

_EMPLOYEES_K = _once("employees", "employeenumber", "dw_employee_id", "fx_employees")
_TO_REP = "left join employees_k e on s.salesrepemployeenumber = e.employeenumber"
_CUSTOMER_STATES = [
    _EMPLOYEES_K,
    _resolved("c1", "fx_customers_b1", _TO_REP, "dw_employee_id as dw_sales_employee_id"),
    _resolved("c2", "fx_customers_b2", _TO_REP, "dw_employee_id as dw_sales_employee_id"),
    *_states(
        "customers", "dw_customer_id", ["customernumber"], ("c1", "c2"),
        ["country", "salesrepemployeenumber", "creditlimit", "dw_sales_employee_id"], ["customername"],
    ),
]
oracle(
    "dw_customers",
    f"""dw_customer_id src_customernumber customername {' '.join(_CUSTOMER_COLUMNS)} country salesrepemployeenumber
        creditlimit:m dw_sales_employee_id {_AUDIT}""",
    "select *, customernumber as src_customernumber from customers_2",
    ["fx_employees", "fx_customers_w1", "fx_customers_w2"],
    [
        _EMPLOYEES_K,
        _resolved("c1", "fx_customers_w1", _TO_REP, "dw_employee_id as dw_sales_employee_id"),
        _resolved("c2", "fx_customers_w2", _TO_REP, "dw_employee_id as dw_sales_employee_id"),
        *_states(
            "customers", "dw_customer_id", ["customernumber"], ("c1", "c2"),
            [*_CUSTOMER_COLUMNS, "country", "salesrepemployeenumber", "creditlimit", "dw_sales_employee_id"], ["customername"],
        ),
    ],
)

_CUSTOMERS_K = _once("customers", "customernumber", "dw_customer_id", "fx_customers")
_TO_CUSTOMER = "left join customers_k c on s.customernumber = c.customernumber"


def _order_states(customers: Sequence[tuple[str, str]], to_customer: str, to_customer_2: str) -> list[tuple[str, str]]:
    return [
        *customers,
        _resolved("o1", "fx_orders_b1", to_customer, "dw_customer_id"),
        _resolved("o2", "fx_orders_b2", to_customer_2, "dw_customer_id"),
        *_states(
            "orders", "dw_order_id", ["ordernumber"], ("o1", "o2"),
            ["requireddate", "cancelleddate", "shippeddate", "status"], ["orderdate", "customernumber", "dw_customer_id"],
            insert_if="dw_customer_id is not null",
        ),
    ]


_ORDER_STATES = _order_states([_CUSTOMERS_K], _TO_CUSTOMER, _TO_CUSTOMER)
_ORDERS_12 = ["fx_orders_b1", "fx_orders_b2"]
oracle(
    "dw_orders",
    f"dw_order_id src_ordernumber orderdate:d shippeddate:d cancelleddate:d status comments dw_customer_id {_AUDIT}",
    "select *, ordernumber as src_ordernumber, cast(null as varchar) as comments from orders_2",
    ["fx_customers", *_ORDERS_12],
    _ORDER_STATES,
)
oracle(
    "dw_orders_model",
    "dw_order_id src_ordernumber orderdate:d shippeddate:d status comments dw_customer_id etl_batch_no",
    """select o.dw_order_id, o.ordernumber as src_ordernumber, o.orderdate, '' as comments, o.dw_customer_id,
              case when newer then o.shippeddate else p.shippeddate end as shippeddate,
              case when newer then o.status else p.status end as status,
              case when newer then o.etl_batch_no else p.etl_batch_no end as etl_batch_no
       from (select a.*, b.src_update_timestamp is null or a.src_update_timestamp > b.src_update_timestamp as newer
             from orders_2 a left join orders_1 b using (ordernumber)) o
       left join orders_1 p using (ordernumber)""",
    ["fx_customers", *_ORDERS_12],
    _ORDER_STATES,
)


def _payment_states(customers: Sequence[tuple[str, str]], to_customer: str, to_customer_2: str) -> list[tuple[str, str]]:
    return [
        *customers,
        _resolved("p1", "fx_payments_b1", to_customer, "dw_customer_id"),
        _resolved("p2", "fx_payments_b2", to_customer_2, "dw_customer_id"),
        *_states(
            "payments", "dw_payment_id", ["checknumber"], ("p1", "p2"), [],
            ["customernumber", "paymentdate", "amount", "dw_customer_id"],
            insert_if="dw_customer_id is not null", insert_only=True,
        ),
    ]


_PAYMENT_STATES = _payment_states([_CUSTOMERS_K], _TO_CUSTOMER, _TO_CUSTOMER)
_PAYMENTS_12 = ["fx_payments_b1", "fx_payments_b2"]
oracle(
    "payments_load",
    f"dw_payment_id checknumber paymentdate:d amount:m dw_customer_id {_AUDIT}",
    "select * from payments_2",
    ["fx_customers", *_PAYMENTS_12],
    _PAYMENT_STATES,
)
oracle(
    "payments_append",
    "dw_customer_id src_customernumber checknumber paymentdate:d amount:m etl_batch_no",
    """select *, customernumber as src_customernumber, 1 as etl_batch_no from p1 where dw_customer_id is not null
       union all select *, customernumber, 2 from p2 where dw_customer_id is not null
       union all select *, customernumber, 2 from p2 where dw_customer_id is not null""",
    ["fx_customers", *_PAYMENTS_12],
    _PAYMENT_STATES[:3],
)
oracle(
    "dw_productlines",
    f"dw_product_line_id productline {_AUDIT}",
    "select * from productlines_2",
    ["fx_productlines_s1", "fx_productlines_s2"],
    _states("productlines", "dw_product_line_id", ["productline"], ("fx_productlines_s1", "fx_productlines_s2"), []),
)
oracle(
    "dw_productlines_model",
    f"dw_product_line_id productline {_AUDIT}",
    "select * from productlines_2",
    ["fx_productlines_s1", "fx_productlines_s2"],
    _states("productlines", "dw_product_line_id", ["productline"], ("fx_productlines_s1", "fx_productlines_s2"), []),
)

_LINES_K = _once("productlines", "productline", "dw_product_line_id", "fx_productlines")
_TO_LINE = "left join productlines_k l on s.productline = l.productline"
_PRODUCT_UPDATES = ["productname", "productline", "quantityinstock", "buyprice", "msrp", "dw_product_line_id"]


def _product_states(first: str, second: str, more: Sequence[str] = ()) -> list[tuple[str, str]]:
    return [
        _LINES_K,
        _resolved("pr1", first, _TO_LINE, "dw_product_line_id"),
        _resolved("pr2", second, _TO_LINE, "dw_product_line_id"),
        *_states(
            "products", "dw_product_id", ["productcode"], ("pr1", "pr2"), [*_PRODUCT_UPDATES, *more],
            update_if="dw_product_line_id is not null", insert_if="dw_product_line_id is not null",
        ),
    ]


oracle(
    "dw_products",
    f"""dw_product_id src_productcode productname productline productscale productvendor productdescription quantityinstock
        buyprice:m msrp:m dw_product_line_id {_AUDIT}""",
    "select *, productcode as src_productcode, cast(null as varchar) as productdescription from products_2",
    ["fx_productlines", "fx_products_s1", "fx_products_s2"],
    _product_states("fx_products_s1", "fx_products_s2", ["productscale", "productvendor"]),
)


def _detail_states(dims: Sequence[tuple[str, str]], orders: tuple[str, str], products: tuple[str, str]) -> list[tuple[str, str]]:
    def joins(n: int) -> str:
        return f"""left join {orders[n]} o on s.ordernumber = o.ordernumber
                   left join {products[n]} p on s.productcode = p.productcode"""

    both = "dw_order_id is not null and dw_product_id is not null"
    return [
        *dims,
        _resolved("d1", "fx_orderdetails_b1", joins(0), "dw_order_id, dw_product_id"),
        _resolved("d2", "fx_orderdetails_b2", joins(1), "dw_order_id, dw_product_id"),
        *_states(
            "orderdetails", "dw_orderdetail_id", ["ordernumber", "productcode"], ("d1", "d2"),
            ["quantityordered", "priceeach", "orderlinenumber", "dw_order_id", "dw_product_id"],
            update_if=both, insert_if=both,
        ),
    ]


_DETAILS_12 = ["fx_orderdetails_b1", "fx_orderdetails_b2"]
oracle(
    "orderdetails_load",
    """dw_orderdetail_id src_ordernumber src_productcode quantityordered priceeach:m dw_order_id dw_product_id
       src_update_timestamp:t etl_batch_no""",
    "select *, ordernumber as src_ordernumber, productcode as src_productcode from orderdetails_2",
    ["fx_orders", "fx_products", *_DETAILS_12],
    _detail_states(
        [_once("orders", "ordernumber", "dw_order_id", "fx_orders"), _once("products", "productcode", "dw_product_id", "fx_products")],
        ("orders_k", "orders_k"),
        ("products_k", "products_k"),
    ),
)

# --- entity loads, model way -------------------------------------------------------------------

oracle(
    "dw_employees_model",
    "dw_employee_id employeenumber jobtitle dw_office_id dw_reporting_employee_id",
    """select e.*, coalesce(m.dw_employee_id, 0) as dw_reporting_employee_id
       from employees_2 e left join employees_2 m on e.reportsto = m.employeenumber""",
    ["fx_offices", "fx_employees_s1", "fx_employees_s2"],
    [
        _OFFICES_K,
        _resolved("e1", "fx_employees_s1", _TO_OFFICE, "dw_office_id"),
        _resolved("e2", "fx_employees_s2", _TO_OFFICE, "dw_office_id"),
        *_states(
            "employees", "dw_employee_id", ["employeenumber"], ("e1", "e2"), ["reportsto", "jobtitle", "dw_office_id"],
            update_if="dw_office_id is not null", insert_if="dw_office_id is not null",
        ),
    ],
)
oracle(
    "dw_customers_model",
    "dw_customer_id src_customernumber customername creditlimit:m dw_sales_employee_id etl_batch_no",
    "select *, customernumber as src_customernumber from customers_2",
    ["fx_employees", *_CUSTOMERS_12],
    [
        *_CUSTOMER_STATES[:3],
        *_states(
            "customers", "dw_customer_id", ["customernumber"], ("c1", "c2"),
            ["customername", "creditlimit", "dw_sales_employee_id"],
        ),
    ],
)
oracle(
    "payments_load_model",
    "dw_payment_id checknumber paymentdate:d amount:m dw_customer_id etl_batch_no",
    "select * from payments_2",
    ["fx_customers_b1", *_PAYMENTS_12],
    [
        _once("customers", "customernumber", "dw_customer_id", "fx_customers_b1"),
        *_PAYMENT_STATES[1:3],
        *_states(
            "payments", "dw_payment_id", ["checknumber"], ("p1", "p2"), [], ["paymentdate", "amount", "dw_customer_id"],
            insert_only=True,
        ),
    ],
)
oracle(
    "dw_products_model",
    "dw_product_id src_productcode productdescription msrp:m dw_product_line_id etl_batch_no",
    """select p.*, p.productcode as src_productcode, '' as productdescription from products_2 p""",
    ["fx_productlines_s1", "fx_products_s1", "fx_products_s2"],
    [
        _once("productlines", "productline", "dw_product_line_id", "fx_productlines_s1"),
        _resolved("pr1", "fx_products_s1", _TO_LINE, "dw_product_line_id"),
        _resolved("pr2", "fx_products_s2", _TO_LINE, "dw_product_line_id"),
        *_states("products", "dw_product_id", ["productcode"], ("pr1", "pr2"), ["msrp", "dw_product_line_id"]),
    ],
)
oracle(
    "orderdetails_load_model",
    "dw_orderdetail_id src_ordernumber src_productcode quantityordered dw_order_id dw_product_id etl_batch_no",
    "select *, ordernumber as src_ordernumber, productcode as src_productcode from orderdetails_2",
    ["fx_orders", "fx_products_s1", *_DETAILS_12],
    [
        _once("orders", "ordernumber", "dw_order_id", "fx_orders"),
        _once("products", "productcode", "dw_product_id", "fx_products_s1"),
        *[
            _resolved(
                f"d{n}", f"fx_orderdetails_b{n}",
                "left join orders_k o on s.ordernumber = o.ordernumber left join products_k p on s.productcode = p.productcode",
                "dw_order_id, dw_product_id",
            )
            for n in (1, 2)
        ],
        *_states(
            "orderdetails", "dw_orderdetail_id", ["ordernumber", "productcode"], ("d1", "d2"), [],
            ["quantityordered", "dw_order_id", "dw_product_id"], insert_only=True,
        ),
    ],
)

# --- type-2 history ----------------------------------------------------------------------------


def _entity_now(b1: str, b2: str, key: str) -> str:
    return f"select * from {b2} union all select * from {b1} where {key} not in (select {key} from {b2})"


_LIMITS = [
    ("was", "select *, customernumber as dw_customer_id, creditlimit as tracked from fx_customers_b1"),
    ("now", f"select *, customernumber as dw_customer_id, creditlimit as tracked from ({_entity_now(*_CUSTOMERS_12, 'customernumber')})"),
]


def _history(key: str, tracked: str, differs: str, opens: bool = True) -> str:
    """History after batch 2: untouched, closed, reopened and first versions."""
    sql = f"""
        select was.{key}, was.tracked as {tracked}, date '{_B1}' as effective_from_date,
               case when {differs} then date '{_B2}' - 1 end as effective_to_date,
               case when {differs} then 0 else 1 end as dw_active_record_ind, 1 as create_etl_batch_no,
               case when {differs} then 2 end as update_etl_batch_no,
               case when {differs} then date '{_B2}' end as update_etl_batch_date,
               timestamp '{_RUN1}' as dw_create_timestamp,
               case when {differs} then timestamp '{_RUN2}' end as dw_update_timestamp
        from was left join now using ({key})"""
    if opens:
        sql += f"""
        union all
        select now.{key}, now.tracked, date '{_B2}', null, 1, 2, null, null, timestamp '{_RUN2}', null
        from now left join was using ({key}) where was.{key} is null or ({differs})"""
    return sql


_HISTORY_COLUMNS = """effective_from_date:d effective_to_date:d dw_active_record_ind create_etl_batch_no
    update_etl_batch_no update_etl_batch_date:d dw_create_timestamp:t dw_update_timestamp:t"""
_UNSAFE = "coalesce(now.tracked <> was.tracked, false)"
oracle(
    "scd2_change_detect",
    "dw_customer_id old_value:m new_value:m null_safe",
    """select dw_customer_id, was.tracked as old_value, now.tracked as new_value, 0 as null_safe
       from was join now using (dw_customer_id) where was.tracked <> now.tracked
       union all
       select dw_customer_id, was.tracked, now.tracked, 1
       from was join now using (dw_customer_id) where was.tracked is distinct from now.tracked""",
    _CUSTOMERS_12,
    _LIMITS,
)
oracle(
    "changed_in_batch",
    "dw_customer_id creditlimit:m src_update_timestamp:t",
    """select customernumber as dw_customer_id, creditlimit, update_timestamp as src_update_timestamp
       from fx_customers_b2 where create_timestamp <> update_timestamp""",
    _CUSTOMERS_12,
)
oracle(
    "scd2_close",
    f"dw_customer_id creditlimit:m {_HISTORY_COLUMNS}",
    _history("dw_customer_id", "creditlimit", _UNSAFE, opens=False),
    _CUSTOMERS_12,
    _LIMITS,
)
oracle(
    "customer_history_scd2",
    f"dw_customer_id creditlimit:m {_HISTORY_COLUMNS}",
    _history("dw_customer_id", "creditlimit", _UNSAFE),
    _CUSTOMERS_12,
    _LIMITS,
)
oracle(
    "customer_history_null_safe",
    f"dw_customer_id creditlimit:m {_HISTORY_COLUMNS}",
    _history("dw_customer_id", "creditlimit", "now.dw_customer_id is not null and now.tracked is distinct from was.tracked"),
    _CUSTOMERS_12,
    _LIMITS,
)
_PRICES = [
    ("was", "select productcode, row_number() over (order by productcode) as dw_product_id, msrp as tracked from fx_products"),
    (
        "now",
        """select was.dw_product_id, coalesce(b.msrp, was.tracked) as tracked
           from was left join fx_products_b2 b on was.productcode = b.productcode""",
    ),
]
oracle(
    "product_history_scd2",
    f"dw_product_id msrp:m {_HISTORY_COLUMNS}",
    _history("dw_product_id", "msrp", _UNSAFE),
    ["fx_products", "fx_products_b2"],
    _PRICES,
)

oracle(
    "customer_history_model",
    f"dw_customer_id creditlimit:m {_HISTORY_COLUMNS}",
    _history("dw_customer_id", "creditlimit", _UNSAFE),
    _CUSTOMERS_12,
    _LIMITS,
)
oracle(
    "product_history_model",
    f"dw_product_id msrp:m {_HISTORY_COLUMNS}",
    _history("dw_product_id", "msrp", _UNSAFE, opens=False)
    + f"""
        union all
        select dw_product_id, now.tracked, date '{_B2}' + 1, null, 1, 3, null, null, timestamp '{_RUN2}' + interval 1 day, null
        from now join was using (dw_product_id) where {_UNSAFE}""",
    ["fx_products", "fx_products_b2"],
    _PRICES,
)

# --- summaries ---------------------------------------------------------------------------------

_CUSTOMER_DAY = """summary_date dw_customer_id order_count order_apd order_amount order_cost_amount order_mrp_amount
    products_ordered_qty products_items_qty cancelled_order_count cancelled_order_amount cancelled_order_apd
    shipped_order_count shipped_order_amount shipped_order_apd payment_apd payment_amount new_customer_apd
    new_customer_paid_apd""".split()
_PRODUCT_DAY = """summary_date dw_product_id customer_apd product_cost_amount product_mrp_amount cancelled_product_qty
    cancelled_cost_amount cancelled_mrp_amount cancelled_order_apd""".split()
_PRODUCT_DAY_MODEL = [*_PRODUCT_DAY, "product_amount", "cancelled_amount"]


def _kinds(names: Sequence[str]) -> str:
    def kind(n: str) -> str:
        return ":m" if n.endswith("_amount") else ":d" if n.endswith("_date") else ""

    return " ".join(n + kind(n) for n in names)


def _facts(o: str, d: str, p: str, pay: str, c: str) -> dict[str, str]:
    return {"o": o, "d": d, "p": p, "pay": pay, "c": c}


_ALL_FACTS = _facts("fx_orders", "fx_orderdetails", "fx_products", "fx_payments", "fx_customers")
_FACTS_1 = _facts("fx_orders_b1", "fx_orderdetails_b1", "fx_products", "fx_payments_b1", "fx_customers_b1")
_FACTS_2 = _facts("fx_orders", "fx_orderdetails", "products_now", "fx_payments", "fx_customers")
_PRODUCTS_NOW = (
    "products_now",
    """select productcode, coalesce(b.msrp, a.msrp) as msrp, a.buyprice
       from fx_products a left join (select productcode, msrp from fx_products_b2) b using (productcode)""",
)
_FACT_VIEWS = [
    "fx_orders", "fx_orderdetails", "fx_products", "fx_payments", "fx_customers",
    "fx_orders_b1", "fx_orderdetails_b1", "fx_payments_b1", "fx_customers_b1", "fx_products_b2",
]


def _folded(branches: Sequence[str], keys: Sequence[str], measures: Sequence[str], how: str) -> str:
    union = " union all by name ".join(f"({b})" for b in branches)
    merged = ", ".join(f"{how}(coalesce({m}, 0)) as {m}" for m in measures)
    return f"select {', '.join(keys)}, {merged} from ({union}) group by all"


# The model way's facts with some ids missing: lines loaded before their order, payments without a customer.
_LOOSE = [
    ("details_of_orders", "select * from fx_orderdetails where quantityordered <> 13"),
    ("loose_payments", "select * replace (case when amount <= 300000 then customernumber end as customernumber) from fx_payments"),
]


def _customer_days(f: dict[str, str], since: str, model: bool = False) -> str:
    cancelled = "status = 'Cancelled' and" if model else ""
    o, d = f["o"], f["d"]
    ranked = f"(select *, rank() over (partition by customernumber order by paymentdate) as rank1 from {f['pay']})"
    branches = [
        f"""select orderdate as summary_date, customernumber as dw_customer_id, count(distinct ordernumber) as order_count,
                   1 as order_apd, sum(priceeach * quantityordered) as order_amount,
                   sum(buyprice * quantityordered) as order_cost_amount, sum(msrp * quantityordered) as order_mrp_amount,
                   count(distinct productcode) as products_ordered_qty,
                   {'count' if model else 'sum'}(quantityordered) as products_items_qty
            from {o} join {d} using (ordernumber) join {f['p']} using (productcode)
            where orderdate >= date '{since}' group by orderdate, customernumber""",
        f"""select cancelleddate as summary_date, customernumber as dw_customer_id,
                   count(distinct ordernumber) as cancelled_order_count,
                   sum(priceeach * quantityordered) as cancelled_order_amount, 1 as cancelled_order_apd
            from {o} join {d} using (ordernumber)
            where {cancelled} cancelleddate >= date '{since}' group by cancelleddate, customernumber""",
        f"""select shippeddate as summary_date, customernumber as dw_customer_id,
                   count(distinct ordernumber) as shipped_order_count,
                   sum(priceeach * quantityordered) as shipped_order_amount, 1 as shipped_order_apd
            from {o} join {d} using (ordernumber)
            where status = 'Shipped' and shippeddate >= date '{since}' group by shippeddate, customernumber""",
        f"""select paymentdate as summary_date, customernumber as dw_customer_id, 1 as payment_apd,
                   sum(amount) as payment_amount, max({'cast(rank1 = 1 as int)' if model else '0'}) as new_customer_paid_apd
            from {ranked} t where paymentdate >= date '{since}' group by paymentdate, customernumber""",
        f"""select cast(create_timestamp as date) as summary_date, customernumber as dw_customer_id, 1 as new_customer_apd
            from {f['c']} where create_timestamp >= date '{since}'""",
    ]
    return _folded(branches, _CUSTOMER_DAY[:2], _CUSTOMER_DAY[2:], "max")


def _product_days(f: dict[str, str], since: str, model: bool = False) -> str:
    star = f"{f['o']} join {f['d']} using (ordernumber) join {f['p']} using (productcode)"
    sales, cost, mrp = [f"sum(quantityordered * {c})" for c in ("priceeach", "buyprice", "msrp")]
    if model:
        ordered = f"1 as customer_apd, {cost} as product_cost_amount, {sales} as product_amount, {mrp} as product_mrp_amount"
        cancelled = f"0 as customer_apd, {cost} as cancelled_cost_amount, {sales} as cancelled_amount, {mrp} as cancelled_mrp_amount"
    else:
        ordered = f"1 as customer_apd, {sales} as product_cost_amount, {mrp} as product_mrp_amount"
        cancelled = f"1 as customer_apd, {sales} as cancelled_cost_amount, {mrp} as cancelled_mrp_amount"
    status = "status = 'Cancelled' and" if model else ""
    branches = [
        f"""select orderdate as summary_date, productcode as dw_product_id, {ordered}
            from {star} where orderdate >= date '{since}' group by orderdate, productcode""",
        f"""select cancelleddate as summary_date, productcode as dw_product_id, {cancelled},
                   count(distinct ordernumber) as cancelled_product_qty, 1 as cancelled_order_apd
            from {star} where {status} cancelleddate >= date '{since}' group by cancelleddate, productcode""",
    ]
    measures = (_PRODUCT_DAY_MODEL if model else _PRODUCT_DAY)[2:]
    return _folded(branches, _PRODUCT_DAY[:2], measures, "sum" if model else "max")


for _model in (False, True):
    _suffix = "_model" if _model else ""
    oracle(
        "daily_customer_summary" + _suffix,
        _kinds(_CUSTOMER_DAY),
        _customer_days(_ALL_FACTS | {"d": "details_of_orders", "pay": "loose_payments"} if _model else _ALL_FACTS, _B1, _model),
        list(_ALL_FACTS.values()),
        _LOOSE if _model else [],
    )
    oracle(
        "daily_product_summary" + _suffix,
        _kinds(_PRODUCT_DAY_MODEL if _model else _PRODUCT_DAY),
        _product_days(_ALL_FACTS, _B1, _model),
        ["fx_orders", "fx_orderdetails", "fx_products"],
    )

oracle(
    "branch_union_customer_days",
    "summary_date:d customernumber order_count order_apd payment_amount:m payment_apd",
    _folded(
        [
            """select orderdate as summary_date, customernumber, count(*) as order_count, 1 as order_apd
               from fx_orders group by all""",
            """select paymentdate as summary_date, customernumber, sum(amount) as payment_amount, 1 as payment_apd
               from fx_payments group by all""",
        ],
        ["summary_date", "customernumber"],
        ["order_count", "order_apd", "payment_amount", "payment_apd"],
        "max",
    ),
    ["fx_orders", "fx_payments"],
)


def _month_measures(day_columns: Sequence[str]) -> tuple[list[str], list[str]]:
    apds = [c for c in day_columns if c.endswith("_apd") and c != "new_customer_paid_apd"]
    adds = [c for c in day_columns[2:] if not c.endswith("_apd")]
    return adds, apds


def _rolled(source: str, key: str, day_columns: Sequence[str], apd: str) -> str:
    """Month rows of daily rows; ``apd`` is sum or max."""
    adds, apds = _month_measures(day_columns)
    parts = [f"sum({c}) as {c}" for c in adds] + [f"{apd}({c}) as {c}" for c in apds]
    parts += [f"cast(max({c}) > 0 as int) as {c.replace('_apd', '_apm')}" for c in apds]
    return f"select cast(date_trunc('month', summary_date) as date) as start_of_the_month_date, {key}, {', '.join(parts)} from {source} group by all"


def _added(key: str, day_columns: Sequence[str], model: bool) -> tuple[list[str], str]:
    """The columns of months ``m1`` with those of ``m2`` added, and the statement."""
    adds, apds = _month_measures(day_columns)
    replaced = ["order_count", "new_customer_apd", "new_customer_apm"] if model and key == "dw_customer_id" else []
    cols = ["start_of_the_month_date", key]
    picks = []
    for c in [*adds, *apds, *[a.replace("_apd", "_apm") for a in apds]]:
        cols.append(c)
        if c in replaced:
            both = f"b.{c}"
        elif c in adds or (c in apds and not model):
            both = f"a.{c} + b.{c}"
        else:
            both = f"greatest(a.{c}, b.{c})"
        picks.append(f"case when a.start_of_the_month_date is null then b.{c} when b.start_of_the_month_date is null then a.{c} else {both} end as {c}")
    if key == "dw_customer_id":
        cols += ["new_customer_paid_apd", "new_customer_paid_apm"]
        picks += ["0 as new_customer_paid_apd", "0 as new_customer_paid_apm"]
    cols.append("etl_batch_no")
    picks.append("case when b.start_of_the_month_date is null then 1 else 2 end as etl_batch_no")
    return cols, f"select start_of_the_month_date, {key}, {', '.join(picks)} from m1 a full join m2 b using (start_of_the_month_date, {key})"


def _monthly(name: str, key: str, day_columns: Sequence[str], days, model: bool) -> None:
    cols, sql = _added(key, day_columns, model)
    apd = "max" if model else "sum"
    oracle(
        name,
        _kinds(cols),
        sql,
        _FACT_VIEWS,
        [
            _PRODUCTS_NOW,
            ("day1", days(_FACTS_1, _B1, model)),
            ("day2", days(_FACTS_2, _B2, model)),
            ("m1", _rolled("day1", key, day_columns, apd)),
            ("m2", _rolled("day2", key, day_columns, apd)),
        ],
    )


for _model in (False, True):
    _suffix = "_model" if _model else ""
    _monthly("monthly_customer_summary" + _suffix, "dw_customer_id", _CUSTOMER_DAY, _customer_days, _model)
    _monthly("monthly_product_summary" + _suffix, "dw_product_id", _PRODUCT_DAY, _product_days, _model)

oracle(
    "accumulate_monthly",
    "start_of_the_month_date:d customernumber payments amount:m payment_apm",
    """select cast(date_trunc('month', paymentdate) as date) as start_of_the_month_date, customernumber,
              count(*) as payments, sum(amount) as amount, 1 as payment_apm
       from (select * from fx_payments_b1 union all select * from fx_payments_b2) group by all""",
    _PAYMENTS_12,
)

# --- whole batches -----------------------------------------------------------------------------

_CUSTOMER_IDS = ["left join customers_1 c on s.customernumber = c.customernumber", "left join customers_2 c on s.customernumber = c.customernumber"]


def _counted(table: str, relation: str, column: str) -> str:
    return f"select '{table}' as table_name, count(*) as row_count, cast(sum({column}) as decimal(18,2)) as column_sum from {relation}"


def _loaded(n: int) -> dict[str, str]:
    """The facts as loaded after batch ``n``: rows without a known customer were left out."""
    customers = f"(select customernumber, src_create_timestamp as create_timestamp from customers_{n})"
    return _facts(f"orders_{n}", f"orderdetails_{n}", f"products_{n}", f"payments_{n}", customers)


def _all_days(days, table: str) -> tuple[str, str]:
    """Daily rows after both batches: the two batches cover different days."""
    return table, f"{days(_loaded(1), _B1)} union all by name {days(_loaded(2), _B2)}"


oracle(
    "run_two_batches",
    "table_name row_count column_sum:m",
    " union all ".join(
        [
            _counted("offices", "offices_k", "dw_office_id"),
            _counted(
                "employees",
                "(select m.dw_employee_id as n from employees_k e left join employees_k m on e.reportsto = m.employeenumber)",
                "n",
            ),
            _counted("customers", "customers_2", "creditlimit"),
            _counted("payments", "payments_2", "amount"),
            _counted("orders", "orders_2", "dw_customer_id"),
            _counted("productlines", "productlines_k", "dw_product_line_id"),
            _counted("products", "products_2", "msrp"),
            _counted("orderdetails", "orderdetails_2", "dw_product_id"),
            _counted("customer_history", "customer_history", "creditlimit"),
            _counted("product_history", "product_history", "tracked"),
            _counted("daily_customer_summary", "customer_days", "order_amount"),
            _counted("daily_product_summary", "product_days", "product_mrp_amount"),
            _counted("monthly_customer_summary", f"({_rolled('customer_days', 'dw_customer_id', _CUSTOMER_DAY, 'sum')})", "order_amount"),
            _counted("monthly_product_summary", f"({_rolled('product_days', 'dw_product_id', _PRODUCT_DAY, 'sum')})", "product_mrp_amount"),
        ]
    ),
    [
        "fx_offices", "fx_employees", "fx_productlines", "fx_customers", *_CUSTOMERS_12, *_ORDERS_12, *_PAYMENTS_12, *_DETAILS_12,
        "fx_products", "fx_products_b2",
    ],
    [
        _OFFICES_K,
        *_CUSTOMER_STATES,
        *_order_states([], *_CUSTOMER_IDS),
        *_payment_states([], *_CUSTOMER_IDS),
        *_product_states("fx_products", "fx_products_b2"),
        *_detail_states([], ("orders_1", "orders_2"), ("products_1", "products_2")),
        ("was", "select dw_customer_id, creditlimit as tracked from customers_1"),
        ("now", "select dw_customer_id, creditlimit as tracked from customers_2"),
        ("customer_history", _history("dw_customer_id", "creditlimit", _UNSAFE)),
        (
            "product_history",
            """select msrp as tracked from products_1
               union all select b.msrp from products_2 b join products_1 a using (dw_product_id) where a.msrp <> b.msrp""",
        ),
        _all_days(_customer_days, "customer_days"),
        _all_days(_product_days, "product_days"),
    ],
)

# --- every row of every table after both batches -----------------------------------------------

_BATCH_VIEWS = [
    "fx_offices", "fx_employees", "fx_productlines", "fx_customers", *_CUSTOMERS_12, *_ORDERS_12, *_PAYMENTS_12, *_DETAILS_12,
    "fx_products", "fx_products_b2",
]
_COMMON = [
    _OFFICES_K,
    *_CUSTOMER_STATES,
    *_order_states([], *_CUSTOMER_IDS),
    *_product_states("fx_products", "fx_products_b2"),
]
_DETAIL_STATES = _detail_states([], ("orders_1", "orders_2"), ("products_1", "products_2"))
_FIRST_BATCH = f"""create_timestamp as src_create_timestamp, update_timestamp as src_update_timestamp, timestamp '{_RUN1}' as dw_create_timestamp,
    cast(null as timestamp) as dw_update_timestamp, 1 as etl_batch_no, date '{_B1}' as etl_batch_date"""


def _as_loaded(name: str, id_col: str, keys: Sequence[str], stages: tuple[str, str], columns: Sequence[str]) -> list[tuple[str, str]]:
    """The model way's facts: rows without a known parent are kept, known rows are left alone."""
    return _states(name, id_col, keys, stages, [], columns, insert_only=True)


_BATCH_STEPS = {
    "script": [*_COMMON, *_payment_states([], *_CUSTOMER_IDS), *_DETAIL_STATES],
    "model": [
        *_COMMON,
        *_payment_states([], *_CUSTOMER_IDS)[:2],
        *_as_loaded("payments", "dw_payment_id", ["checknumber"], ("p1", "p2"), ["customernumber", "paymentdate", "amount", "dw_customer_id"]),
        *_DETAIL_STATES[:2],
        *_as_loaded(
            "orderdetails", "dw_orderdetail_id", ["ordernumber", "productcode"], ("d1", "d2"),
            ["quantityordered", "priceeach", "orderlinenumber", "dw_order_id", "dw_product_id"],
        ),
    ],
}


def _facts_of(n: int, model: bool) -> dict[str, str]:
    """The facts as loaded after batch ``n``, under natural keys."""
    facts = _loaded(n)
    if model:
        # Only lines that were loaded with their order count for customers; all of them do for products.
        facts["pay"] = f"(select * replace (case when dw_customer_id is not null then customernumber end as customernumber) from payments_{n})"
    return facts


def _with_orders(facts: dict[str, str]) -> dict[str, str]:
    return facts | {"d": f"(select * from {facts['d']} where dw_order_id is not null)"}


def _day_steps(model: bool) -> list[tuple[str, str]]:
    f1, f2 = _facts_of(1, model), _facts_of(2, model)
    c1, c2 = (_with_orders(f1), _with_orders(f2)) if model else (f1, f2)
    return [
        ("customer_day1", _customer_days(c1, _B1, model)),
        ("customer_day2", _customer_days(c2, _B2, model)),
        ("product_day1", _product_days(f1, _B1, model)),
        ("product_day2", _product_days(f2, _B2, model)),
    ]


def _stamped_days(kind: str) -> str:
    return f"""select *, 1 as etl_batch_no, date '{_B1}' as etl_batch_date from {kind}_day1
               union all by name select *, 2 as etl_batch_no, date '{_B2}' as etl_batch_date from {kind}_day2"""


# The summaries above name customers and products by their natural keys; the warehouse by the ids they were given.
_WITH_IDS = {
    "customer": "select t.* replace (c.dw_customer_id as dw_customer_id) from ({sql}) t left join customers_2 c on t.dw_customer_id = c.customernumber",
    "product": "select t.* replace (p.dw_product_id as dw_product_id) from ({sql}) t left join products_2 p on t.dw_product_id = p.productcode",
}


def _month_rows(kind: str, model: bool) -> tuple[str, list[tuple[str, str]]]:
    """Month rows after both batches, and the steps they need."""
    key, day_columns = f"dw_{kind}_id", _CUSTOMER_DAY if kind == "customer" else _PRODUCT_DAY
    apd = "max" if model else "sum"
    steps = [("m1", _rolled(f"{kind}_day1", key, day_columns, apd)), ("m2", _rolled(f"{kind}_day2", key, day_columns, apd))]
    if model:  # the batch's months are added; both stamps are those of the last batch
        run = f"case when etl_batch_no = 2 then timestamp '{_RUN2}' else timestamp '{_RUN1}' end"
        day = f"case when etl_batch_no = 2 then date '{_B2}' else date '{_B1}' end"
        return f"select *, {run} as dw_create_timestamp, {run} as dw_update_timestamp, {day} as etl_batch_date from ({_added(key, day_columns, True)[1]})", steps
    # Months from the second batch's month on are worked out anew from all their days.
    paid = "0 as new_customer_paid_apd, 0 as new_customer_paid_apm," if kind == "customer" else ""
    all_days = f"(select * from {kind}_day1 union all by name select * from {kind}_day2)"
    first = "(select distinct start_of_the_month_date as m, " + key + " as k from m1)"
    late = f"start_of_the_month_date >= date '{_B2[:8]}01'"
    sql = f"""select t.*, {paid} case when {late} then 2 else 1 end as etl_batch_no,
                     case when {late} then date '{_B2}' else date '{_B1}' end as etl_batch_date,
                     case when f.m is null then timestamp '{_RUN2}' else timestamp '{_RUN1}' end as dw_create_timestamp,
                     case when {late} and f.m is not null then timestamp '{_RUN2}' end as dw_update_timestamp
              from ({_rolled(all_days, key, day_columns, 'sum')}) t left join {first} f on t.start_of_the_month_date = f.m and t.{key} = f.k"""
    return sql, steps


def _versions(entity: str, key: str, tracked: str, opens: bool) -> tuple[str, list[tuple[str, str]]]:
    steps = [(when, f"select {key}, {tracked} as tracked from {entity}_{n}") for when, n in (("was", 1), ("now", 2))]
    created = f"case create_etl_batch_no when 1 then date '{_B1}' else date '{_B2}' end as create_etl_batch_date"
    return f"select *, {created} from ({_history(key, tracked, _UNSAFE, opens)})", steps


def _batch_tables(model: bool) -> dict[str, tuple[str, str, list[tuple[str, str]]]]:
    """Table -> (shown columns, statement, further steps)."""
    manager = "coalesce(m.dw_employee_id, 0)" if model else "m.dw_employee_id"
    blank = "''" if model else "cast(null as varchar)"
    out = {
        "offices": (f"dw_office_id officecode {' '.join(_OFFICE_UPDATES)} {_AUDIT}", f"select *, {_FIRST_BATCH} from offices_k", []),
        "employees": (
            f"dw_employee_id employeenumber {' '.join(_EMPLOYEE_UPDATES)} dw_reporting_employee_id {_AUDIT}",
            f"""select e.*, o.dw_office_id, {manager} as dw_reporting_employee_id, {_FIRST_BATCH.replace('create_timestamp as', 'e.create_timestamp as', 1).replace('update_timestamp as', 'e.update_timestamp as', 1)}
                from employees_k e join offices_k o on e.officecode = o.officecode left join employees_k m on e.reportsto = m.employeenumber""",
            [],
        ),
        "customers": (
            f"dw_customer_id src_customernumber customername country salesrepemployeenumber creditlimit:m dw_sales_employee_id {_AUDIT}",
            "select *, customernumber as src_customernumber from customers_2",
            [],
        ),
        "productlines": (f"dw_product_line_id productline {_AUDIT}", f"select *, {_FIRST_BATCH} from productlines_k", []),
        "products": (
            f"dw_product_id src_productcode productname productline productdescription quantityinstock buyprice:m msrp:m dw_product_line_id {_AUDIT}",
            f"select *, productcode as src_productcode, {blank} as productdescription from products_2",
            [],
        ),
        "orders": (
            f"""dw_order_id src_ordernumber orderdate:d requireddate:d shippeddate:d cancelleddate:d status comments src_customernumber
                dw_customer_id {_AUDIT}""",
            f"select *, ordernumber as src_ordernumber, customernumber as src_customernumber, {blank} as comments from orders_2",
            [],
        ),
        "payments": (
            f"dw_payment_id src_customernumber checknumber paymentdate:d amount:m dw_customer_id {_AUDIT}",
            "select *, customernumber as src_customernumber from payments_2",
            [],
        ),
        "orderdetails": (
            f"""dw_orderdetail_id src_ordernumber src_productcode quantityordered priceeach:m orderlinenumber dw_order_id
                dw_product_id {_AUDIT}""",
            "select *, ordernumber as src_ordernumber, productcode as src_productcode from orderdetails_2",
            [],
        ),
        "customer_history": (f"dw_customer_id creditlimit:m create_etl_batch_date:d {_HISTORY_COLUMNS}", *_versions("customers", "dw_customer_id", "creditlimit", True)),
        "product_history": (f"dw_product_id msrp:m create_etl_batch_date:d {_HISTORY_COLUMNS}", *_versions("products", "dw_product_id", "msrp", not model)),
    }
    for kind, day_columns in (("customer", _CUSTOMER_DAY), ("product", _PRODUCT_DAY_MODEL if model else _PRODUCT_DAY)):
        shown = f"{_kinds(day_columns)} etl_batch_no etl_batch_date:d"
        out[f"daily_{kind}_summary"] = (shown, _WITH_IDS[kind].format(sql=_stamped_days(kind)), _day_steps(model))
        months, steps = _month_rows(kind, model)
        columns = _added(f"dw_{kind}_id", _CUSTOMER_DAY if kind == "customer" else _PRODUCT_DAY, model)[0]
        shown = f"{_kinds(columns)} dw_create_timestamp:t dw_update_timestamp:t etl_batch_date:d"
        out[f"monthly_{kind}_summary"] = (shown, _WITH_IDS[kind].format(sql=months), [*_day_steps(model), *steps])
    return out


for _way, _suffix in (("script", ""), ("model", "_model")):
    for _table, (_shown, _sql, _steps) in _batch_tables(_way == "model").items():
        oracle(f"batch_{_table}{_suffix}", _shown, _sql, _BATCH_VIEWS, [*_BATCH_STEPS[_way], *_steps])
