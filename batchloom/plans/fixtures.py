"""Order-management inputs derived from the given tables, as SQL that Spark and DuckDB both run.

Batch 1 sees everything before the cutoff, batch 2 what changed on or after it. The cutoff is in
the middle of a month, so batch 2 adds to months batch 1 already wrote. See FIXTURES.md.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchloom.functions import conform
from batchloom.operators.control import Batch
from batchloom.schemas import STAGE

BATCH_1 = Batch(1, dt.date(1995, 1, 1), dt.datetime(2001, 7, 15, 23))
BATCH_2 = Batch(2, dt.date(2001, 7, 16), dt.datetime(2001, 7, 16, 23))

RAW = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

_STAMPS = (
    "timestamp '1995-01-01 00:00:00' as create_timestamp, timestamp '1995-01-01 00:00:00' as update_timestamp"
)
_CUT = "2001-07-16"
#: Order numbers, at most about 32 MB in memory, that are sent to the lines.
_FEW = 1_000_000

VIEWS: dict[str, str] = {
    "fx_offices": f"""
        select cast(n_nationkey as string) as officecode, n_name as city, concat('+', cast(n_nationkey as string)) as phone,
               concat(n_name, ' Road') as addressline1, concat('Floor ', cast(n_nationkey as string)) as addressline2,
               concat('S', cast(n_nationkey as string)) as state, n_name as country,
               concat('Z', cast(n_nationkey as string)) as postalcode, r_name as territory,
               {_STAMPS}
        from nation join region on n_regionkey = r_regionkey""",
    "fx_employees": f"""
        select s_suppkey as employeenumber, s_name as lastname, concat('F', cast(s_suppkey as string)) as firstname,
               concat('x', cast(s_suppkey as string)) as extension,
               concat('e', cast(s_suppkey as string), '@example.org') as email, cast(s_nationkey as string) as officecode,
               case when s_suppkey > 0 then cast(floor(s_suppkey / 10.0) as bigint) end as reportsto,
               case when s_suppkey = 0 then 'President' else 'Sales Rep' end as jobtitle,
               {_STAMPS}
        from supplier""",
    "fx_customers": """
        select c_custkey as customernumber, c_name as customername, n_name as country,
               case when c_custkey % 11 = 9 then null when c_custkey % 11 = 10 then cast(-1 as bigint)
                    else cast(c_custkey % 11 as bigint) end as salesrepemployeenumber,
               case when c_custkey % 97 = 0 then null else cast(c_acctbal as decimal(10,2)) end as creditlimit,
               cast(date '1995-01-01' + cast((c_custkey * 7) % 2400 as int) as timestamp) as create_timestamp,
               cast(date '1995-01-01' + cast((c_custkey * 7) % 2400 as int) as timestamp) as update_timestamp
        from customer join nation on c_nationkey = n_nationkey""",
    "fx_productlines": f"""
        select productline, {_STAMPS} from (select distinct p_brand as productline from part) b""",
    "fx_products": f"""
        select concat('P', cast(p_partkey as string)) as productcode, p_name as productname, p_brand as productline,
               concat('1:', cast(cast(p_size as int) as string)) as productscale, concat('Vendor ', p_brand) as productvendor,
               cast(p_size as int) as quantityinstock, cast(p_retailprice as decimal(10,2)) as buyprice,
               cast(cast(p_retailprice as decimal(10,2)) + cast(10 as decimal(10,2)) as decimal(10,2)) as msrp,
               {_STAMPS}
        from part""",
    "fx_orders": """
        select ordernumber, orderdate, requireddate, shippeddate, cancelleddate, status, customernumber,
               cast(orderdate as timestamp) as create_timestamp,
               cast(coalesce(shippeddate, cancelleddate, orderdate) as timestamp) as update_timestamp
        from (select o_orderkey as ordernumber, cast(o_orderdate as date) as orderdate,
                     cast(cast(o_orderdate as date) + 10 as date) as requireddate,
                     case when o_orderstatus = 'F'
                          then cast(cast(o_orderdate as date) + cast(o_orderkey % 7 as int) as date) end as shippeddate,
                     case when o_orderstatus = 'P'
                          then cast(cast(o_orderdate as date) + cast(o_orderkey % 5 as int) as date) end as cancelleddate,
                     case o_orderstatus when 'F' then 'Shipped' when 'P' then 'Cancelled' else 'In Process' end as status,
                     o_custkey as customernumber
              from orders) o""",
    "fx_orderdetails": f"""
        select ordernumber, productcode, quantityordered, priceeach, orderlinenumber, {_STAMPS}
        from (select l_orderkey as ordernumber, concat('P', cast(l_partkey as string)) as productcode,
                     cast(sum(l_quantity) as int) as quantityordered,
                     cast(min(l_extendedprice) as decimal(10,2)) as priceeach,
                     cast(min(l_linenumber) as int) as orderlinenumber
              from lineitem group by l_orderkey, l_partkey) d""",
    "fx_payments": """
        select o_custkey as customernumber, concat('CHK', cast(o_orderkey as string)) as checknumber,
               cast(cast(o_orderdate as date) + cast(o_orderkey % 11 as int) as date) as paymentdate,
               cast(o_totalprice as decimal(12,2)) as amount,
               cast(cast(o_orderdate as date) + cast(o_orderkey % 11 as int) as timestamp) as create_timestamp,
               cast(cast(o_orderdate as date) + cast(o_orderkey % 11 as int) as timestamp) as update_timestamp
        from orders where o_orderstatus = 'F'""",
    "fx_customers_b1": f"""
        select * from fx_customers where create_timestamp < timestamp '{_CUT} 00:00:00'""",
    # Batch 2 raises missing and negative credit limits and brings the customers created since.
    "fx_customers_b2": f"""
        select customernumber, customername, country, salesrepemployeenumber,
               case when create_timestamp >= timestamp '{_CUT} 00:00:00' then creditlimit
                    else cast(coalesce(creditlimit, cast(0 as decimal(10,2))) + cast(1000 as decimal(10,2))
                              as decimal(10,2)) end as creditlimit,
               create_timestamp, timestamp '{_CUT} 00:00:00' as update_timestamp
        from fx_customers
        where create_timestamp >= timestamp '{_CUT} 00:00:00' or creditlimit is null or creditlimit < 0""",
    # Batch 2 raises the list price of products that run low.
    "fx_products_b2": f"""
        select productcode, productname, productline, quantityinstock, buyprice,
               cast(msrp + cast(5 as decimal(10,2)) as decimal(10,2)) as msrp,
               create_timestamp, timestamp '{_CUT} 00:00:00' as update_timestamp
        from fx_products where quantityinstock <= 5""",
    "fx_orders_b1": f"""
        select ordernumber, orderdate, requireddate,
               case when shippeddate < date '{_CUT}' then shippeddate end as shippeddate,
               case when cancelleddate < date '{_CUT}' then cancelleddate end as cancelleddate,
               case when coalesce(shippeddate, cancelleddate) >= date '{_CUT}' then 'In Process'
                    else status end as status,
               customernumber, create_timestamp,
               case when update_timestamp >= timestamp '{_CUT} 00:00:00' then create_timestamp
                    else update_timestamp end as update_timestamp
        from fx_orders where orderdate < date '{_CUT}'""",
    "fx_orders_b2": f"""
        select * from fx_orders where update_timestamp >= timestamp '{_CUT} 00:00:00'""",
    "fx_orderdetails_b1": """
        select d.* from fx_orderdetails d join fx_orders_b1 o on d.ordernumber = o.ordernumber""",
    "fx_orderdetails_b2": f"""
        select d.ordernumber, d.productcode, d.quantityordered, d.priceeach, d.orderlinenumber,
               d.create_timestamp, timestamp '{_CUT} 00:00:00' as update_timestamp
        from fx_orderdetails d join fx_orders_b2 o on d.ordernumber = o.ordernumber""",
    # Customers with every column of their table.
    "fx_customers_w1": """
        select customernumber, customername, concat('L', cast(customernumber as string)) as contactlastname,
               concat('F', cast(customernumber as string)) as contactfirstname, concat('+', cast(customernumber as string)) as phone,
               concat('A', cast(customernumber as string)) as addressline1, concat('B', cast(customernumber as string)) as addressline2,
               concat('C', cast(customernumber as string)) as city, concat('S', cast(customernumber as string)) as state,
               concat('Z', cast(customernumber as string)) as postalcode, country, salesrepemployeenumber, creditlimit,
               create_timestamp, update_timestamp
        from fx_customers_b1""",
    "fx_customers_w2": """
        select customernumber, customername, concat('l', cast(customernumber as string)) as contactlastname,
               concat('f', cast(customernumber as string)) as contactfirstname, concat('-', cast(customernumber as string)) as phone,
               concat('a', cast(customernumber as string)) as addressline1, concat('b', cast(customernumber as string)) as addressline2,
               concat('c', cast(customernumber as string)) as city, concat('s', cast(customernumber as string)) as state,
               concat('z', cast(customernumber as string)) as postalcode, concat(country, ' 2') as country,
               salesrepemployeenumber, creditlimit, create_timestamp, update_timestamp
        from fx_customers_b2""",
    # The splits below give the small keyed tables both changed and new rows in their second batch.
    "fx_offices_s1": "select * from fx_offices where territory <> 'ASIA'",
    "fx_offices_s2": f"""
        select officecode, concat(city, ' Centre') as city, concat(phone, '0') as phone,
               concat(addressline1, ' 2') as addressline1, concat(addressline2, 'b') as addressline2,
               concat(state, 'b') as state, concat(country, ' 2') as country, concat(postalcode, 'b') as postalcode,
               concat(territory, ' 2') as territory, create_timestamp,
               timestamp '{_CUT} 00:00:00' as update_timestamp
        from fx_offices where territory in ('ASIA', 'EUROPE')""",
    "fx_employees_s1": """
        select e.* from fx_employees e join fx_offices_s1 o on e.officecode = o.officecode""",
    "fx_employees_s2": f"""
        select e.employeenumber, concat(e.lastname, 'b') as lastname, concat(e.firstname, 'b') as firstname,
               concat(e.extension, '9') as extension, concat('b', e.email) as email, e.officecode, e.reportsto,
               'Sales Manager' as jobtitle,
               e.create_timestamp, timestamp '{_CUT} 00:00:00' as update_timestamp
        from fx_employees e join fx_offices_s2 o on e.officecode = o.officecode""",
    "fx_productlines_s1": "select * from fx_productlines where productline < 'Brand#5'",
    "fx_productlines_s2": f"""
        select productline, create_timestamp, timestamp '{_CUT} 00:00:00' as update_timestamp
        from fx_productlines where productline >= 'Brand#4'""",
    "fx_products_s1": """
        select p.* from fx_products p join fx_productlines_s1 l on p.productline = l.productline""",
    "fx_products_s2": f"""
        select productcode, concat(productname, ' b') as productname, productline, concat(productscale, '0') as productscale,
               concat(productvendor, ' b') as productvendor, cast(quantityinstock + 1 as int) as quantityinstock,
               cast(buyprice + cast(1 as decimal(10,2)) as decimal(10,2)) as buyprice,
               cast(msrp + cast(5 as decimal(10,2)) as decimal(10,2)) as msrp,
               create_timestamp, timestamp '{_CUT} 00:00:00' as update_timestamp
        from fx_products where quantityinstock <= 5 or productline >= 'Brand#5'""",
    "fx_payments_b1": f"""
        select * from fx_payments where update_timestamp < timestamp '{_CUT} 00:00:00'""",
    "fx_payments_b2": f"""
        select * from fx_payments where update_timestamp >= timestamp '{_CUT} 00:00:00'""",
}

_NAMES = re.compile(r"\b(from|join)\s+(\w+)")


def needs(name: str) -> list[str]:
    """Views and raw tables a view reads."""
    return list(dict.fromkeys(t for _, t in _NAMES.findall(VIEWS[name])))


def raw(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One fixture view over the tables of ``sf_dir``."""
    return _view(spark, name, {t: _input(spark, sf_dir, name, t) for t in needs(name)})


def _input(spark: SparkSession, sf_dir: str, name: str, table: str) -> DataFrame:
    """What a view reads: a given table or another view.

    Lines are brought together by order, once: grouping them and joining them with their orders need no further exchange. Of the lines
    of the second batch only those of its orders are grouped.
    """
    if (name, table) == ("fx_orderdetails", "lineitem"):
        return _lines(raw(spark, sf_dir, table))
    if (name, table) == ("fx_orderdetails_b2", "fx_orderdetails"):
        numbers = fixture(spark, sf_dir, "fx_orders_b2").select("ordernumber")
        if numbers.count() <= _FEW:  # counted, as the size of the filtered orders is unknown: few are sent to the lines, which then stay where they are
            numbers = F.broadcast(numbers)
        lines = raw(spark, sf_dir, "lineitem")
        wanted = lines.join(numbers, lines["l_orderkey"] == numbers["ordernumber"], "left_semi")
        return _view(spark, table, {"lineitem": _lines(wanted)})
    if (name, table) == ("fx_orderdetails_b1", "fx_orders_b1"):
        orders = fixture(spark, sf_dir, table)
        return orders if orders.count() <= _FEW else orders.hint("merge")  # too many to be sent, however small their file
    return raw(spark, sf_dir, table) if table in RAW else fixture(spark, sf_dir, table)


def _lines(lineitem: DataFrame) -> DataFrame:
    return lineitem.repartition("l_orderkey")


def _view(spark: SparkSession, name: str, inputs: Mapping[str, DataFrame]) -> DataFrame:
    text = _NAMES.sub(lambda m: f"{m.group(1)} {{{m.group(2)}}}", VIEWS[name])
    return spark.sql(text, **inputs)


def staged(spark: SparkSession, sf_dir: str, table: str, batch: Batch | None = None, split: str = "b") -> DataFrame:
    """A stage table with all its declared columns: the whole fixture, or what a batch sees of it."""
    name = f"fx_{table}_{split}{batch.no}" if batch else f"fx_{table}"
    if name not in VIEWS:
        # Tables without a batch-1 view are complete in batch 1; without a batch-2 view, unchanged.
        base = fixture(spark, sf_dir, f"fx_{table}")
        return conform(base if batch.no == 1 else base.where(F.lit(False)), STAGE[table])
    return conform(fixture(spark, sf_dir, name), STAGE[table])


def cte(*names: str) -> str:
    """``with`` clause text (without the keyword) defining the views and what they need, in order."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in RAW or name in ordered:
            return
        for dep in needs(name):
            visit(dep)
        ordered.append(name)

    for name in names:
        visit(name)
    return ", ".join(f"{n} as ({VIEWS[n]})" for n in ordered)
