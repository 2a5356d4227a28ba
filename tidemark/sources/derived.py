"""Commerce feeds derived from the driver tables (the ``d_*`` inputs).

The reference lands orders, payments, refunds, order items, customer history
and click events.  Here those feeds are plain projections of the TPC-H-like
driver tables, so every plan's work grows with the data.  Each builder has a
twin in ``DERIVED_SQL`` (DuckDB text) used by the correctness oracle; the two
must describe the same rows.

Rules (fixed values of the derivation):
  d_order_versions   v1 from orders: status F->paid, O->processing, P->cancelled;
                     amount = o_totalprice; created_at = o_orderdate + (key mod 1440)
                     minutes; updated_at = created_at.  v2 when key mod 4 = 0: amount
                     + 10, updated_at + 1 day, status cancelled when key mod 3 = 0.
                     v3 when key mod 12 = 0: v1 status, amount + 20, updated_at + 2 days.
  d_customer_history split = 1998-01-01 + (custkey mod 365) days; row 1
                     [1995-01-01, split) unless custkey mod 10 = 0; row 2 [split, open)
                     with city (nationkey + 1) mod 25.
  d_payments         every order is paid in 1 + (key mod 3) parts of its cents, the first parts
                     one cent larger where they do not divide; part i is paid at o_orderdate
                     + 18 hours + (i - 1) days and failed when (key + i) mod 7 = 0; the order
                     is unknown (key + 1000000) when key mod 50 = 0; currency USD when
                     key mod 5 = 0, SGD when it is 1, else IDR.
  d_items            every lineitem row, numbered within its order by all its columns.
  d_refunds          every item of returnflag R, in the currency of the order's payments;
                     refunded_at = shipdate + 18 hours.
  d_clicks           events: view->page_view, click->add_to_cart, purchase->checkout,
                     other types kept (they fail the click contract).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.timeutil import as_utc_instant
from .tables import read_table

MONEY = "decimal(18,2)"
CURRENCY = "IDR"
ORPHAN_OFFSET = 1_000_000


def _money(c: Column) -> Column:
    return c.cast(MONEY)


def order_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source order rows with their observed versions (one scan, no union)."""
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    k = F.col("o_orderkey")
    wanted = F.filter(F.array(F.lit(1), F.lit(2), F.lit(3)),
                      lambda v: (v == 1) | ((v == 2) & (k % 4 == 0)) | ((v == 3) & (k % 12 == 0)))
    status1 = (F.when(F.col("o_orderstatus") == "F", "paid")
                .when(F.col("o_orderstatus") == "O", "processing")
                .when(F.col("o_orderstatus") == "P", "cancelled"))
    created = F.timestamp_add("MINUTE", k % 1440, as_utc_instant("o_orderdate"))
    v = F.col("v")
    return (o.select("*", F.explode(wanted).alias("v"))
             .select(k.cast("string").alias("order_id"),
                     F.col("o_custkey").cast("string").alias("customer_id"),
                     F.when((v == 2) & (k % 3 == 0), F.lit("cancelled")).otherwise(status1).alias("status"),
                     _money(_money(F.col("o_totalprice")) + (v - 1) * 10).alias("amount"),
                     F.lit(CURRENCY).alias("currency"),
                     v.cast("bigint").alias("version"),
                     created.alias("created_at"),
                     F.timestamp_add("DAY", v - 1, created).alias("updated_at")))


def customer_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    k = F.col("c_custkey")
    split = F.timestamp_add("DAY", k % 365, F.to_timestamp(F.lit("1998-01-01 00:00:00")))
    seg = F.filter(F.array(F.lit(1), F.lit(2)), lambda s: (s == 2) | (k % 10 != 0))
    s = F.col("seg")
    return (c.select("*", F.explode(seg).alias("seg"))
             .select(k.cast("string").alias("customer_id"),
                     F.when(s == 1, F.col("c_nationkey"))
                      .otherwise((F.col("c_nationkey") + 1) % 25).cast("string").alias("city"),
                     F.col("c_mktsegment").alias("membership"),
                     F.when(s == 1, F.to_timestamp(F.lit("1995-01-01 00:00:00")))
                      .otherwise(split).alias("valid_from"),
                     F.when(s == 1, split).alias("valid_to")))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").cast("string").alias("product_id"),
                    F.col("p_name").alias("product_name"),
                    F.col("p_type").alias("category"),
                    _money(F.col("p_retailprice")).alias("current_price"))


def _currency_of(key: Column) -> Column:
    return F.when(key % 5 == 0, "USD").when(key % 5 == 1, "SGD").otherwise(CURRENCY)


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several part payments per order, in three currencies."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    k, i = F.col("o_orderkey"), F.col("i")
    parts = 1 + k % 3
    cents = (_money(F.col("o_totalprice")) * 100).cast("bigint")
    part = F.expr("cents div parts") + (i <= F.col("cents") % F.col("parts")).cast("bigint")
    return (o.select("*", cents.alias("cents"), parts.alias("parts"), F.explode(F.sequence(F.lit(1).cast("bigint"), parts)).alias("i"))
             .select((k * 10 + i).cast("string").alias("payment_id"),
                     F.when(k % 50 == 0, k + ORPHAN_OFFSET).otherwise(k).cast("string").alias("order_id"),
                     F.lit(1).cast("bigint").alias("version"),
                     (part.cast("decimal(18,0)") * F.lit("0.01").cast("decimal(3,2)")).cast(MONEY).alias("amount"),
                     _currency_of(k).alias("currency"),
                     F.when((k + i) % 7 == 0, "failed").otherwise("succeeded").alias("status"),
                     F.timestamp_add("HOUR", 18 + (i - 1) * 24, as_utc_instant("o_orderdate")).alias("paid_at")))


_LINE_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
               "l_returnflag", "l_linestatus", "l_shipdate")


def numbered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every lineitem row with its number in its order; equal rows are interchangeable."""
    number = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*_LINE_ORDER))
    return read_table(spark, sf_dir, "lineitem").withColumn("line_number", number).select(
        "l_orderkey", "line_number", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate")


def refunds(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """One refund per returned line: several per order and day.  ``lines``: the numbered lines, if written already."""
    returned = (numbered_lines(spark, sf_dir) if lines is None else lines).where(F.col("l_returnflag") == "R")
    return returned.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("line_number").cast("string")).alias("refund_id"),
        F.col("l_orderkey").cast("string").alias("order_id"),
        _money(F.col("l_extendedprice")).alias("amount"),
        _currency_of(F.col("l_orderkey")).alias("currency"),
        F.timestamp_add("HOUR", F.lit(18), as_utc_instant("l_shipdate")).alias("refunded_at"))


def order_items(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    return (numbered_lines(spark, sf_dir) if lines is None else lines).select(
        F.col("l_orderkey").cast("string").alias("order_id"), F.col("line_number").cast("int").alias("line_number"),
        F.col("l_partkey").cast("string").alias("product_id"), F.col("l_quantity").cast("int").alias("quantity"),
        _money(F.col("l_extendedprice")).alias("unit_price"))


CLICK_TYPES = {"view": "page_view", "click": "add_to_cart", "purchase": "checkout"}


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    et = F.col("event_type")
    mapped = (F.when(et == "view", "page_view").when(et == "click", "add_to_cart")
               .when(et == "purchase", "checkout").otherwise(et))
    return e.select(F.col("event_id").cast("string").alias("event_id"),
                    F.col("user_id").cast("string").alias("customer_id"),
                    mapped.alias("event_type"),
                    as_utc_instant("ts").alias("event_time"))


# ---------------------------------------------------------------- oracle twins
_CURRENCY = "case {} % 5 when 0 then 'USD' when 1 then 'SGD' else 'IDR' end"
_LINES = f"""(select *, row_number() over (partition by l_orderkey order by {', '.join(_LINE_ORDER)}) as line_number
  from lineitem)"""
_MIN = "to_minutes(cast(o_orderkey % 1440 as bigint))"

DERIVED_SQL = {
    "d_order_versions": f"""
select cast(o_orderkey as varchar) as order_id, cast(o_custkey as varchar) as customer_id,
  case when v = 2 and o_orderkey % 3 = 0 then 'cancelled'
       else case o_orderstatus when 'F' then 'paid' when 'O' then 'processing'
                               when 'P' then 'cancelled' end end as status,
  cast(cast(o_totalprice as decimal(18,2)) + (v - 1) * 10 as decimal(18,2)) as amount,
  'IDR' as currency, cast(v as bigint) as version,
  o_orderdate + {_MIN} as created_at,
  o_orderdate + {_MIN} + to_days(cast(v - 1 as integer)) as updated_at
from orders cross join (values (1), (2), (3)) vv(v)
where v = 1 or (v = 2 and o_orderkey % 4 = 0) or (v = 3 and o_orderkey % 12 = 0)""",
    "d_customer_history": """
select cast(c_custkey as varchar) as customer_id,
  cast(case when s = 1 then c_nationkey else (c_nationkey + 1) % 25 end as varchar) as city,
  c_mktsegment as membership,
  case when s = 1 then timestamp '1995-01-01 00:00:00'
       else timestamp '1998-01-01 00:00:00' + to_days(cast(c_custkey % 365 as integer)) end as valid_from,
  case when s = 1 then timestamp '1998-01-01 00:00:00' + to_days(cast(c_custkey % 365 as integer)) end as valid_to
from customer cross join (values (1), (2)) ss(s)
where s = 2 or c_custkey % 10 <> 0""",
    "d_products": """
select cast(p_partkey as varchar) as product_id, p_name as product_name, p_type as category,
  cast(p_retailprice as decimal(18,2)) as current_price from part""",
    "d_payments": f"""
select cast(o_orderkey * 10 + i as varchar) as payment_id,
  cast(case when o_orderkey % 50 = 0 then o_orderkey + 1000000 else o_orderkey end as varchar) as order_id,
  cast(1 as bigint) as version,
  cast((cents // parts + case when i <= cents % parts then 1 else 0 end) * 0.01 as decimal(18,2)) as amount,
  {_CURRENCY.format('o_orderkey')} as currency,
  case when (o_orderkey + i) % 7 = 0 then 'failed' else 'succeeded' end as status,
  o_orderdate + interval 18 hour + to_days(cast(i - 1 as integer)) as paid_at
from (select *, unnest(range(1, 2 + o_orderkey % 3)) as i, 1 + o_orderkey % 3 as parts,
        cast(cast(o_totalprice as decimal(18,2)) * 100 as bigint) as cents from orders)""",
    "d_refunds": f"""
select cast(l_orderkey as varchar) || '-' || cast(line_number as varchar) as refund_id,
  cast(l_orderkey as varchar) as order_id, cast(l_extendedprice as decimal(18,2)) as amount,
  {_CURRENCY.format('l_orderkey')} as currency, l_shipdate + interval 18 hour as refunded_at
from {_LINES} where l_returnflag = 'R'""",
    "d_items": f"""
select cast(l_orderkey as varchar) as order_id, cast(line_number as integer) as line_number,
  cast(l_partkey as varchar) as product_id, cast(l_quantity as integer) as quantity,
  cast(l_extendedprice as decimal(18,2)) as unit_price
from {_LINES}""",
    "d_clicks": """
select cast(event_id as varchar) as event_id, cast(user_id as varchar) as customer_id,
  case event_type when 'view' then 'page_view' when 'click' then 'add_to_cart'
                  when 'purchase' then 'checkout' else event_type end as event_type,
  ts as event_time
from events""",
}
