"""Registered queries (``queries()``) and their DuckDB oracle twins.

Keys follow the coverage plan; every query reads the whole driver tables (or
feeds Spark derives from them) and returns ``portable`` columns.
"""

from __future__ import annotations

import uuid as _uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from .. import session as _session
from ..functions.portable import portable
from ..operators import checks
from ..operators.versions import insert_if_absent
from ..sources import derived as d
from ..sources import scan
from . import marts, quality
from . import warehouse as wh

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            _session.configure(spark)
            return portable(fn(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco


# SQL snippets shared by the oracle texts ------------------------------------
JKT = "cast({} + interval 7 hour as date)"   # Asia/Jakarta has a fixed +07:00 offset
TS = "strftime({}, '%Y-%m-%d %H:%M:%S.%f')"

STG_ORDERS_SQL = """stg_orders as (
  select * exclude (rn) from (select *, row_number() over (partition by order_id
    order by version desc, updated_at desc) as rn from d_order_versions) where rn = 1)"""
DIM_CUSTOMER_SQL = """dim_customer as (
  select md5(customer_id || '|' || cast(valid_from as varchar)) as customer_sk, *
  from d_customer_history)"""
FCT_ORDERS_SQL = f"""fct_orders as (
  select o.*, c.customer_sk, {JKT.format('o.created_at')} as order_date
  from stg_orders o left join dim_customer c on o.customer_id = c.customer_id
   and o.created_at >= c.valid_from and (c.valid_to is null or o.created_at < c.valid_to))"""
FCT_PAYMENTS_SQL = f"""fct_payments as (
  select *, {JKT.format('paid_at')} as payment_date from d_payments)"""
FCT_REFUNDS_SQL = f"""fct_refunds as (
  select *, {JKT.format('refunded_at')} as refund_date from d_refunds)"""
FCT_ITEMS_SQL = """fct_order_items as (
  select md5(i.order_id || '|' || cast(i.line_number as varchar)) as order_item_sk,
    i.order_id, i.line_number, i.product_id, i.quantity, i.unit_price,
    i.quantity * i.unit_price as line_amount, o.customer_sk, o.order_date, o.currency
  from d_items i join fct_orders o on i.order_id = o.order_id
  join d_products p on i.product_id = p.product_id)"""
DAILY_FINANCE_SQL = """daily_finance as (
  select date_day, currency, sum(revenue) as revenue, sum(refund) as refund,
    sum(revenue) - sum(refund) as net
  from (select payment_date as date_day, currency, amount as revenue, 0::decimal(18,2) as refund
        from fct_payments where status = 'succeeded'
        union all
        select refund_date, currency, 0::decimal(18,2), amount from fct_refunds) m
  group by date_day, currency)"""


def _sql(views: tuple, ctes: list[str], body: str) -> str:
    """Oracle text: derived views and shared CTEs, then the final select."""
    defs = [f"{n} as ({d.DERIVED_SQL[n]})" for n in views] + list(ctes)
    return ("with " + ",\n".join(defs) + "\n" if defs else "") + body


# Feeds and warehouse frames ---------------------------------------------------
def lake_orders(spark, sf):
    return marts.with_order_date(d.order_versions(spark, sf))


def fct_orders(spark, sf):
    return wh.fct_orders(wh.stg_orders(d.order_versions(spark, sf)),
                         wh.dim_customer(d.customer_history(spark, sf)))


def fct_payments(spark, sf):
    return wh.fct_payments(wh.stg_payments(d.payments(spark, sf)))


def fct_refunds(spark, sf):
    return wh.fct_refunds(d.refunds(spark, sf))


# A1 / W3 / M13 ---------------------------------------------------------------
@register("daily_orders", _sql(("d_order_versions",), [STG_ORDERS_SQL], f"""
select cast({JKT.format('created_at')} as varchar) as event_date, currency,
  cast(count(*) as bigint) as order_count, cast(sum(amount) as double) as order_value
from stg_orders where status <> 'cancelled' group by all"""))
def q_daily_orders(spark, sf):
    """The reference's own Spark job: latest version, drop cancelled, daily sums."""
    return marts.daily_orders(lake_orders(spark, sf))


@register("latest_orders", _sql(("d_order_versions",), [STG_ORDERS_SQL], f"""
select order_id, customer_id, status, cast(amount as double) as amount, currency,
  cast(version as bigint) as version, {TS.format('created_at')} as created_at,
  {TS.format('updated_at')} as updated_at from stg_orders"""))
def q_latest_orders(spark, sf):
    """Newest observed version per order."""
    return wh.stg_orders(d.order_versions(spark, sf))


@register("latest_payments", _sql(("d_payments",), [
    """d_payment_versions as (
  select * from d_payments union all
  select payment_id, order_id, cast(2 as bigint), cast(amount + 1 as decimal(18,2)), currency,
    status, paid_at + interval 1 hour from d_payments where cast(payment_id as bigint) % 9 = 0)""",
    """stg_payments as (select * exclude (rn) from (select *, row_number() over (
  partition by payment_id order by version desc, paid_at desc) as rn from d_payment_versions)
  where rn = 1)"""], f"""
select payment_id, order_id, cast(version as bigint) as version, cast(amount as double) as amount,
  currency, status, {TS.format('paid_at')} as paid_at from stg_payments"""))
def q_latest_payments(spark, sf):
    """Newest payment version; every 9th payment got a second version."""
    p = d.payments(spark, sf)
    v2 = (p.where(F.col("payment_id").cast("bigint") % 9 == 0)
           .select("payment_id", "order_id", F.lit(2).cast("bigint").alias("version"),
                   (F.col("amount") + 1).cast("decimal(18,2)").alias("amount"), "currency", "status",
                   F.timestamp_add("HOUR", F.lit(1), F.col("paid_at")).alias("paid_at")))
    return wh.stg_payments(p.unionByName(v2))


@register("asof_customer", _sql(("d_order_versions", "d_customer_history"),
                                 [STG_ORDERS_SQL, DIM_CUSTOMER_SQL, FCT_ORDERS_SQL], f"""
select order_id, customer_id, status, cast(amount as double) as amount, currency,
  cast(version as bigint) as version, {TS.format('created_at')} as created_at,
  {TS.format('updated_at')} as updated_at, customer_sk, cast(order_date as varchar) as order_date
from fct_orders"""))
def q_asof_customer(spark, sf):
    """Current orders with the customer version valid at creation."""
    return fct_orders(spark, sf)


@register("orders_by_city_membership", _sql(("d_order_versions", "d_customer_history"),
                                             [STG_ORDERS_SQL, DIM_CUSTOMER_SQL, FCT_ORDERS_SQL], """
select cast(o.order_date as varchar) as order_date, c.city, c.membership, o.currency,
  cast(count(*) as bigint) as order_count, cast(sum(o.amount) as double) as order_amount
from fct_orders o join dim_customer c on o.customer_sk = c.customer_sk
where o.status <> 'cancelled' group by all"""))
def q_orders_by_city_membership(spark, sf):
    """A4 / J10 / M12."""
    dim = wh.dim_customer(d.customer_history(spark, sf))
    fo = wh.fct_orders(wh.stg_orders(d.order_versions(spark, sf)), dim)
    return marts.orders_by_city_membership(fo, dim)


@register("daily_finance", _sql(("d_payments", "d_refunds"),
                                 [FCT_PAYMENTS_SQL, FCT_REFUNDS_SQL, DAILY_FINANCE_SQL], """
select cast(date_day as varchar) as date_day, currency, cast(revenue as double) as revenue,
  cast(refund as double) as refund, cast(net as double) as net from daily_finance"""))
def q_daily_finance(spark, sf):
    """A2 / U1 / M8-M10."""
    return marts.daily_finance(fct_payments(spark, sf), fct_refunds(spark, sf))


@register("daily_clickstream", _sql(("d_clicks",), [], f"""
select cast({JKT.format('event_time')} as varchar) as date_day, event_type,
  cast(count(*) as bigint) as event_count, cast(count(distinct customer_id) as bigint) as unique_customers
from d_clicks where event_type in ('page_view', 'add_to_cart', 'checkout') group by all"""))
def q_daily_clickstream(spark, sf):
    """A3 / M11 over the contract-valid click events."""
    from ..functions.contracts import click_errors
    c = d.clicks(spark, sf)
    return marts.daily_clickstream(c.where(F.size(click_errors(c)) == 0))


@register("order_items_fact", _sql(("d_order_versions", "d_customer_history", "d_items", "d_products"),
                                    [STG_ORDERS_SQL, DIM_CUSTOMER_SQL, FCT_ORDERS_SQL, FCT_ITEMS_SQL], """
select order_item_sk, order_id, cast(line_number as bigint) as line_number, product_id,
  cast(quantity as bigint) as quantity, cast(unit_price as double) as unit_price,
  cast(line_amount as double) as line_amount, customer_sk, cast(order_date as varchar) as order_date,
  currency from fct_order_items"""))
def q_order_items_fact(spark, sf):
    """J2 / P8 / M7."""
    return wh.fct_order_items(d.order_items(spark, sf), fct_orders(spark, sf),
                              wh.dim_product(d.products(spark, sf)))


# Quality, reconciliation ------------------------------------------------------
def daily_finance_frame(spark, sf):
    return marts.daily_finance(fct_payments(spark, sf), fct_refunds(spark, sf))


@register("product_dimension", _sql(("d_products",), [], """
select product_id, product_name, category, cast(current_price as double) as current_price from d_products"""))
def q_product_dimension(spark, sf):
    """M4: the product dimension, row by row."""
    return wh.dim_product(d.products(spark, sf))


@register("payments_fact", _sql(("d_payments",), [FCT_PAYMENTS_SQL], f"""
select payment_id, order_id, cast(version as bigint) as version, cast(amount as double) as amount, currency, status,
  {TS.format('paid_at')} as paid_at, cast(payment_date as varchar) as payment_date from fct_payments"""))
def q_payments_fact(spark, sf):
    """M8: payments with their business date, row by row."""
    return fct_payments(spark, sf)


@register("refunds_fact", _sql(("d_refunds",), [FCT_REFUNDS_SQL], f"""
select refund_id, order_id, cast(amount as double) as amount, currency, {TS.format('refunded_at')} as refunded_at,
  cast(refund_date as varchar) as refund_date from fct_refunds"""))
def q_refunds_fact(spark, sf):
    """M9: refunds with their business date, row by row."""
    return fct_refunds(spark, sf)


@register("orphan_payments", _sql(("d_order_versions", "d_customer_history", "d_payments"),
                                   [STG_ORDERS_SQL, DIM_CUSTOMER_SQL, FCT_ORDERS_SQL, FCT_PAYMENTS_SQL], """
select p.payment_id, p.order_id from fct_payments p
where not exists (select 1 from fct_orders o where o.order_id = p.order_id)"""))
def q_orphan_payments(spark, sf):
    """Payments whose order is unknown (anti join)."""
    return (fct_payments(spark, sf).select("payment_id", "order_id")
            .join(fct_orders(spark, sf).select("order_id"), on="order_id", how="left_anti")
            .select("payment_id", "order_id"))


@register("items_reconcile", _sql(("d_order_versions", "d_customer_history", "d_items", "d_products"),
                                   [STG_ORDERS_SQL, DIM_CUSTOMER_SQL, FCT_ORDERS_SQL, FCT_ITEMS_SQL], """
select o.order_id from fct_orders o left join fct_order_items i on o.order_id = i.order_id
group by o.order_id, o.amount having sum(i.line_amount) is distinct from o.amount"""))
def q_items_reconcile(spark, sf):
    """Item totals distinct from the order amount."""
    fo = fct_orders(spark, sf)
    items = wh.fct_order_items(d.order_items(spark, sf), fo, wh.dim_product(d.products(spark, sf)))
    return quality.items_reconcile(fo, items)


@register("finance_reconcile", _sql(("d_payments", "d_refunds"),
                                     [FCT_PAYMENTS_SQL, FCT_REFUNDS_SQL, DAILY_FINANCE_SQL], """
select cast(n as double) as net_total, cast(p as double) as paid_total, cast(r as double) as refund_total,
  n is not distinct from (p - r) as passed
from (select (select coalesce(sum(net), 0) from daily_finance) as n,
             (select coalesce(sum(amount), 0) from fct_payments where status = 'succeeded') as p,
             (select coalesce(sum(amount), 0) from fct_refunds) as r) t"""))
def q_finance_reconcile(spark, sf):
    """Mart net equals succeeded payments minus refunds."""
    return quality.finance_reconcile(fct_payments(spark, sf), fct_refunds(spark, sf),
                                     daily_finance_frame(spark, sf))


@register("refunds_not_above_paid", _sql(("d_payments", "d_refunds"), [FCT_PAYMENTS_SQL, FCT_REFUNDS_SQL], """
select r.order_id from (select order_id, sum(amount) as amount from fct_refunds group by order_id) r
left join (select order_id, sum(amount) as amount from fct_payments where status = 'succeeded'
           group by order_id) p on r.order_id = p.order_id
where r.amount > coalesce(p.amount, 0)"""))
def q_refunds_not_above_paid(spark, sf):
    """Refunds per order above succeeded payments per order."""
    return quality.refunds_not_above_paid(fct_refunds(spark, sf), fct_payments(spark, sf))


@register("quality_gates", _sql(("d_order_versions", "d_customer_history", "d_payments", "d_refunds"),
                                 [STG_ORDERS_SQL, DIM_CUSTOMER_SQL, FCT_ORDERS_SQL, FCT_PAYMENTS_SQL,
                                  FCT_REFUNDS_SQL, DAILY_FINANCE_SQL], """
select 'orders_loaded' as gate, cast(case when count(*) > 0 then 0 else 1 end as bigint) as value from fct_orders
union all select 'customer_mapping', cast(count(*) as bigint) from fct_orders where customer_sk is null
union all select 'orphan_payments', cast(count(*) as bigint) from fct_payments p
  left join fct_orders o using (order_id) where o.order_id is null
union all select 'finance_reconciliation', cast(case when
  (select coalesce(sum(net), 0) from daily_finance) =
  (select coalesce(sum(amount), 0) from fct_payments where status = 'succeeded') -
  (select coalesce(sum(amount), 0) from fct_refunds) then 0 else 1 end as bigint)
union all select 'negative_payment_amount', cast(count(*) as bigint) from fct_payments where amount < 0"""))
def q_quality_gates(spark, sf):
    """The five blocking gates; 0 means pass."""
    fp, fr = fct_payments(spark, sf), fct_refunds(spark, sf)
    return quality.gate_values(fct_orders(spark, sf), fp, fr, marts.daily_finance(fp, fr))


_DIM_DATE_SQL = f"""dim_date as (
  select d::date as date_day, cast(year(d) as integer) as year, cast(month(d) as integer) as month,
    cast(day(d) as integer) as day
  from (select min({JKT.format('created_at')}) as lo, max({JKT.format('created_at')}) as hi
        from d_order_versions) b, generate_series(b.lo, b.hi, interval 1 day) g(d))"""

_GENERIC_MODELS = ("d_order_versions", "d_customer_history", "d_payments", "d_refunds", "d_items",
                   "d_products")
_GENERIC_CTES = [STG_ORDERS_SQL, DIM_CUSTOMER_SQL, FCT_ORDERS_SQL, FCT_PAYMENTS_SQL, FCT_REFUNDS_SQL,
                 FCT_ITEMS_SQL, _DIM_DATE_SQL]


def _generic_sql() -> str:
    def uniq(m, c):
        return (f"(select count(*) from (select {c} from {m} where {c} is not null "
                f"group by {c} having count(*) > 1))")

    def nn(m, c):
        return f"(select count(*) from {m} where {c} is null)"

    def rel(m, c, p, pc):
        return (f"(select count(*) from {m} x where x.{c} is not null and not exists "
                f"(select 1 from {p} y where y.{pc} = x.{c}))")
    tests = [
        ("dim_customer", "customer_sk", "unique", uniq("dim_customer", "customer_sk")),
        ("dim_customer", "customer_sk", "not_null", nn("dim_customer", "customer_sk")),
        ("dim_product", "product_id", "unique", uniq("d_products", "product_id")),
        ("dim_product", "product_id", "not_null", nn("d_products", "product_id")),
        ("fct_orders", "order_id", "unique", uniq("fct_orders", "order_id")),
        ("fct_orders", "order_id", "not_null", nn("fct_orders", "order_id")),
        ("fct_orders", "customer_sk", "not_null", nn("fct_orders", "customer_sk")),
        ("fct_orders", "customer_sk", "relationships", rel("fct_orders", "customer_sk", "dim_customer", "customer_sk")),
        ("fct_orders", "currency", "accepted_values",
         "(select count(*) from fct_orders where currency not in ('IDR'))"),
        ("fct_order_items", "order_item_sk", "unique", uniq("fct_order_items", "order_item_sk")),
        ("fct_order_items", "order_item_sk", "not_null", nn("fct_order_items", "order_item_sk")),
        ("fct_order_items", "order_id", "relationships", rel("fct_order_items", "order_id", "fct_orders", "order_id")),
        ("fct_payments", "payment_id", "unique", uniq("fct_payments", "payment_id")),
        ("fct_payments", "payment_id", "not_null", nn("fct_payments", "payment_id")),
        ("fct_payments", "order_id", "relationships", rel("fct_payments", "order_id", "fct_orders", "order_id")),
        ("fct_refunds", "refund_id", "unique", uniq("fct_refunds", "refund_id")),
        ("fct_refunds", "refund_id", "not_null", nn("fct_refunds", "refund_id")),
        ("fct_refunds", "order_id", "relationships", rel("fct_refunds", "order_id", "fct_orders", "order_id")),
        ("dim_date", "date_day", "unique", uniq("dim_date", "date_day")),
        ("dim_date", "date_day", "not_null", nn("dim_date", "date_day")),
    ]
    body = "\nunion all ".join(
        f"select '{m}' as model, '{c}' as column_name, '{t}' as test, cast({q} as bigint) as failures"
        for m, c, t, q in tests)
    return _sql(_GENERIC_MODELS, _GENERIC_CTES, body)


def order_calendar(spark, sf):
    """M5 with data-driven bounds: every business day between the first and the
    last order creation (bounds found by one aggregate, expanded on executors)."""
    from ..functions.timeutil import business_date, date_parts
    b = d.order_versions(spark, sf).agg(F.min(business_date("created_at")).alias("lo"),
                                        F.max(business_date("created_at")).alias("hi"))
    days = b.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("date_day"))
    return days.select("date_day", *date_parts("date_day"))


def built_models(spark, sf):
    """All warehouse and mart models, table models materialised once."""
    from ..functions.contracts import click_errors
    from . import models
    c = d.clicks(spark, sf)
    root = f"{_session.shared_dir(spark)}/tidemark-models/{_uuid.uuid4().hex}"
    # the lines are numbered once for items and refunds
    numbered = d.numbered_lines(spark, sf)
    numbered.write.option("compression", "zstd").parquet(f"{root}/_lines")
    lines = spark.read.schema(numbered.schema).parquet(f"{root}/_lines")
    sources = {"order_versions": d.order_versions(spark, sf), "payment_versions": d.payments(spark, sf),
               "customer_history": d.customer_history(spark, sf), "products": d.products(spark, sf),
               "order_items": d.order_items(spark, sf, lines), "refunds": d.refunds(spark, sf, lines),
               "clicks": c.where(F.size(click_errors(c)) == 0)}
    return models.build(spark, sources, root, dim_date=None), root


@register("generic_tests", _generic_sql())
def q_generic_tests(spark, sf):
    """Q7-Q10: the 20 declared column tests over the materialised models; the
    date dimension spans the order dates."""
    built, _ = built_models(spark, sf)
    b = order_calendar(spark, sf)
    built["dim_date"] = b.select("date_day", *[c for c in b.columns if c != "date_day"])
    return quality.generic_tests(built)


@register("calendar", _sql(("d_order_versions",), [_DIM_DATE_SQL], """
select cast(date_day as varchar) as date_day, cast(year as bigint) as year, cast(month as bigint) as month,
  cast(day as bigint) as day from dim_date"""))
def q_calendar(spark, sf):
    """The date dimension over the order dates."""
    return order_calendar(spark, sf)


_SHIFTED_HISTORY_SQL = """shifted as (
  select customer_id, city, membership,
    case when valid_to is null and cast(customer_id as bigint) % 7 = 0
         then valid_from - interval 30 day else valid_from end as valid_from, valid_to
  from d_customer_history)"""


def shifted_history(spark, sf):
    """Customer history with every 7th customer's current row starting 30 days
    early, so it overlaps the previous row where one exists."""
    h = d.customer_history(spark, sf)
    shift = F.col("valid_to").isNull() & (F.col("customer_id").cast("bigint") % 7 == 0)
    return h.withColumn("valid_from", F.when(shift, F.timestamp_add("DAY", F.lit(-30), F.col("valid_from")))
                        .otherwise(F.col("valid_from")))


@register("history_overlap", _sql(("d_customer_history",), [_SHIFTED_HISTORY_SQL], """
select distinct a.customer_id from shifted a join shifted b
  on a.customer_id = b.customer_id and a.valid_from < b.valid_from
 and (a.valid_to is null or a.valid_to > b.valid_from)"""))
def q_history_overlap(spark, sf):
    """Customers whose history rows overlap."""
    return checks.history_overlaps(shifted_history(spark, sf)).select("customer_id").distinct()


@register("two_path_reconcile", _sql(("d_order_versions", "d_customer_history"),
                                      [STG_ORDERS_SQL, DIM_CUSTOMER_SQL, FCT_ORDERS_SQL], f"""
select cast(coalesce(l.event_date, w.order_date) as varchar) as event_date,
  coalesce(l.currency, w.currency) as currency,
  cast(l.order_count as bigint) as lake_order_count, cast(l.order_value as double) as lake_order_value,
  cast(w.order_count as bigint) as warehouse_order_count, cast(w.order_value as double) as warehouse_order_value,
  (l.order_count is not distinct from w.order_count and l.order_value is not distinct from w.order_value) as matched
from (select {JKT.format('created_at')} as event_date, currency, count(*) as order_count,
             sum(amount) as order_value from stg_orders where status <> 'cancelled' group by all) l
full outer join (select order_date, currency, count(*) as order_count, sum(amount) as order_value
             from fct_orders where status <> 'cancelled' group by all) w
  on l.event_date is not distinct from w.order_date and l.currency is not distinct from w.currency"""))
def q_two_path_reconcile(spark, sf):
    """The mart of a verified snapshot (A1) against the warehouse fact over
    the landed payloads, per day and currency; ``matched`` false marks a difference."""
    from ..sources import snapshot as snap
    from .ingest import landed_orders
    landed, root = _snapshot_lake(spark, sf)
    lake = spark.read.parquet(f"{snap.build_spark_mart(spark, root)['path']}/data")
    fact = wh.fct_orders(wh.stg_landed_orders(landed_orders(landed)), wh.dim_customer(d.customer_history(spark, sf)))
    whs = (fact.where(F.col("status") != "cancelled")
           .groupBy(F.col("order_date").alias("event_date"), "currency")
           .agg(F.count(F.lit(1)).alias("order_count"), F.sum("amount").alias("order_value")))
    return checks.reconcile(lake, whs, ["event_date", "currency"], ["order_count", "order_value"])


@register("seed_insert_if_absent", _sql(("d_products",), [], """
select product_id, product_name, category, cast(current_price as double) as current_price
from d_products where cast(product_id as bigint) % 3 <> 0"""))
def q_seed_insert_if_absent(spark, sf):
    """Reference rows to insert when every third product is stored
    already and the incoming load repeats every fifth product."""
    prods = d.products(spark, sf)
    existing = prods.where(F.col("product_id").cast("bigint") % 3 == 0)
    incoming = prods.unionByName(prods.where(F.col("product_id").cast("bigint") % 5 == 0))
    return insert_if_absent(incoming, existing, ["product_id"])


@register("surrogate_keys", _sql(("d_customer_history",), [DIM_CUSTOMER_SQL], f"""
select customer_sk, customer_id, city, membership, {TS.format('valid_from')} as valid_from,
  {TS.format('valid_to')} as valid_to from dim_customer"""))
def q_surrogate_keys(spark, sf):
    """Type 2 customer dimension with md5 surrogate keys."""
    return wh.dim_customer(d.customer_history(spark, sf))


@register("business_date", """
select cast(event_id as varchar) as event_id, cast(cast(ts as date) as varchar) as utc_date,
  cast(cast(ts + interval 7 hour as date) as varchar) as business_date from events""")
def q_business_date(spark, sf):
    """UTC date and Asia/Jakarta business date of every event."""
    from ..functions.timeutil import as_utc_instant, business_date
    from ..sources.tables import read_table
    e = read_table(spark, sf, "events").select("event_id", as_utc_instant("ts").alias("t"))
    return e.select(F.col("event_id").cast("string").alias("event_id"),
                    F.to_date("t").alias("utc_date"), business_date("t").alias("business_date"))


SCAN_WINDOW = scan.Window(datetime(1997, 1, 1, tzinfo=timezone.utc), datetime(1998, 1, 1, tzinfo=timezone.utc))
PAGE_CURSOR = (datetime(1997, 6, 1, tzinfo=timezone.utc), "5000")
PAGE_SIZE = 1000

_SCAN_COLS = f"""order_id, customer_id, status, cast(amount as double) as amount, currency,
  cast(version as bigint) as version, {TS.format('created_at')} as created_at,
  {TS.format('updated_at')} as updated_at"""


@register("change_scan", _sql(("d_order_versions",), [], f"""
select {_SCAN_COLS} from d_order_versions
where updated_at >= timestamp '1997-01-01 00:00:00' and updated_at < timestamp '1998-01-01 00:00:00'"""))
def q_change_scan(spark, sf):
    """Every version changed inside [1997-01-01, 1998-01-01) UTC."""
    return scan.change_scan(d.order_versions(spark, sf), SCAN_WINDOW)


@register("keyset_page", _sql(("d_order_versions",), [], f"""
select {_SCAN_COLS} from d_order_versions
where updated_at >= timestamp '1997-01-01 00:00:00' and updated_at < timestamp '1998-01-01 00:00:00'
  and (updated_at > timestamp '1997-06-01 00:00:00'
       or (updated_at = timestamp '1997-06-01 00:00:00' and order_id > '5000'))
order by updated_at, order_id limit 1000"""))
def q_keyset_page(spark, sf):
    """The page of 1000 rows after cursor (1997-06-01, '5000')."""
    return scan.keyset_page(d.order_versions(spark, sf), SCAN_WINDOW, PAGE_SIZE, *PAGE_CURSOR)


WALK_PAGE = 5000


def change_log(spark, sf):
    """The order versions as a source laid out by time of change."""
    return scan.ChangeLog.write(d.order_versions(spark, sf), f"{_session.shared_dir(spark)}/tidemark-changes/{_uuid.uuid4().hex}")


@register("laid_out_scan", ORACLE_SQL["change_scan"])
def q_laid_out_scan(spark, sf):
    """S1 / V8 over a source laid out by time: the window prunes folders and row groups."""
    return change_log(spark, sf).scan(SCAN_WINDOW)


@register("keyset_walk", _sql(("d_order_versions",), [], f"""
select order_id, cast(version as bigint) as version, {TS.format('updated_at')} as updated_at,
  cast((row_number() over (order by updated_at, order_id) - 1) // {WALK_PAGE} as bigint) as page
from d_order_versions
where updated_at >= timestamp '1997-01-01 00:00:00' and updated_at < timestamp '1998-01-01 00:00:00'"""))
def q_keyset_walk(spark, sf):
    """The whole window page by page, each from the cursor of the one before."""
    out = None
    for pages in change_log(spark, sf).walk(SCAN_WINDOW, WALK_PAGE):
        rows = pages.select("order_id", "version", "updated_at", F.col("_page").alias("page"))
        out = rows if out is None else out.unionByName(rows)
    return out


# Contracts --------------------------------------------------------------------
def _oe_sql() -> str:
    from ..functions import contracts as c
    from ..sources.events import order_event_text
    known = ", ".join(f"'{f}'" for f in c.ORDER_EVENT_FIELDS + ("extra_fields",))
    enum = ", ".join(f"'{e}'" for e in c.ORDER_EVENT_TYPES)

    def jt(f):
        return f"json_type(s, '$.{f}')"

    def txt(f):
        return f"(case when {jt(f)} = 'VARCHAR' then json_extract_string(s, '$.{f}') end)"

    def blank(f):
        return f"coalesce(trim({txt(f)}) = '', true)"
    missing = ", ".join(f"case when {jt(f)} is null then '{f}' end" for f in c.ORDER_EVENT_FIELDS)
    return f"""
with ev as (select cast(o_orderkey as varchar) as ref, {order_event_text('duckdb')} as s from orders),
f as (
  select ref, s, coalesce(json_valid(s) and json_type(s) = 'OBJECT', false) as is_obj,
    concat_ws(',', {missing}) as missing,
    {txt('event_type')} as etype, {txt('event_time')} as ttext,
    case when {jt('amount')} = 'VARCHAR' then json_extract_string(s, '$.amount')
         when {jt('amount')} in ('BIGINT', 'UBIGINT', 'DOUBLE') then cast(json_extract(s, '$.amount') as varchar)
    end as atext,
    {jt('extra_fields')} as xtype, {jt('version')} as vtype,
    {blank('event_id')} as b_event, {blank('order_id')} as b_order, {blank('customer_id')} as b_cust,
    {txt('currency')} as cur
  from ev),
g as (
  select *,
    case when regexp_matches(atext, '{c.NUMBER_TEXT}') then 'number'
         when regexp_matches(atext, '{c.SPECIAL_NUMBER_TEXT}') then 'special' end as akind,
    not coalesce(regexp_matches(ttext, '{c.ISO_DATETIME}')
      and try_cast(regexp_replace(ttext, '[zZ]$', '+00:00') as timestamptz) is not null, false) as bad_time,
    coalesce(xtype is not null and xtype <> 'OBJECT', false) as bad_extras,
    coalesce(vtype in ('BIGINT', 'UBIGINT') and cast(json_extract(s, '$.version') as bigint) >= 1, false) as v_ok
  from f),
h as (
  select *,
    case when not is_obj then 'parse' when missing <> '' then 'missing'
         when coalesce(etype not in ({enum}), true) then 'parse'
         when bad_time or akind is null or bad_extras then 'parse' end as error_kind,
    case when not is_obj then 'payload' when missing <> '' then missing
         when coalesce(etype not in ({enum}), true) then 'event_type'
         when bad_time then 'event_time' when akind is null then 'amount'
         when bad_extras then 'extra_fields' end as error_field,
    concat_ws(',', case when b_event then 'event_id' end, case when b_order then 'order_id' end,
      case when b_cust then 'customer_id' end,
      case when not coalesce(regexp_matches(ttext, '{ZONED}'), false) then 'event_time' end,
      case when akind = 'special' then 'amount' end,
      case when not coalesce(regexp_matches(cur, '{c.CURRENCY_PATTERN}'), false) then 'currency' end,
      case when not v_ok then 'version' end) as invalid_all
  from g),
k as (select *, error_kind is null and invalid_all = '' as valid from h)
select ref, valid, error_kind, error_field,
  case when error_kind is null then invalid_all end as invalid_fields,
  case when valid then {txt('event_id')} end as event_id,
  case when valid then {txt('order_id')} end as order_id,
  case when valid then {txt('customer_id')} end as customer_id,
  case when valid then etype end as event_type,
  case when valid then strftime(timezone('UTC', cast(regexp_replace(ttext, '[zZ]$', '+00:00') as timestamptz)),
                                '%Y-%m-%d %H:%M:%S.%f') end as event_time,
  case when valid then atext end as amount,
  case when valid then cur end as currency,
  case when valid then cast(json_extract(s, '$.version') as bigint) end as version,
  case when valid then coalesce((
    select '{{' || string_agg(cast(to_json(kk) as varchar) || ':' || cast(val as varchar), ',' order by kk) || '}}' from (
      select kk, json_extract(s, '$."' || kk || '"') as val from unnest(json_keys(s)) as t(kk)
       where kk not in ({known})
      union all
      select kk, json_extract(s, '$.extra_fields."' || kk || '"') as val
        from unnest(coalesce(json_keys(s, '$.extra_fields'), [])) as t(kk)
       where not (list_contains(json_keys(s), kk) and kk not in ({known})))), '{{}}') end as extras
from k"""


from ..functions.timeutil import ZONED_ISO as ZONED  # noqa: E402


@register("order_event_contract", _oe_sql())
def q_order_event_contract(spark, sf):
    """V1-V3: parse, validate and record every order event (one per order)."""
    from ..functions.contracts import check_order_events
    from ..sources.events import order_events
    return check_order_events(order_events(spark, sf)).select("ref", "c.*")


def _payment_sql(body_cols: str, tail: str = "") -> str:
    from ..functions import contracts as c
    from ..sources.events import PAGE_ROWS, payment_text

    def txt(f):
        return f"(case when json_type(s, '$.{f}') = 'VARCHAR' then json_extract_string(s, '$.{f}') end)"
    return f"""
with pr as (select cast(o_orderkey as varchar) as ref, cast(o_orderkey // {PAGE_ROWS} as bigint) as page_no,
                   {payment_text('duckdb')} as s
            from orders),
f as (select *, {txt('amount')} as atext, {txt('updated_at')} as ttext from pr),
g as (select ref, page_no, s, concat_ws(',',
    case when coalesce(trim({txt('payment_id')}) = '', true) then 'payment_id' end,
    case when coalesce(trim({txt('order_id')}) = '', true) then 'order_id' end,
    case when not coalesce(json_type(s, '$.version') in ('BIGINT', 'UBIGINT')
                           and cast(json_extract(s, '$.version') as bigint) >= 1, false) then 'version' end,
    case when not coalesce(regexp_matches(atext, '{c.NUMBER_TEXT}')
                           and try_cast(atext as decimal(38,10)) >= 0, false) then 'amount' end,
    case when not coalesce({txt('currency')} = 'IDR', false) then 'currency' end,
    case when not coalesce({txt('status')} = 'succeeded', false) then 'status' end,
    case when not coalesce(regexp_matches(ttext, '{ZONED}')
         and try_cast(regexp_replace(ttext, '[zZ]$', '+00:00') as timestamptz) is not null, false)
         then 'updated_at' end) as invalid_fields from f)
select {body_cols} from g {tail}"""


@register("payment_contract", _payment_sql(
    "ref, page_no, invalid_fields, invalid_fields = '' as valid, "
    "bool_or(invalid_fields <> '') over (partition by page_no) as page_rejected"))
def q_payment_contract(spark, sf):
    """V4: every payment record checked; one bad record rejects its page."""
    from pyspark.sql import Window
    from ..functions.contracts import check_payments
    from ..sources.events import payment_records
    recs = check_payments(payment_records(spark, sf))
    out = recs.select("ref", "page_no", F.array_join("invalid_fields", ",").alias("invalid_fields"))
    out = out.withColumn("valid", F.col("invalid_fields") == "")
    # a page is bounded (PAGE_ROWS records), so this window never holds a large group
    return out.withColumn("page_rejected", F.max(~F.col("valid")).over(Window.partitionBy("page_no")))


@register("click_contract", _sql(("d_clicks",), [], """
select event_id, customer_id, event_type,
  concat_ws(',', case when event_type not in ('page_view', 'add_to_cart', 'checkout') then 'event_type' end)
    as invalid_fields
from d_clicks"""))
def q_click_contract(spark, sf):
    """V5: click events; signup and error types fail the type rule."""
    from ..functions.contracts import click_errors
    c = d.clicks(spark, sf)
    return c.select("event_id", "customer_id", "event_type",
                    F.array_join(click_errors(c), ",").alias("invalid_fields"))


@register("feed_pages_explode", f"""
with pr as (select cast(o_orderkey as varchar) as ref, cast(o_orderkey // 100 as bigint) as page_no
            from orders),
pg as (select distinct page_no from pr)
select 'p' || cast(pr.page_no as varchar) as page_id,
  case when n.page_no is not null then 'p' || cast(pr.page_no + 1 as varchar) end as next_cursor,
  cast(count(*) over (partition by pr.page_no) as bigint) as page_rows, pr.ref as payment_ref
from pr left join pg n on n.page_no = pr.page_no + 1""")
def q_feed_pages_explode(spark, sf):
    """S3: landed pages validated (shape, repeated cursor) and exploded."""
    from ..sources import feed
    from ..sources.events import payment_pages
    parsed = feed.parse_pages(payment_pages(spark, sf))
    recs = feed.explode_records(parsed)
    counts = parsed.select("page_id", F.size(F.try_variant_get(F.col("_v"), "$.data", "array<variant>"))
                           .cast("bigint").alias("page_rows"))
    ref = F.try_variant_get(F.col("record"), "$.order_id", "string")
    return recs.join(counts, on="page_id").select("page_id", "next_cursor", "page_rows",
                                                  ref.alias("payment_ref"))


_FEED_PAGES = 8   # pages of one of the many small feeds below


def linked_pages(spark, sf):
    """Many feeds of pages (order key ranges), chained by cursor; by number of the feed mod 4: whole; page 3
    never landed; the last page's cursor leads back to page 2; page 4 ends the walk and the rest is detached."""
    from ..sources.tables import read_table
    page = F.floor(F.col("o_orderkey") / 20)
    pages = read_table(spark, sf, "orders").select((page % _FEED_PAGES).alias("no"), F.floor(page / _FEED_PAGES).alias("feed")).distinct()
    no, kind = F.col("no"), F.col("feed") % 4
    cursor = (F.when((kind == 2) & (no == _FEED_PAGES - 1), F.lit("p2")).when((kind == 3) & (no == 4), F.lit(None))
               .when(no < _FEED_PAGES - 1, F.concat(F.lit("p"), (no + 1).cast("string"))))
    return pages.where(~((kind == 1) & (no == 3))).select(
        "feed", F.concat(F.lit("p"), no.cast("string")).alias("page_id"), no.alias("page_seq"), cursor.alias("next_cursor"))


@register("feed_walk", f"""
with recursive pg as (select distinct (o_orderkey // 20) % {_FEED_PAGES} as no, (o_orderkey // 20) // {_FEED_PAGES} as feed from orders),
links as (select feed, 'p' || cast(no as varchar) as page_id, no,
    case when feed % 4 = 2 and no = {_FEED_PAGES - 1} then 'p2' when feed % 4 = 3 and no = 4 then null
         when no < {_FEED_PAGES - 1} then 'p' || cast(no + 1 as varchar) end as next_cursor
  from pg where not (feed % 4 = 1 and no = 3)),
w as (select feed, page_id, next_cursor, 0 as position, [page_id] as seen from links l
      where no = (select min(no) from links f where f.feed = l.feed)
  union all
  select l.feed, l.page_id, l.next_cursor, w.position + 1, list_append(w.seen, l.page_id)
  from w join links l on l.feed = w.feed and l.page_id = w.next_cursor where not list_contains(w.seen, l.page_id)),
e as (select w.feed, case when w.next_cursor is null then 'complete' when list_contains(w.seen, w.next_cursor) then 'repeated_cursor'
        else 'missing_page' end as outcome from w where w.position = (select max(position) from w x where x.feed = w.feed))
select cast(feed as bigint) as feed, page_id, cast(position as bigint) as position, outcome from w join e using (feed)""")
def q_feed_walk(spark, sf):
    """S3: the pages that each feed's walk from its first page comes to, and how
    the walk ends: whole feeds, gaps, loops and detached pages."""
    from ..sources import feed
    return feed.walk(linked_pages(spark, sf))


# Scalars: canonical text and hash, JSON extraction -----------------------------
ORDER_PAYLOAD_COLUMNS = ["order_id", "customer_id", "status", "amount", "currency", "version",
                         "created_at", "updated_at"]
_ISO_SQL = "strftime({}, '%Y-%m-%dT%H:%M:%S.%f+00:00')"
ORDER_PAYLOAD_SQL = f"""cast(json_object('amount', cast(amount as varchar),
  'created_at', {_ISO_SQL.format('created_at')}, 'currency', currency, 'customer_id', customer_id,
  'order_id', order_id, 'status', status, 'updated_at', {_ISO_SQL.format('updated_at')},
  'version', version) as varchar)"""


@register("canonical_hash", _sql(("d_order_versions",), [], f"""
select order_id, cast(version as bigint) as version, payload, sha256(payload) as payload_hash
from (select *, {ORDER_PAYLOAD_SQL} as payload from d_order_versions)"""))
def q_canonical_hash(spark, sf):
    """Canonical JSON text and SHA-256 of every order version."""
    from ..functions.canonical import canonical_json, payload_hash
    ov = d.order_versions(spark, sf)
    payload = canonical_json(ov, ORDER_PAYLOAD_COLUMNS)
    return ov.select("order_id", "version", payload.alias("payload")) \
             .withColumn("payload_hash", payload_hash(F.col("payload")))


#: A payload per event with nested objects, unsorted and repeated keys, white space and numbers in several
#: spellings; every 50th event holds what JSON does not allow.
FREE_JSON_SQL = """concat('{"z": ', props, ', "é" : "', event_type, '", "a": 0, "a": {"n": [1.0, ', value, ', 1e3, -0.50, ',
  event_id, '000000000000000000],  "B": {"y": null, "x": true}, "b": ', case when event_id % 50 = 0 then 'NaN' else '{}' end, '}}')"""


@register("canonical_free_json", """
select event_id, payload, sha256(payload) as payload_hash
from (select cast(event_id as bigint) as event_id, case when event_id % 50 <> 0 then
    concat('{"a":{"B":{"x":true,"y":null},"b":{},"n":[1.0,', value, ',1000.0,-0.5,',
           case when event_id > 0 then concat(event_id, repeat('0', 18)) else '0' end,
           ']},"z":{"k":', json_extract_string(props, '$.k'), '},"é":"', event_type, '"}') end as payload
  from events)""")
def q_canonical_free_json(spark, sf):
    """Canonical text and hash of free JSON of every event."""
    from ..functions.canonical import canonical_free_json, payload_hash
    from ..sources.tables import read_table
    e = read_table(spark, sf, "events").select("event_id", F.expr(FREE_JSON_SQL).alias("raw"))
    e = e.select(F.col("event_id").cast("long").alias("event_id"), canonical_free_json("raw").alias("payload"))
    return e.withColumn("payload_hash", payload_hash(F.col("payload")))


@register("json_typed_extract", """
select cast(event_id as varchar) as event_id, cast(json_extract_string(props, '$.k') as bigint) as k,
  cast(cast(cast(cast(cast(value as decimal(18,2)) * 0.125 as decimal(18,5)) as varchar) as decimal(18,2))
       as double) as amount,
  strftime(ts - interval 7 hour, '%Y-%m-%d %H:%M:%S.%f') as paid_at
from events""")
def q_json_typed_extract(spark, sf):
    """A field out of JSON text, decimal text rounded half away
    from zero to DECIMAL(18,2), and zoned ISO text to an instant."""
    from ..functions.timeutil import parse_zoned
    from ..sources.tables import read_table
    e = read_table(spark, sf, "events").select("event_id", "ts", "value", "props")
    amount_text = (F.col("value").cast("decimal(18,2)") * F.lit(0.125).cast("decimal(4,3)")) \
        .cast("decimal(18,5)").cast("string")
    time_text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+07:00"))
    return e.select(F.col("event_id").cast("string").alias("event_id"),
                    F.variant_get(F.parse_json("props"), "$.k", "bigint").alias("k"),
                    amount_text.cast("decimal(18,2)").alias("amount"),
                    parse_zoned(time_text).alias("paid_at"))


@register("table_constraints", """
select 'quantity_positive' as constraint_name,
  cast(count(*) filter (where not coalesce(l_quantity > 0, true)) as bigint) as violations from lineitem
union all select 'discount_range', cast(count(*) filter (where not coalesce(l_discount between 0 and 1, true)) as bigint) from lineitem
union all select 'price_not_negative', cast(count(*) filter (where not coalesce(l_extendedprice >= 0, true)) as bigint) from lineitem
union all select 'orderkey_not_null', cast(count(*) filter (where l_orderkey is null) as bigint) from lineitem
union all select 'lineitem_pk', cast(count(*) as bigint) from (select l_orderkey, l_linenumber from lineitem
  where l_orderkey is not null and l_linenumber is not null group by all having count(*) > 1)
union all select 'lineitem_order_fk', cast(count(*) as bigint) from lineitem l
  where l_orderkey is not null and not exists (select 1 from orders o where o.o_orderkey = l.l_orderkey)
union all select 'lineitem_part_fk', cast(count(*) as bigint) from lineitem l
  where l_partkey is not null and not exists (select 1 from part p where p.p_partkey = l.l_partkey)
union all select 'lineitem_supplier_fk', cast(count(*) as bigint) from lineitem l
  where l_suppkey is not null and not exists (select 1 from supplier s where s.s_suppkey = l.l_suppkey)""")
def q_table_constraints(spark, sf):
    """V6 / V7: declared constraints of a table checked in one plan (row rules
    in one aggregate pass; key and foreign-key rules as grouped/anti joins)."""
    from ..operators.checks import Constraint, check_constraints
    from ..sources.tables import read_table
    li = read_table(spark, sf, "lineitem")
    rules = [
        Constraint("quantity_positive", "check", predicate="l_quantity > 0"),
        Constraint("discount_range", "check", predicate="l_discount between 0 and 1"),
        Constraint("price_not_negative", "check", predicate="l_extendedprice >= 0"),
        Constraint("orderkey_not_null", "not_null", ("l_orderkey",)),
        Constraint("lineitem_pk", "unique", ("l_orderkey", "l_linenumber")),
        Constraint("lineitem_order_fk", "foreign_key", ("l_orderkey",), parent="orders",
                   parent_columns=("o_orderkey",)),
        Constraint("lineitem_part_fk", "foreign_key", ("l_partkey",), parent="part",
                   parent_columns=("p_partkey",)),
        Constraint("lineitem_supplier_fk", "foreign_key", ("l_suppkey",), parent="supplier",
                   parent_columns=("s_suppkey",)),
    ]
    parents = {t: read_table(spark, sf, t) for t in ("orders", "part", "supplier")}
    return check_constraints(li, rules, parents)


# Stateful ingestion over a lake in the shared folder -----------------------------

from pyspark.sql import Window as _W  # noqa: E402

INITIAL = datetime(1990, 1, 1, tzinfo=timezone.utc)
CUTOFF_1 = datetime(1998, 1, 1, tzinfo=timezone.utc)
CUTOFF_2 = datetime(2100, 1, 1, tzinfo=timezone.utc)
BACKFILL = (datetime(1997, 6, 1, tzinfo=timezone.utc), datetime(1999, 1, 1, tzinfo=timezone.utc))


def fresh_lake(spark, name: str):
    from ..sources.lake import Lake
    return Lake(spark, f"{_session.shared_dir(spark)}/tidemark-lakes/{name}-{_uuid.uuid4().hex}")


def changed_orders(spark, sf):
    """A re-read of the source where every 15th order changed its amount
    without a new version (a same-version conflict)."""
    ov = d.order_versions(spark, sf)
    return ov.withColumn("amount", F.when(F.col("order_id").cast("bigint") % 15 == 0,
                                          (F.col("amount") + 1).cast("decimal(18,2)"))
                         .otherwise(F.col("amount")))


def _run_seq(lake):
    """Landed rows with the order number of the run that first saw them."""
    from .ingest import landed_orders, latest_runs
    runs = latest_runs(lake).select(F.col("run_id").alias("first_seen_run_id"), "started_at")
    # the run ledger holds one row per run: a tiny, bounded window
    runs = runs.withColumn("first_seen_run", F.row_number().over(_W.orderBy("started_at")))
    return landed_orders(lake).join(runs, on="first_seen_run_id", how="left")


_HASHED_SQL = f"""hashed as (select *, sha256({ORDER_PAYLOAD_SQL}) as payload_hash from d_order_versions)"""


@register("incremental_run", _sql(("d_order_versions",), [_HASHED_SQL], """
select order_id, cast(version as bigint) as version, payload_hash,
  cast(case when updated_at < timestamp '1998-01-01 00:00:00' then 1 else 2 end as bigint) as first_seen_run
from hashed where updated_at >= timestamp '1990-01-01 00:00:00'
  and updated_at < timestamp '2100-01-01 00:00:00'"""))
def q_incremental_run(spark, sf):
    """Two scheduled runs (cutoffs 1998 and 2100, 15 min
    lookback); every version lands once, in the first run that saw it."""
    from .ingest import OrderIngestion
    lake = fresh_lake(spark, "incremental")
    ing = OrderIngestion(lake, d.order_versions(spark, sf), initial_start=INITIAL)
    ing.run(CUTOFF_1)
    ing.run(CUTOFF_2)
    return _run_seq(lake).select("order_id", "version", "payload_hash", "first_seen_run")


@register("backfill_run", _sql(("d_order_versions",), [_HASHED_SQL], """
select order_id, cast(version as bigint) as version,
  cast(case when updated_at < timestamp '1998-01-01 00:00:00' then 1 else 2 end as bigint) as first_seen_run,
  '1998-01-01 00:00:00.000000' as checkpoint
from hashed where updated_at < timestamp '1999-01-01 00:00:00'"""))
def q_backfill_run(spark, sf):
    """A backfill over [1997-06-01, 1999-01-01) after a run to 1998 lands
    only the unseen versions and leaves the checkpoint at 1998-01-01."""
    from .ingest import OrderIngestion
    lake = fresh_lake(spark, "backfill")
    ing = OrderIngestion(lake, d.order_versions(spark, sf), initial_start=INITIAL)
    ing.run(CUTOFF_1)
    ing.backfill(*BACKFILL)
    cp = lake.read("checkpoints", schemas.CHECKPOINTS).agg(F.max("last_completed_window_end"))
    return _run_seq(lake).select("order_id", "version", "first_seen_run",
                                 cp.scalar().alias("checkpoint"))


@register("conflict_ledger", _sql(("d_order_versions",), [
    _HASHED_SQL,
    f"""changed as (select order_id, version, sha256({ORDER_PAYLOAD_SQL.replace(
        "cast(amount as varchar)", "cast(cast(amount + 1 as decimal(18,2)) as varchar)")}) as new_hash
      from d_order_versions where cast(order_id as bigint) % 15 = 0)"""], """
select h.order_id, cast(h.version as bigint) as version, h.payload_hash as existing_payload_hash,
  c.new_hash as incoming_payload_hash, 'same_version_different_payload' as reason_code
from hashed h join changed c on h.order_id = c.order_id and h.version = c.version"""))
def q_conflict_ledger(spark, sf):
    """A re-read that changes landed versions is refused; the ledger keeps
    both hashes (no payload) and nothing else is published."""
    from .ingest import OrderIngestion
    lake = fresh_lake(spark, "conflict")
    OrderIngestion(lake, d.order_versions(spark, sf), initial_start=INITIAL).run(CUTOFF_2)
    try:
        OrderIngestion(lake, changed_orders(spark, sf), initial_start=INITIAL).backfill(INITIAL, CUTOFF_2)
        raise AssertionError("conflict not detected")
    except ValueError as exc:
        if str(exc) != "order_version_payload_conflict":
            raise
    return lake.read("order_conflicts", schemas.ORDER_CONFLICTS).select(
        "order_id", "version", "existing_payload_hash", "incoming_payload_hash", "reason_code")


@register("classify_batch", _sql(("d_order_versions",), [
    _HASHED_SQL,
    f"""reread as (
  select order_id, version, sha256({ORDER_PAYLOAD_SQL.replace("cast(amount as varchar)",
      "cast(cast(case when cast(order_id as bigint) % 15 = 0 then amount + 1 else amount end as decimal(18,2)) as varchar)")})
    as payload_hash from d_order_versions
  union all
  select order_id, cast(4 as bigint), sha256(order_id || '-v4') from d_order_versions
  where cast(order_id as bigint) % 20 = 0 and version = 1)"""], """
select r.order_id, cast(r.version as bigint) as version,
  case when h.order_id is null then 'new' when h.payload_hash <> r.payload_hash then 'conflict'
       else 'duplicate' end as status
from reread r left join hashed h on r.order_id = h.order_id and r.version = h.version"""))
def q_classify_batch(spark, sf):
    """A full re-read of the source against the landed log --
    unchanged versions are duplicates, every 15th order changed its amount
    (conflicts), and every 20th order gained a version 4 (new)."""
    from ..functions.canonical import canonical_json, payload_hash
    from ..operators.versions import classify

    def hashed(df):
        return df.select("order_id", "version",
                         payload_hash(canonical_json(df, ORDER_PAYLOAD_COLUMNS)).alias("payload_hash"))
    landed = hashed(d.order_versions(spark, sf))
    v4 = (d.order_versions(spark, sf)
          .where((F.col("order_id").cast("bigint") % 20 == 0) & (F.col("version") == 1))
          .select("order_id", F.lit(4).cast("bigint").alias("version"),
                  F.sha2(F.concat("order_id", F.lit("-v4")), 256).alias("payload_hash")))
    batch = hashed(changed_orders(spark, sf)).unionByName(v4)
    return classify(batch, landed, ["order_id", "version"]).select("order_id", "version", "status")


@register("payment_upsert", _payment_sql(
    "ref as payment_id, 'p' || cast(page_no as varchar) as page_id, sha256(s) as payload_hash",
    "qualify bool_and(invalid_fields = '') over (partition by page_no)"))
def q_payment_upsert(spark, sf):
    """I7 (quarantine mode): every clean page lands whole; a page with one bad
    record lands nothing.  A replay of the same pages inserts nothing."""
    from ..sources.events import payment_pages
    from .ingest import PaymentIngestion, landed_payments
    lake = fresh_lake(spark, "payments")
    pages = payment_pages(spark, sf).withColumn("page_seq", F.substring("page_id", 2, 20).cast("bigint"))
    ing = PaymentIngestion(lake, on_bad="quarantine")
    ing.run(pages)
    again = ing.run(pages)
    if again["payments_inserted"] != 0:
        raise AssertionError("replay inserted rows")
    return landed_payments(lake).select("payment_id", "page_id", "payload_hash")


@register("landed_payments_staging", _payment_sql(f"""ref as payment_id, ref as order_id, cast(1 as bigint) as version,
  cast(json_extract_string(s, '$.amount') as double) as amount, json_extract_string(s, '$.currency') as currency,
  json_extract_string(s, '$.status') as status, {TS.format(
    "cast(replace(json_extract_string(s, '$.updated_at'), '+07:00', '') as timestamp) - interval 7 hour")} as paid_at""",
    "qualify bool_and(invalid_fields = '') over (partition by page_no)"))
def q_landed_payments_staging(spark, sf):
    """Payments staged from the landed payloads of the clean pages."""
    from ..sources.events import payment_pages
    from .ingest import PaymentIngestion, landed_payments
    lake = fresh_lake(spark, "staging")
    pages = payment_pages(spark, sf).withColumn("page_seq", F.substring("page_id", 2, 20).cast("bigint"))
    PaymentIngestion(lake, on_bad="quarantine").run(pages)
    return wh.stg_landed_payments(landed_payments(lake))


@register("landed_orders_staging", ORACLE_SQL["latest_orders"])
def q_landed_orders_staging(spark, sf):
    """Orders staged from the landed payloads."""
    from .ingest import OrderIngestion, landed_orders
    lake = fresh_lake(spark, "staging")
    OrderIngestion(lake, d.order_versions(spark, sf), initial_start=INITIAL).run(CUTOFF_2)
    return wh.stg_landed_orders(landed_orders(lake))


# Streaming, snapshots, health ------------------------------------------------------
CLICK_DRAIN = 600   # records of the first, bounded drain


def click_log(spark, sf):
    """Topic records of the click events: partition = customer mod 3, in the
    order of event ids; replays are every 10th event, same payload."""
    from ..functions.timeutil import iso_utc
    c = d.clicks(spark, sf)
    value = F.to_json(F.struct("customer_id", "event_id", iso_utc("event_time").alias("event_time"), "event_type"))
    base = c.select(F.col("customer_id").alias("key"), value.alias("value"),
                    (F.col("customer_id").cast("bigint") % 3).cast("int").alias("partition"),
                    F.col("event_id").cast("bigint").alias("offset"),
                    F.col("event_time").alias("timestamp"), "event_id")
    return base, base.where(F.col("offset") % 10 == 0)


_CLICK_PAYLOAD_SQL = """cast(json_object('customer_id', customer_id, 'event_id', event_id,
  'event_time', strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f+00:00'), 'event_type', event_type) as varchar)"""


@register("stream_ingest", _sql(("d_clicks",), [], f"""
select event_id, sha256({_CLICK_PAYLOAD_SQL}) as payload_hash, 'tidemark.clickstream' as topic,
  cast(cast(customer_id as bigint) % 3 as bigint) as kafka_partition, kafka_offset
from (select *, cast(row_number() over (partition by cast(customer_id as bigint) % 3
        order by cast(event_id as bigint)) - 1 as bigint) as kafka_offset from d_clicks)
where event_type in ('page_view', 'add_to_cart', 'checkout')"""))
def q_stream_ingest(spark, sf):
    """Publish the click log (then its replays) to a topic, drain
    it with Structured Streaming into the lake (quarantine mode for the invalid
    types): a bounded drain of the first records, then the rest; each event lands
    once, from its first delivery, with the offset the topic gave it."""
    from ..streaming import clicks as st
    lake = fresh_lake(spark, "clicks")
    topic = f"{lake.root}/_topic"
    base, replays = click_log(spark, sf)
    sent = st.publish(base, {"topic_path": topic}) + st.publish(replays, {"topic_path": topic})
    drains = [st.consume(spark, lake, {"topic_path": topic}, f"{lake.root}/_stream_ckpt", on_bad="quarantine", **bound)
              for bound in ({"max_messages": CLICK_DRAIN}, {})]
    counters = {k: sum(c[k] for c in drains) for k in drains[0]}
    if drains[0]["received"] != min(sent, CLICK_DRAIN) or counters["received"] != sent:
        raise AssertionError(f"the drains did not stop at their bounds: {drains}")
    if counters["inserted"] + counters["duplicates"] + counters["quarantined"] != counters["received"]:
        raise AssertionError(f"stream counters do not add up: {counters}")
    return st.landed_clicks(lake).select("event_id", "payload_hash", "topic", "kafka_partition",
                                        "kafka_offset")


def _snapshot_lake(spark, sf):
    from ..sources import snapshot as snap
    from .ingest import OrderIngestion
    lake = fresh_lake(spark, "snapshot")
    OrderIngestion(lake, d.order_versions(spark, sf), initial_start=INITIAL).run(CUTOFF_2)
    root = f"{lake.root}/_snapshots"
    snap.export_snapshot(lake, root)
    return lake, root


@register("snapshot_roundtrip", _sql(("d_order_versions",), [], f"""
select order_id, cast(version as bigint) as version, customer_id, status, cast(amount as double) as amount,
  currency, {TS.format('created_at')} as created_at, {TS.format('updated_at')} as updated_at,
  cast({JKT.format('created_at')} as varchar) as event_date
from d_order_versions"""))
def q_snapshot_roundtrip(spark, sf):
    """Every landed version exported by business date, verified
    (ids, paths, sizes, digests, row counts) and read back."""
    from ..sources import snapshot as snap
    _, root = _snapshot_lake(spark, sf)
    directory, _ = snap.load_snapshot(spark, root)
    return snap.read_snapshot_table(spark, directory, "orders")


@register("derived_mart", ORACLE_SQL["daily_orders"])
def q_derived_mart(spark, sf):
    """The reference's Spark job over a verified snapshot, published
    once as data + report, then read back."""
    from ..sources import snapshot as snap
    _, root = _snapshot_lake(spark, sf)
    report = snap.build_spark_mart(spark, root)
    return spark.read.parquet(f"{report['path']}/data")


def _health_lake(spark, sf):
    """Control state: a run to 2100, a failed quality gate, then a refused
    backfill (a failed latest run)."""
    from .ingest import OrderIngestion, latest_runs
    from .quality_runner import run_gates
    lake = fresh_lake(spark, "health")
    OrderIngestion(lake, d.order_versions(spark, sf), initial_start=INITIAL).run(CUTOFF_2)
    fp, fr = fct_payments(spark, sf), fct_refunds(spark, sf)
    try:
        run_gates(lake, quality.gate_values(fct_orders(spark, sf), fp, fr, marts.daily_finance(fp, fr)))
    except ValueError:
        pass
    try:
        OrderIngestion(lake, changed_orders(spark, sf), initial_start=INITIAL).backfill(INITIAL, CUTOFF_2)
    except ValueError:
        pass
    done = (latest_runs(lake).where(F.col("status") == "succeeded")
            .agg(F.max("completed_at")).first()[0])
    return lake, done.replace(tzinfo=timezone.utc)


_HEALTH_SQL = _sql(("d_order_versions",), [], """
select false as healthy, 'latest_ingestion_failed,missing_or_failed_quality' as reasons,
  cast(0.0 as double) as last_success_age_seconds, false as quality_passed, true as latest_ingestion_failed,
  cast(count(*) as bigint) as raw_orders, cast(0 as bigint) as raw_payments, cast(0 as bigint) as clickstream,
  cast(1 as bigint) as failed_runs, cast(0 as bigint) as running_runs, cast(0 as bigint) as stale_runs
from d_order_versions""")


@register("health_report", _HEALTH_SQL)
def q_health_report(spark, sf):
    """Health of the lake, evaluated at the moment the
    last successful run completed (so its age is 0)."""
    from .health import health_report
    lake, now = _health_lake(spark, sf)
    h = health_report(lake, now=now)
    return h.withColumn("reasons", F.array_join("reasons", ","))


@register("metric_rows", _sql(("d_order_versions",), [], """
select * from (values ('tidemark_ok', 'pipeline', 0::double), ('tidemark_ok', 'quality', 0), ('tidemark_ok', 'last_run', 0),
  ('tidemark_seconds_since_success', 'orders', 0), ('tidemark_landed_rows', 'clicks', 0), ('tidemark_landed_rows', 'payments', 0),
  ('tidemark_runs', 'failed', 1), ('tidemark_runs', 'open', 0), ('tidemark_runs', 'stuck', 0)) v(metric, part, value)
union all select 'tidemark_landed_rows', 'orders', cast(count(*) as double) from d_order_versions"""))
def q_metric_rows(spark, sf):
    """H2: the health row as ten (metric, part, value) gauges."""
    from .health import health_report, metric_rows
    lake, now = _health_lake(spark, sf)
    return metric_rows(health_report(lake, now=now))


def error_minutes(spark, sf):
    """A metric history made from the events: per minute that has events, the
    number of ``error`` events (the series of one gauge)."""
    from ..functions.timeutil import as_utc_instant
    from ..sources.tables import read_table
    e = read_table(spark, sf, "events").select(F.date_trunc("minute", as_utc_instant("ts")).alias("ts"),
                                               "event_type")
    return (e.groupBy("ts").agg(F.count_if(F.col("event_type") == "error").cast("double").alias("value"))
             .select(F.lit("error_events").alias("metric"), "ts", "value"))


@register("alert_hold", """
with s as (select 'error_events' as metric, date_trunc('minute', ts) as ts,
             cast(count(*) filter (where event_type = 'error') as double) as value
           from events group by all),
c as (select *, value > 0 as cond, lag(value > 0) over (order by ts) as prev from s),
i as (select *, case when cond then max(case when cond and not coalesce(prev, false) then ts end)
        over (order by ts rows between unbounded preceding and current row) end as island_start from c)
select 'ErrorEventsPersist' as alert, metric, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as ts, value, cond,
  coalesce(cond and epoch(ts) - epoch(island_start) >= 120, false) as firing
from i""")
def q_alert_hold(spark, sf):
    """H3: an alert with a 2-minute hold over a per-minute gauge from events."""
    from datetime import timedelta
    from .health import alert_states
    rule = (("ErrorEventsPersist", "error_events", "value > 0", timedelta(minutes=2)),)
    return alert_states(error_minutes(spark, sf), rule)


@register("summary", _sql(("d_payments", "d_refunds", "d_clicks"), [FCT_PAYMENTS_SQL, FCT_REFUNDS_SQL,
                                                                    DAILY_FINANCE_SQL], f"""
select 'finance' as section, cast(date_day as varchar) as date_day, currency as label,
  cast(revenue as double) as revenue, cast(refund as double) as refund, cast(net as double) as net,
  cast(null as bigint) as event_count, cast(null as bigint) as unique_customers from daily_finance
union all
select 'clickstream', cast({JKT.format('event_time')} as varchar), event_type, null, null, null,
  cast(count(*) as bigint), cast(count(distinct customer_id) as bigint)
from d_clicks where event_type in ('page_view', 'add_to_cart', 'checkout') group by all"""))
def q_summary(spark, sf):
    """The run summary -- finance by date, clickstream by date
    and type, all columns of both marts -- as one ordered report."""
    from ..functions.contracts import click_errors
    fin = daily_finance_frame(spark, sf).select(
        F.lit("finance").alias("section"), "date_day", F.col("currency").alias("label"), "revenue", "refund", "net")
    c = d.clicks(spark, sf)
    clk = marts.daily_clickstream(c.where(F.size(click_errors(c)) == 0)).select(
        F.lit("clickstream").alias("section"), "date_day", F.col("event_type").alias("label"),
        "event_count", "unique_customers")
    return fin.unionByName(clk, allowMissingColumns=True).orderBy("section", "date_day", "label")


@register("warehouse_build", _sql(("d_order_versions", "d_customer_history", "d_payments", "d_refunds",
                                   "d_items", "d_products", "d_clicks"),
                                  [STG_ORDERS_SQL, DIM_CUSTOMER_SQL, FCT_ORDERS_SQL, FCT_PAYMENTS_SQL,
                                   FCT_REFUNDS_SQL, FCT_ITEMS_SQL, DAILY_FINANCE_SQL], f"""
select 'dim_customer' as model, cast(count(*) as bigint) as row_count from dim_customer
union all select 'dim_product', count(*) from d_products
union all select 'fct_orders', count(*) from fct_orders
union all select 'fct_order_items', count(*) from fct_order_items
union all select 'fct_payments', count(*) from fct_payments
union all select 'fct_refunds', count(*) from fct_refunds
union all select 'daily_finance', count(*) from daily_finance
union all select 'daily_clickstream', count(*) from (select distinct {JKT.format('event_time')}, event_type
  from d_clicks where event_type in ('page_view', 'add_to_cart', 'checkout'))
union all select 'orders_by_city_membership', count(*) from (select distinct o.order_date, c.city, c.membership,
  o.currency from fct_orders o join dim_customer c using (customer_sk) where o.status <> 'cancelled')
union all select 'dim_date', 61"""))
def q_warehouse_build(spark, sf):
    """Every model built in reference order; table models written once
    and read back by their dependants; rows per table model."""
    from . import models
    built, _ = built_models(spark, sf)
    counts = [f.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("model"), "row_count")
              for n, f in built.items() if models.MODELS.get(n, ("table",))[0] == "table"]
    out = counts[0]
    for x in counts[1:]:
        out = out.unionByName(x)
    return out
