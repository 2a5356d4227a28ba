"""Golden results on the reference's bundled fixtures (marts, gates, tests)."""

from decimal import Decimal

from pyspark.sql import functions as F

from fixtures import (CLICKS, HISTORY, HISTORY_SCHEMA, ITEM_SCHEMA, ITEMS, ORDER_SCHEMA, ORDERS,
                      PAYMENT_SCHEMA, PAYMENTS, PRODUCT_SCHEMA, PRODUCTS, REFUND_SCHEMA, REFUNDS, frame)
from tidemark.functions.timeutil import calendar
from tidemark.plans import marts, quality
from tidemark.plans import warehouse as wh


def build(spark):
    orders = frame(spark, ORDERS, ORDER_SCHEMA)
    dim = wh.dim_customer(frame(spark, HISTORY, HISTORY_SCHEMA))
    fo = wh.fct_orders(wh.stg_orders(orders), dim)
    prod = wh.dim_product(frame(spark, PRODUCTS, PRODUCT_SCHEMA))
    items = wh.fct_order_items(frame(spark, ITEMS, ITEM_SCHEMA), fo, prod)
    fp = wh.fct_payments(wh.stg_payments(frame(spark, PAYMENTS, PAYMENT_SCHEMA)))
    fr = wh.fct_refunds(frame(spark, REFUNDS, REFUND_SCHEMA))
    return orders, dim, fo, prod, items, fp, fr


def rows(df, *cols):
    return sorted(tuple(str(r[c]) for c in cols) for r in df.collect())


def test_daily_orders(spark):
    orders = frame(spark, ORDERS, ORDER_SCHEMA)
    out = marts.daily_orders(marts.with_order_date(orders))
    assert rows(out, "event_date", "currency", "order_count", "order_value") == [
        ("2026-09-27", "IDR", "3", "464000.00"), ("2026-09-28", "IDR", "4", "881000.00")]


def test_dedup_before_filter_and_exact_decimals(spark):
    data = [("o-1", 1, "paid", Decimal("10.10"), "IDR", "2026-09-28", "2026-09-28 01:00:00"),
            ("o-1", 2, "cancelled", Decimal("10.10"), "IDR", "2026-09-28", "2026-09-28 02:00:00"),
            ("o-2", 1, "paid", Decimal("10.10"), "IDR", "2026-09-28", "2026-09-28 01:00:00"),
            ("o-2", 2, "paid", Decimal("21.20"), "IDR", "2026-09-28", "2026-09-28 03:00:00")]
    df = spark.createDataFrame(data, "order_id string, version bigint, status string, amount decimal(18,2), "
                                     "currency string, event_date string, updated_at string") \
        .withColumn("event_date", F.to_date("event_date")).withColumn("updated_at", F.to_timestamp("updated_at"))
    out = marts.daily_orders(df).collect()
    assert len(out) == 1 and out[0]["order_count"] == 1 and out[0]["order_value"] == Decimal("21.20")


def test_empty_input(spark):
    df = spark.createDataFrame([], "order_id string, version bigint, status string, amount decimal(18,2), "
                                   "currency string, event_date date, updated_at timestamp")
    assert marts.daily_orders(df).count() == 0


def test_daily_finance(spark):
    *_, fp, fr = build(spark)
    out = marts.daily_finance(fp, fr)
    assert rows(out, "date_day", "revenue", "refund", "net") == [
        ("2026-09-28", "1345000.00", "0.00", "1345000.00"), ("2026-09-29", "0.00", "25000.00", "-25000.00")]


def test_daily_clickstream(spark):
    df = spark.createDataFrame(CLICKS).withColumn("event_time", F.to_timestamp("event_time"))
    out = marts.daily_clickstream(df)
    assert rows(out, "date_day", "event_type", "event_count", "unique_customers") == [
        ("2026-10-01", "add_to_cart", "2", "2"), ("2026-10-01", "checkout", "1", "1"),
        ("2026-10-01", "page_view", "3", "3")]


def test_orders_by_city_membership_and_asof(spark):
    _, dim, fo, *_ = build(spark)
    out = marts.orders_by_city_membership(fo, dim)
    assert rows(out, "order_date", "city", "membership", "order_count", "order_amount") == sorted([
        ("2026-09-27", "Jakarta", "silver", "1", "125000.00"), ("2026-09-27", "Surabaya", "silver", "1", "250000.00"),
        ("2026-09-27", "Bandung", "gold", "1", "89000.00"), ("2026-09-28", "Medan", "gold", "1", "310000.00"),
        ("2026-09-28", "Surabaya", "silver", "1", "0.00"), ("2026-09-28", "Bandung", "regular", "1", "499000.00"),
        ("2026-09-28", "Jakarta", "regular", "1", "72000.00")])
    # Q11: ord-1001 keeps Jakarta/silver although the customer moved later
    assert quality.customer_asof_fixture(fo, dim, "ord-1001", "Jakarta", "silver").count() == 0


def test_gates_and_singular_tests(spark):
    _, dim, fo, prod, items, fp, fr = build(spark)
    fin = marts.daily_finance(fp, fr)
    gates = {r["gate"]: r["value"] for r in quality.gate_values(fo, fp, fr, fin).collect()}
    assert gates == {"orders_loaded": 0, "customer_mapping": 0, "orphan_payments": 0,
                     "finance_reconciliation": 0, "negative_payment_amount": 0}
    assert quality.items_reconcile(fo, items).count() == 0
    assert quality.refunds_not_above_paid(fr, fp).count() == 0
    assert quality.finance_reconcile(fp, fr, fin).first()["passed"] is True
    from tidemark.operators.checks import history_overlaps
    assert history_overlaps(frame(spark, HISTORY, HISTORY_SCHEMA)).count() == 0
    tests = quality.generic_tests({"dim_customer": dim, "dim_product": prod, "fct_orders": fo,
                                   "fct_order_items": items, "fct_payments": fp, "fct_refunds": fr,
                                   "dim_date": calendar(spark)})
    assert tests.count() == 20 and tests.where("failures > 0").count() == 0


def test_calendar(spark):
    cal = calendar(spark)
    assert cal.count() == 61
    first = cal.orderBy("date_day").first()
    assert (str(first["date_day"]), first["year"], first["month"], first["day"]) == ("2026-09-01", 2026, 9, 1)


def test_business_date_boundary(spark):
    from tidemark.functions.timeutil import business_date
    r = spark.sql("select timestamp'2026-09-28 17:00:00' as t").select(business_date("t").alias("d")).first()
    assert str(r["d"]) == "2026-09-29"
