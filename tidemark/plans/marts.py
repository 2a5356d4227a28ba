"""Marts (M10-M13) and their aggregates (A1-A4).

Filters (P11): ``status <> 'cancelled'`` after the dedup, ``status = 'succeeded'``
for revenue.

Each mart is a function from DataFrames to a DataFrame; grouping keys are few
(date x currency x ...) so the partial aggregates before the shuffle are
tiny, and nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timeutil import business_date
from ..operators.versions import latest_by

MONEY = "decimal(18,2)"


def daily_orders(order_rows: DataFrame, date_col: str = "event_date") -> DataFrame:
    """Latest version per order, cancelled dropped *after* the dedup,
    then count and value per (business date, currency)."""
    latest = latest_by(order_rows, ["order_id"], ["version", "updated_at"])
    return (latest.where(F.col("status") != "cancelled")
                  .groupBy(date_col, "currency")
                  .agg(F.count(F.lit(1)).alias("order_count"),
                       F.sum("amount").alias("order_value")))


def with_order_date(order_versions: DataFrame) -> DataFrame:
    """Lake orders carry the business date of creation as ``event_date``."""
    return order_versions.withColumn("event_date", business_date("created_at"))


def daily_finance(fct_payments: DataFrame, fct_refunds: DataFrame) -> DataFrame:
    """Succeeded payments as revenue, refunds as refund, per
    (date, currency).  A refund-only day has a negative net."""
    zero = F.lit(0).cast(MONEY)
    revenue = (fct_payments.where(F.col("status") == "succeeded")
               .select(F.col("payment_date").alias("date_day"), "currency",
                       F.col("amount").alias("revenue"), zero.alias("refund")))
    refund = fct_refunds.select(F.col("refund_date").alias("date_day"), "currency",
                                zero.alias("revenue"), F.col("amount").alias("refund"))
    moves = revenue.unionByName(refund)
    return (moves.groupBy("date_day", "currency")
                 .agg(F.sum("revenue").alias("revenue"), F.sum("refund").alias("refund"))
                 .withColumn("net", F.col("revenue") - F.col("refund")))


def daily_clickstream(clicks: DataFrame) -> DataFrame:
    """Events and exact distinct customers per (date, type).

    Distinct count is exact as in the reference; Spark plans it as a two-level
    aggregate (dedupe (date, type, customer) with map-side combine, then count),
    so no group is ever held whole.
    """
    return (clicks.withColumn("date_day", business_date("event_time"))
                  .groupBy("date_day", "event_type")
                  .agg(F.count(F.lit(1)).alias("event_count"),
                       F.count_distinct("customer_id").alias("unique_customers")))


def orders_by_city_membership(fct_orders: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Current non-cancelled orders by the customer attributes
    valid at order creation."""
    o = fct_orders.where(F.col("status") != "cancelled").select(
        "customer_sk", "order_date", "currency", "amount")
    c = dim_customer.select("customer_sk", "city", "membership")
    return (o.join(c, on="customer_sk", how="inner")
             .groupBy("order_date", "city", "membership", "currency")
             .agg(F.count(F.lit(1)).alias("order_count"), F.sum("amount").alias("order_amount")))
