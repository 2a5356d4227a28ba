"""Staging, dimensions and facts (M1-M9).

"View" models are lazy DataFrame functions; "table" models are written by the
caller when a materialisation is wanted (``sources.snapshot`` / ``ingest``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.canonical import surrogate_key
from ..functions.timeutil import business_date, zoned_or_fail
from ..operators.asof import asof_left_join
from ..operators.versions import latest_by


def stg_orders(order_versions: DataFrame, tiebreak: str = "updated_at") -> DataFrame:
    """The newest observed version of each order."""
    return latest_by(order_versions, ["order_id"], ["version", tiebreak])


def stg_payments(payment_versions: DataFrame, tiebreak: str = "paid_at") -> DataFrame:
    """The newest observed version of each payment."""
    return latest_by(payment_versions, ["payment_id"], ["version", tiebreak])


def _payload_text(name: str):
    return F.try_variant_get(F.col("_v"), f"$.{name}", "string")


def stg_landed_orders(raw_orders: DataFrame) -> DataFrame:
    """M1 over the landed log: the newest version (then the last ingested row)
    of each order, its payload parsed and typed only after the others are gone."""
    newest = latest_by(raw_orders, ["order_id"], ["version", "ingested_at"])
    return newest.withColumn("_v", F.try_parse_json("payload")).select(
        "order_id", _payload_text("customer_id").alias("customer_id"), _payload_text("status").alias("status"),
        _payload_text("amount").cast("decimal(18,2)").alias("amount"), _payload_text("currency").alias("currency"),
        "version", zoned_or_fail(_payload_text("created_at")).alias("created_at"),
        F.col("source_updated_at").alias("updated_at"))


def stg_landed_payments(raw_payments: DataFrame) -> DataFrame:
    """M2 over the landed log; ``paid_at`` is the record's own zoned time."""
    newest = latest_by(raw_payments, ["payment_id"], ["version", "ingested_at"])
    return newest.withColumn("_v", F.try_parse_json("payload")).select(
        "payment_id", "order_id", "version", _payload_text("amount").cast("decimal(18,2)").alias("amount"),
        _payload_text("currency").alias("currency"), _payload_text("status").alias("status"),
        zoned_or_fail(_payload_text("updated_at")).alias("paid_at"))


def dim_customer(history: DataFrame) -> DataFrame:
    """M3: Type 2 customer rows with a hash surrogate key of (id, valid_from UTC)."""
    sk = surrogate_key(F.col("customer_id"), F.col("valid_from").cast("string"))
    return history.select(sk.alias("customer_sk"), "customer_id", "city", "membership",
                          "valid_from", "valid_to")


def dim_product(products: DataFrame) -> DataFrame:
    """M4: products as landed."""
    return products


def fct_orders(stg: DataFrame, dim_cust: DataFrame) -> DataFrame:
    """M6: one current order with the customer version valid at creation."""
    joined = asof_left_join(stg, dim_cust.select("customer_id", "valid_from", "valid_to", "customer_sk"),
                            key="customer_id", at="created_at", take=["customer_sk"])
    return joined.withColumn("order_date", business_date("created_at"))


def fct_order_items(items: DataFrame, fct_ord: DataFrame, dim_prod: DataFrame) -> DataFrame:
    """M7: order lines with the order's customer, date and currency.

    Lines of unknown orders or unknown products drop out (inner joins).  The
    product join only filters, so it is a semi join: no product column is
    carried through the shuffle.
    """
    o = fct_ord.select("order_id", "customer_sk", "order_date", "currency")
    lines = items.join(dim_prod.select("product_id"), on="product_id", how="left_semi")
    return (lines.join(o, on="order_id", how="inner")
                 .select(surrogate_key(F.col("order_id"), F.col("line_number")).alias("order_item_sk"),
                         "order_id", "line_number", "product_id", "quantity", "unit_price",
                         (F.col("quantity") * F.col("unit_price")).alias("line_amount"),
                         "customer_sk", "order_date", "currency"))


def fct_payments(stg: DataFrame) -> DataFrame:
    """M8: payments with their business date."""
    return stg.withColumn("payment_date", business_date("paid_at"))


def fct_refunds(refunds: DataFrame) -> DataFrame:
    """M9: refunds with their business date."""
    return refunds.withColumn("refund_date", business_date("refunded_at"))
