"""Quality gates (Q1 orders_loaded, Q2 customer_mapping, Q3 orphan_payments,
Q4 finance_reconciliation, Q5 negative_payment_amount; Q6 runner), declared
model tests (Q7 unique, Q8 not_null, Q9 relationships, Q10 accepted_values)
and singular tests (Q11-Q15) over the warehouse frames.  Null-safe compares
and ``coalesce(sum, 0)`` (P12) follow the reference's ``is distinct from``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import checks


def gate_values(fct_orders: DataFrame, fct_payments: DataFrame, fct_refunds: DataFrame,
                daily_finance: DataFrame) -> DataFrame:
    """Q1-Q5 as one small plan: (gate, value); 0 means pass.  Orders give two
    gates and the three money tables two, each from one aggregate."""
    failed = lambda ok: F.when(ok, 0).otherwise(1)
    orders = fct_orders.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("customer_sk").isNull()).alias("unmapped")) \
        .select(*_gates(orders_loaded=failed(F.col("n") > 0), customer_mapping=F.col("unmapped")))
    money = finance_terms(fct_payments, fct_refunds, daily_finance).select(*_gates(
        finance_reconciliation=failed(F.col("net_total") == F.col("paid_total") - F.col("refund_total")),
        negative_payment_amount=F.col("negative_payments")))
    orphans = (fct_payments.select("order_id")
               .join(fct_orders.select("order_id"), on="order_id", how="left_anti")
               .agg(F.count(F.lit(1)).alias("n")).select(*_gates(orphan_payments=F.col("n"))))
    return orders.unionByName(money).unionByName(orphans)


def _gates(**values):
    return [F.inline(F.array(*[F.struct(F.lit(k).alias("gate"), v.cast("bigint").alias("value"))
                               for k, v in values.items()]))]


def finance_terms(fct_payments: DataFrame, fct_refunds: DataFrame, daily_finance: DataFrame) -> DataFrame:
    """The three global sums (each 0 when empty) and the number of payments
    below zero as one row, from one aggregate over a tagged union (no join
    between the scalars)."""
    zero, none = F.lit(0).cast("decimal(18,2)"), F.lit(0).cast("bigint")
    net = daily_finance.select(F.col("net").alias("n"), zero.alias("p"), zero.alias("r"), none.alias("b"))
    paid = fct_payments.select(
        zero.alias("n"), F.when(F.col("status") == "succeeded", F.col("amount")).otherwise(zero).alias("p"),
        zero.alias("r"), F.when(F.col("amount") < 0, 1).otherwise(0).cast("bigint").alias("b"))
    ref = fct_refunds.select(zero.alias("n"), zero.alias("p"), F.col("amount").alias("r"), none.alias("b"))
    return net.unionByName(paid).unionByName(ref).agg(
        F.coalesce(F.sum("n"), zero).alias("net_total"),
        F.coalesce(F.sum("p"), zero).alias("paid_total"),
        F.coalesce(F.sum("r"), zero).alias("refund_total"),
        F.coalesce(F.sum("b"), none).alias("negative_payments"))


def finance_reconcile(fct_payments: DataFrame, fct_refunds: DataFrame, daily_finance: DataFrame) -> DataFrame:
    """Q13: one row; ``passed`` is false when net differs from paid - refunded."""
    t = finance_terms(fct_payments, fct_refunds, daily_finance).drop("negative_payments")
    return t.withColumn("passed", F.col("net_total").eqNullSafe(F.col("paid_total") - F.col("refund_total")))


def items_reconcile(fct_orders: DataFrame, fct_items: DataFrame) -> DataFrame:
    """Orders whose line total is distinct from the order amount
    (cancelled included; an order without lines has a NULL total)."""
    totals = fct_items.groupBy("order_id").agg(F.sum("line_amount").alias("item_total"))
    j = fct_orders.select("order_id", "amount").join(totals, on="order_id", how="left")
    return j.where(~F.col("item_total").eqNullSafe(F.col("amount"))).select("order_id")


def refunds_not_above_paid(fct_refunds: DataFrame, fct_payments: DataFrame) -> DataFrame:
    """Orders refunded above what was paid (currency ignored)."""
    r = fct_refunds.groupBy("order_id").agg(F.sum("amount").alias("refunded"))
    p = (fct_payments.where(F.col("status") == "succeeded").groupBy("order_id")
         .agg(F.sum("amount").alias("paid")))
    j = r.join(p, on="order_id", how="left")
    return j.where(F.col("refunded") > F.coalesce(F.col("paid"), F.lit(0))).select("order_id")


def customer_asof_fixture(fct_orders: DataFrame, dim_customer: DataFrame, order_id: str,
                          city: str, membership: str) -> DataFrame:
    """Q11: the named order must keep the attributes valid at its creation."""
    j = fct_orders.where(F.col("order_id") == order_id).join(dim_customer, on="customer_sk")
    return j.where((F.col("city") != city) | (F.col("membership") != membership)).select("order_id")


# The 20 declared column tests: (model, column, test, parent model, parent column / values).
DECLARED_TESTS = (
    ("dim_customer", "customer_sk", "unique", None, None),
    ("dim_customer", "customer_sk", "not_null", None, None),
    ("dim_product", "product_id", "unique", None, None),
    ("dim_product", "product_id", "not_null", None, None),
    ("fct_orders", "order_id", "unique", None, None),
    ("fct_orders", "order_id", "not_null", None, None),
    ("fct_orders", "customer_sk", "not_null", None, None),
    ("fct_orders", "customer_sk", "relationships", "dim_customer", "customer_sk"),
    ("fct_orders", "currency", "accepted_values", None, ("IDR",)),
    ("fct_order_items", "order_item_sk", "unique", None, None),
    ("fct_order_items", "order_item_sk", "not_null", None, None),
    ("fct_order_items", "order_id", "relationships", "fct_orders", "order_id"),
    ("fct_payments", "payment_id", "unique", None, None),
    ("fct_payments", "payment_id", "not_null", None, None),
    ("fct_payments", "order_id", "relationships", "fct_orders", "order_id"),
    ("fct_refunds", "refund_id", "unique", None, None),
    ("fct_refunds", "refund_id", "not_null", None, None),
    ("fct_refunds", "order_id", "relationships", "fct_orders", "order_id"),
    ("dim_date", "date_day", "unique", None, None),
    ("dim_date", "date_day", "not_null", None, None),
)


def generic_tests(models: dict[str, DataFrame]) -> DataFrame:
    """Q7-Q10: the declared column tests as (model, column_name, test, failures).

    Tests of one model become constraint rules checked together: all row rules
    (not_null, accepted_values) in one aggregate pass, unique keys by grouped
    counts, relationships by anti joins.  Run it over materialised models
    (``models.build``) so each test reads files instead of recomputing."""
    out = None
    for model in dict.fromkeys(t[0] for t in DECLARED_TESTS):
        rules = []
        for m, col, test, parent, extra in DECLARED_TESTS:
            if m != model:
                continue
            name = f"{m}|{col}|{test}"
            if test == "not_null":
                rules.append(checks.Constraint(name, "not_null", (col,)))
            elif test == "accepted_values":
                vals = ", ".join(f"'{v}'" for v in extra)
                # NULL passes, as with NOT IN
                rules.append(checks.Constraint(name, "check", predicate=f"{col} in ({vals})"))
            elif test == "unique":
                rules.append(checks.Constraint(name, "unique", (col,)))
            else:
                rules.append(checks.Constraint(name, "foreign_key", (col,), parent=parent,
                                               parent_columns=(extra,)))
        res = checks.check_constraints(models[model], rules, models)
        part = res.select(F.split("constraint_name", "[|]").alias("p"), "violations").select(
            F.col("p")[0].alias("model"), F.col("p")[1].alias("column_name"), F.col("p")[2].alias("test"),
            F.col("violations").alias("failures"))
        out = part if out is None else out.unionByName(part)
    return out


def lake_constraints(lake) -> DataFrame:
    """V7 over a lake: the declared rules of every landed and control table as
    (table_name, constraint_name, violations), one plan."""
    from .. import schemas
    tables = {"raw_order_versions": schemas.RAW_ORDER_VERSIONS,
              "raw_payment_versions": schemas.RAW_PAYMENT_VERSIONS,
              "clickstream_events": schemas.CLICKSTREAM_EVENTS,
              "ingestion_runs": schemas.INGESTION_RUNS}
    out = None
    for name, schema in tables.items():
        res = checks.check_constraints(lake.read(name, schema), schemas.RULES[name]) \
            .select(F.lit(name).alias("table_name"), "constraint_name", "violations")
        out = res if out is None else out.unionByName(res)
    return out
