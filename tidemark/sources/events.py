"""Contract-shaped JSON feeds derived from the driver tables.

The text of every record is produced by one SQL expression written for both
Spark and DuckDB (``order_event_text``), so the oracle sees byte-identical
input.  Defects are injected by key, one kind per row:

  order events (key mod 12): 0 missing event_id and amount; 1 event_type null;
  2 unknown event_type; 3 event_time without zone; 4 amount "not-money";
  5 version true; 6 version 1.0; 7 version 0; 8 currency "idr"; 9 blank
  order_id; 10 extras (extra_fields object plus an unknown top-level key that
  overrides it); 11 clean.

  payments (key mod 5000): 1 version true; 2 amount "-5.00"; 3 currency USD;
  4 updated_at without zone; 5 blank payment_id; 6 amount "NaN"; status
  "failed" (key mod 2000 = 7) also fails; the rest are clean.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

PAGE_ROWS = 100   # payments per landed page (pages are key // PAGE_ROWS)


def _ts_text(dialect: str, expr: str) -> str:
    if dialect == "spark":
        return f"date_format({expr}, \"yyyy-MM-dd'T'HH:mm:ss\")"
    return f"strftime({expr}, '%Y-%m-%dT%H:%M:%S')"


def _minutes(dialect: str) -> str:
    if dialect == "spark":
        return "timestampadd(MINUTE, o_orderkey % 1440, o_orderdate)"
    return "(o_orderdate + to_minutes(cast(o_orderkey % 1440 as bigint)))"


def order_event_text(dialect: str) -> str:
    m = "(o_orderkey % 12)"
    amount = "cast(cast(o_totalprice as decimal(18,2)) as string)"
    t = _ts_text(dialect, _minutes(dialect))
    key = "cast(o_orderkey as string)"
    return f"""concat('{{',
  case when {m} = 0 then '' when {m} = 4 then '"amount":"not-money",'
       else concat('"amount":"', {amount}, '",') end,
  case when {m} = 10 then '"channel":"app",' else '' end,
  case when {m} = 8 then '"currency":"idr",' else '"currency":"IDR",' end,
  concat('"customer_id":"', cast(o_custkey as string), '",'),
  case when {m} = 0 then '' else concat('"event_id":"evt-', {key}, '",') end,
  case when {m} = 3 then concat('"event_time":"', {t}, '",')
       else concat('"event_time":"', {t}, '+07:00",') end,
  case when {m} = 1 then '"event_type":null,' when {m} = 2 then '"event_type":"SHIPPED",'
       else '"event_type":"ORDER_CREATED",' end,
  case when {m} = 10 then '"extra_fields":{{"channel":"web","source":"tpch"}},' else '' end,
  case when {m} = 9 then '"order_id":"  ",' else concat('"order_id":"', {key}, '",') end,
  case when {m} = 5 then '"version":true' when {m} = 6 then '"version":1.0'
       when {m} = 7 then '"version":0' else '"version":1' end,
  '}}')"""


def payment_text(dialect: str) -> str:
    m = "(o_orderkey % 5000)"
    key = "cast(o_orderkey as string)"
    amount = "cast(cast(o_totalprice as decimal(18,2)) as string)"
    t = _ts_text(dialect, "o_orderdate")
    return f"""concat('{{',
  case when {m} = 2 then '"amount":"-5.00",' when {m} = 6 then '"amount":"NaN",'
       else concat('"amount":"', {amount}, '",') end,
  case when {m} = 3 then '"currency":"USD",' else '"currency":"IDR",' end,
  concat('"order_id":"', {key}, '",'),
  case when {m} = 5 then '"payment_id":" ",' else concat('"payment_id":"', {key}, '",') end,
  case when o_orderkey % 2000 = 7 then '"status":"failed",' else '"status":"succeeded",' end,
  case when {m} = 4 then concat('"updated_at":"', {t}, '",')
       else concat('"updated_at":"', {t}, '+07:00",') end,
  case when {m} = 1 then '"version":true' else '"version":1' end,
  '}}')"""


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").cast("string").alias("ref"),
                    F.expr(order_event_text("spark")).alias("payload"))


def _page_no() -> Column:
    return (F.col("o_orderkey") / PAGE_ROWS).cast("bigint")


def payment_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payment JSON rows, one per order, with their landed page number."""
    o = read_table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").cast("string").alias("ref"),
                    _page_no().alias("page_no"),
                    F.expr(payment_text("spark")).alias("payload"))


def payment_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed feed pages: one JSON document per page, ``{"data": [...],
    "next_cursor": ...}``; pages chain by cursor ``p<next page>`` and the last
    page has a null cursor.  A page holds at most PAGE_ROWS records, so the
    per-page ``collect_list`` is bounded by construction."""
    o = read_table(spark, sf_dir, "orders").withColumn("page_no", _page_no())
    # the orders are brought together, not their longer texts
    pages = o.repartition("page_no").select("page_no", F.expr(payment_text("spark")).alias("payload")).groupBy("page_no").agg(
        F.array_join(F.array_sort(F.collect_list("payload")), ",").alias("body"))
    nxt = o.select((F.col("page_no") - 1).alias("page_no"), F.lit(True).alias("has_next")).distinct()
    pages = pages.join(nxt, on="page_no", how="left")
    cursor = F.when(F.col("has_next"),
                    F.concat(F.lit('"p'), (F.col("page_no") + 1).cast("string"), F.lit('"'))) \
              .otherwise(F.lit("null"))
    return pages.select(F.concat(F.lit("p"), F.col("page_no").cast("string")).alias("page_id"),
                        F.concat(F.lit('{"data":['), F.col("body"), F.lit('],"next_cursor":'),
                                 cursor, F.lit("}")).alias("page"))
