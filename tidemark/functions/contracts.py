"""Record contracts as column expressions (V1-V6); no Python UDF.

Each check returns an ``array<string>`` of failing field names (empty = valid),
built as ``filter(array(when(bad, name), ...), isnotnull)`` so every failure is
reported at once, and no payload value ever appears in a message.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .timeutil import has_zone

# Fixed values of the contracts (P14: currency, hash and id patterns).
CLICK_TYPES = ("page_view", "add_to_cart", "checkout")
ORDER_EVENT_TYPES = ("ORDER_CREATED", "PAYMENT_COMPLETED", "ORDER_CANCELLED", "REFUND_ISSUED")
ORDER_EVENT_FIELDS = ("event_id", "order_id", "customer_id", "event_type", "event_time",
                      "amount", "currency", "version")
PAYMENT_CURRENCY = "IDR"
PAYMENT_STATUS = "succeeded"
CURRENCY_PATTERN = r"^[A-Z]{3}$"
NUMBER_TEXT = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"
SPECIAL_NUMBER_TEXT = r"(?i)^\s*[+-]?(inf|infinity|nan|snan)\s*$"
ISO_DATETIME = (r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:?\d{2}(:?\d{2}([.,]\d{1,9})?)?)?"
                r"(Z|z|[+-]\d{2}(:?\d{2}(:?\d{2})?)?)?)?$")


def failures(*checks: tuple[str, Column]) -> Column:
    """``array<string>`` of names whose ``bad`` predicate is true."""
    return F.filter(F.array(*[F.when(bad, F.lit(name)) for name, bad in checks]),
                    lambda x: x.isNotNull())


def _blank(c: Column) -> Column:
    return c.isNull() | c.rlike(r"^\s*$")


def click_errors(df: DataFrame) -> Column:
    """V5 on typed or text click rows: ids and type are non-empty strings
    (spaces pass, unlike V2/V4), type is one of three, event time has a zone."""
    et = F.col("event_time")
    if isinstance(df.schema["event_time"].dataType, StringType):
        bad_time = ~F.coalesce(has_zone(et), F.lit(False))
    else:
        bad_time = et.isNull()
    def empty(c):
        return F.col(c).isNull() | (F.length(F.col(c)) == 0)
    return failures(("event_id", empty("event_id")), ("customer_id", empty("customer_id")),
                    ("event_type", empty("event_type") | ~F.coalesce(F.col("event_type").isin(*CLICK_TYPES), F.lit(False))),
                    ("event_time", bad_time))


def amount_kind(text: Column) -> Column:
    """'number', 'special' (NaN / Infinity: parses but is not finite) or NULL."""
    return (F.when(text.rlike(NUMBER_TEXT), F.lit("number"))
             .when(text.rlike(SPECIAL_NUMBER_TEXT), F.lit("special")))


# ----------------------------------------------------------------- order events
def _probe(df: DataFrame, v: Column, names) -> DataFrame:
    """Parse once, then one projection that extracts each field, its JSON type
    and (for strings) its text; later predicates only read these columns."""
    m = df.withColumn("_m", F.try_variant_get(v, "$", "map<string,variant>"))
    cols = []
    for n in names:
        f = F.col("_m").getItem(n)
        cols += [f.alias(f"_f_{n}")]
    m = m.select("*", *cols)
    cols = []
    for n in names:
        t = F.schema_of_variant(F.col(f"_f_{n}"))
        cols += [t.alias(f"_t_{n}")]
    m = m.select("*", *cols)
    cols = [F.when(F.col(f"_t_{n}") == "STRING", F.variant_get(F.col(f"_f_{n}"), "$", "string"))
             .alias(f"_s_{n}") for n in names]
    return m.select("*", *cols)


def _number_text(n: str) -> Column:
    t = F.col(f"_t_{n}")
    return (F.when(t == "STRING", F.col(f"_s_{n}"))
             .when(t.isin("BIGINT", "DOUBLE") | t.startswith("DECIMAL"), F.to_json(F.col(f"_f_{n}"))))


def _int_at_least_one(n: str) -> Column:
    ok = (F.col(f"_t_{n}") == "BIGINT") & (F.try_variant_get(F.col(f"_f_{n}"), "$", "bigint") >= 1)
    return F.coalesce(ok, F.lit(False))


def _probe_cleanup(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(("_f_", "_t_", "_s_")) or c == "_m"])


def check_order_events(df: DataFrame, text_col: str = "payload") -> DataFrame:
    """V1 + V2 + V3: ``df`` plus a struct ``c`` for each JSON order event.

    ``c`` holds ``valid``; ``error_kind`` (``parse`` / ``missing``) and
    ``error_field`` of the first parse failure, in contract order (not an
    object; missing fields, all listed; event_type; event_time; amount;
    extra_fields); ``invalid_fields``: every field failing validation (ids
    non-blank, zone present, amount finite, 3 uppercase letters, integer
    version >= 1); and, for valid events, the typed record with ``extras``:
    unknown top-level keys merged over ``extra_fields`` (top level wins), as
    canonical JSON.
    """
    names = list(ORDER_EVENT_FIELDS) + ["extra_fields"]
    p = _probe(df, F.try_parse_json(F.col(text_col)), names)
    is_obj = F.col("_m").isNotNull()
    missing = F.filter(F.array(*[F.when(F.col(f"_f_{f}").isNull(), F.lit(f)) for f in ORDER_EVENT_FIELDS]),
                       lambda x: x.isNotNull())
    etype, ttext, cur = F.col("_s_event_type"), F.col("_s_event_time"), F.col("_s_currency")
    tparsed = F.try_to_timestamp(F.regexp_replace(ttext, "[zZ]$", "+00:00"))
    bad_time = ~F.coalesce(ttext.rlike(ISO_DATETIME) & tparsed.isNotNull(), F.lit(False))
    atext = _number_text("amount")
    akind = amount_kind(atext)
    bad_amount = akind.isNull()
    xtype = F.col("_t_extra_fields")
    bad_extras = xtype.isNotNull() & ~F.coalesce(xtype.startswith("OBJECT"), F.lit(False))
    bad_enum = ~F.coalesce(etype.isin(*ORDER_EVENT_TYPES), F.lit(False))
    p = p.select("*", missing.alias("_missing"), bad_time.alias("_bad_time"), atext.alias("_atext"),
                 akind.alias("_akind"), bad_extras.alias("_bad_extras"), bad_enum.alias("_bad_enum"),
                 tparsed.alias("_time"))
    miss = F.col("_missing")
    kind = (F.when(~is_obj, F.lit("parse")).when(F.size(miss) > 0, F.lit("missing"))
             .when(F.col("_bad_enum"), F.lit("parse"))
             .when(F.col("_bad_time") | F.col("_akind").isNull() | F.col("_bad_extras"), F.lit("parse")))
    where = (F.when(~is_obj, F.lit("payload")).when(F.size(miss) > 0, F.array_join(miss, ","))
              .when(F.col("_bad_enum"), F.lit("event_type"))
              .when(F.col("_bad_time"), F.lit("event_time")).when(F.col("_akind").isNull(), F.lit("amount"))
              .when(F.col("_bad_extras"), F.lit("extra_fields")))

    def blank_id(name):
        t = F.col(f"_s_{name}")
        return t.isNull() | t.rlike(r"^\s*$")
    invalid = failures(
        ("event_id", blank_id("event_id")), ("order_id", blank_id("order_id")),
        ("customer_id", blank_id("customer_id")),
        ("event_time", ~F.coalesce(has_zone(ttext), F.lit(False))),
        ("amount", F.col("_akind") == "special"),
        ("currency", ~F.coalesce(cur.rlike(CURRENCY_PATTERN), F.lit(False))),
        ("version", ~_int_at_least_one("version")))
    p = p.select("*", kind.alias("_kind"), where.alias("_where"), invalid.alias("_invalid"))
    valid = F.col("_kind").isNull() & (F.size(F.col("_invalid")) == 0)
    known = names
    top = F.map_filter(F.col("_m"), lambda k, _: ~k.isin(*known))
    supplied = F.coalesce(F.try_variant_get(F.col("_f_extra_fields"), "$", "map<string,variant>"),
                          F.create_map().cast("map<string,variant>"))
    kept = F.map_filter(supplied, lambda k, _: ~F.array_contains(F.map_keys(top), k))
    extras = F.to_json(F.to_variant_object(F.map_concat(kept, top)))
    c = F.struct(
        valid.alias("valid"), F.col("_kind").alias("error_kind"), F.col("_where").alias("error_field"),
        F.when(F.col("_kind").isNull(), F.array_join(F.col("_invalid"), ",")).alias("invalid_fields"),
        F.when(valid, F.col("_s_event_id")).alias("event_id"),
        F.when(valid, F.col("_s_order_id")).alias("order_id"),
        F.when(valid, F.col("_s_customer_id")).alias("customer_id"),
        F.when(valid, etype).alias("event_type"),
        F.when(valid, F.col("_time")).alias("event_time"),
        F.when(valid, F.col("_atext")).alias("amount"),
        F.when(valid, cur).alias("currency"),
        F.when(valid, F.try_variant_get(F.col("_f_version"), "$", "bigint")).alias("version"),
        F.when(valid, extras).alias("extras"))
    out = p.withColumn("c", c)
    return _probe_cleanup(out.drop("_missing", "_bad_time", "_atext", "_akind", "_bad_extras",
                                   "_bad_enum", "_time", "_kind", "_where", "_invalid"))


# ---------------------------------------------------------------------- payments
PAYMENT_FIELDS = ("payment_id", "order_id", "version", "amount", "currency", "status", "updated_at")


#: A minus sign before any digit but zero (no cast, so no limit on the number of digits).
NEGATIVE_PATTERN = r"^\s*-[0.]*[1-9]"


def check_payments(df: DataFrame, text_col: str = "payload") -> DataFrame:
    """V4: ``df`` plus ``invalid_fields`` (array) per JSON payment record.

    Rules: ids non-blank strings; integer version >= 1 (boolean refused);
    amount finite and >= 0; currency IDR; status succeeded; updated_at with a
    zone.  Any failing field makes the row (and its page) bad."""
    p = _probe(df, F.try_parse_json(F.col(text_col)), PAYMENT_FIELDS)

    def blank(name):
        t = F.col(f"_s_{name}")
        return t.isNull() | t.rlike(r"^\s*$")
    atext = _number_text("amount")
    ttext = F.col("_s_updated_at")
    errs = failures(
        ("payment_id", blank("payment_id")), ("order_id", blank("order_id")),
        ("version", ~_int_at_least_one("version")),
        ("amount", ~F.coalesce((amount_kind(atext) == "number") & ~atext.rlike(NEGATIVE_PATTERN), F.lit(False))),
        ("currency", ~F.coalesce(F.col("_s_currency") == PAYMENT_CURRENCY, F.lit(False))),
        ("status", ~F.coalesce(F.col("_s_status") == PAYMENT_STATUS, F.lit(False))),
        ("updated_at", ~F.coalesce(has_zone(ttext) & parse_ok(ttext), F.lit(False))))
    return _probe_cleanup(p.withColumn("invalid_fields", errs))


def parse_ok(ttext: Column) -> Column:
    return F.try_to_timestamp(F.regexp_replace(ttext, "[zZ]$", "+00:00")).isNotNull()


# ------------------------------------------------------------------ batch shape
class BatchShapeError(ValueError):
    pass


def batch_structure(df: DataFrame, required=("order_id", "version", "updated_at"),
                    key: str = "order_id") -> dict:
    """V6: required columns present, no NULL metadata, no duplicate key.

    One aggregate job; only three counters reach the driver."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise BatchShapeError(f"columns missing from the batch: {missing}")
    null_any = F.lit(False)
    for c in required:
        null_any = null_any | F.col(c).isNull()
    r = df.agg(F.count_if(null_any).alias("nulls"), F.count(F.col(key)).alias("keys"),
               F.count_distinct(F.col(key)).alias("distinct_keys")).first()
    if r["nulls"]:
        raise BatchShapeError("order metadata is NULL")
    if r["keys"] != r["distinct_keys"]:
        raise BatchShapeError("an order occurs twice in the batch")
    return r.asDict()
