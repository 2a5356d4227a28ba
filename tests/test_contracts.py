"""Order-event, payment and click contracts (V1-V5), one JSON row at a time."""

import json

from pyspark.sql import functions as F

from tidemark.functions.contracts import check_order_events, check_payments

BASE = {"event_id": "evt-1", "order_id": "ord-1", "customer_id": "cust-1", "event_type": "ORDER_CREATED",
        "event_time": "2026-09-28T10:00:00+07:00", "amount": "125000.00", "currency": "IDR", "version": 1}


def check(spark, payloads):
    texts = [(i, p if isinstance(p, str) else json.dumps(p)) for i, p in enumerate(payloads)]
    df = spark.createDataFrame(texts, "i int, payload string")
    return [r["c"] for r in check_order_events(df).orderBy("i").collect()]


def with_(**kw):
    d = dict(BASE)
    for k, v in kw.items():
        if v is KeyError:
            d.pop(k)
        else:
            d[k] = v
    return d


def test_valid_event_and_extras(spark):
    p = with_(channel="app", extra_fields={"channel": "web", "source": "tpch"})
    c, = check(spark, [p])
    assert c.valid and c.error_kind is None and c.invalid_fields == ""
    assert json.loads(c.extras) == {"channel": "app", "source": "tpch"}
    assert c.version == 1 and c.amount == "125000.00"


def test_missing_fields_listed_in_contract_order(spark):
    c, = check(spark, [with_(amount=KeyError, event_id=KeyError)])
    assert (c.error_kind, c.error_field) == ("missing", "event_id,amount")


def test_present_null_is_not_missing(spark):
    c, = check(spark, [with_(event_type=None)])
    assert (c.error_kind, c.error_field) == ("parse", "event_type")


def test_parse_errors_name_the_field(spark):
    cs = check(spark, [with_(event_type="SHIPPED"), with_(amount="not-money"), with_(amount=True),
                       with_(event_time="yesterday"), with_(extra_fields=[1]), "[1,2]", "not json"])
    assert [(c.error_kind, c.error_field) for c in cs] == [
        ("parse", "event_type"), ("parse", "amount"), ("parse", "amount"), ("parse", "event_time"),
        ("parse", "extra_fields"), ("parse", "payload"), ("parse", "payload")]
    assert all("125000" not in (c.error_field or "") for c in cs)   # no payload values in errors


def test_validation_reports_every_field(spark):
    cs = check(spark, [with_(event_time="2026-09-28T10:00:00"), with_(currency="idr"), with_(currency="USDD"),
                       with_(version=0), with_(version=True), with_(version=1.0), with_(order_id="  "),
                       with_(amount="NaN"), with_(order_id=" ", currency="idr", version=0)])
    assert [c.invalid_fields for c in cs] == ["event_time", "currency", "currency", "version", "version",
                                              "version", "order_id", "amount", "order_id,currency,version"]
    assert not any(c.valid for c in cs)


def test_z_suffix_accepted(spark):
    c, = check(spark, [with_(event_time="2026-09-28T03:00:00Z")])
    assert c.valid and str(c.event_time) .startswith("2026-09-28 03:00:00")


def test_payment_contract(spark):
    ok = {"payment_id": "pay-1", "order_id": "ord-1", "version": 1, "amount": "10.00", "currency": "IDR",
          "status": "succeeded", "updated_at": "2026-09-28T10:20:00+07:00"}
    cases = [ok, dict(ok, version=True), dict(ok, amount="-1"), dict(ok, amount="NaN"), dict(ok, currency="USD"),
             dict(ok, status="failed"), dict(ok, updated_at="2026-09-28T10:20:00"), dict(ok, payment_id=" ")]
    df = spark.createDataFrame([(i, json.dumps(p)) for i, p in enumerate(cases)], "i int, payload string")
    got = [r["f"] for r in check_payments(df).orderBy("i").select(F.array_join("invalid_fields", ",").alias("f")).collect()]
    assert got == ["", "version", "amount", "amount", "currency", "status", "updated_at", "payment_id"]


def test_click_contract_blank_spaces_pass(spark):
    from tidemark.streaming.clicks import check_clicks
    recs = [json.dumps({"event_id": " ", "customer_id": "c", "event_type": "page_view",
                        "event_time": "2026-10-01T09:00:00+07:00"}),
            json.dumps({"event_id": "", "customer_id": "c", "event_type": "signup",
                        "event_time": "2026-10-01T09:00:00"}),
            "{broken"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(recs)], "i int, value string")
    out = check_clicks(df).orderBy("i").collect()
    assert out[0]["invalid_fields"] == [] and not out[0]["bad_json"]
    assert out[1]["invalid_fields"] == ["event_id", "event_type", "event_time"]
    assert out[2]["bad_json"]


def test_batch_structure(spark):
    import pytest

    from tidemark.functions.contracts import BatchShapeError, batch_structure
    ok = spark.createDataFrame([("a", 1, "2026-01-01")], "order_id string, version bigint, updated_at string")
    assert batch_structure(ok)["keys"] == 1
    with pytest.raises(BatchShapeError, match="columns missing"):
        batch_structure(ok.drop("version"))
    nulls = spark.createDataFrame([("a", None, "x")], "order_id string, version bigint, updated_at string")
    with pytest.raises(BatchShapeError, match="metadata is NULL"):
        batch_structure(nulls)
    dup = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y")], "order_id string, version bigint, updated_at string")
    with pytest.raises(BatchShapeError, match="twice in the batch"):
        batch_structure(dup)
