"""Canonical text of free JSON (P1) and its hash."""

import hashlib

from pyspark.sql import functions as F

from tidemark.functions.canonical import canonical_free_json, payload_hash

CASES = [
    ('{"b": 1, "a": {"d": [ {"z": 1, "y": 2} ], "c": null}}', '{"a":{"c":null,"d":[{"y":2,"z":1}]},"b":1}'),
    ("[1.0, 1, -0.0, 1e5, 1E400]", None),
    ("[1.0, 1, -0.0, 1e5, 1.10, 1e-7, 1e16]", "[1.0,1,-0.0,100000.0,1.1,1e-07,1e+16]"),
    ("[123456789012345678901234567890, 0.1]", "[123456789012345678901234567890,0.1]"),
    ('{"a": 1, "a": 2}', '{"a":2}'),
    ('{"B": 1, "a": 2, "\\u00e9": "\\u00e9\\n"}', '{"B":1,"a":2,"é":"é\\n"}'),
    ('"\\ud83d\\ude00"', '"😀"'),
    ('"\\ud83d"', None),
    ('{"a": NaN}', None), ("[Infinity]", None), ("[-Infinity]", None),
    ("{'a': 1}", None), ('{"a": 1,}', None), ("", None), ("nul", None), (None, None),
    ("  null ", "null"), ("{}", "{}"), ("[]", "[]"), ('"x y"', '"x y"'),
    ("[" * 100_000 + "]" * 100_000, None),
]


def test_canonical_text_and_hash(spark):
    rows = spark.createDataFrame([(i, raw) for i, (raw, _) in enumerate(CASES)], "id long, raw string")
    rows = rows.select("id", canonical_free_json("raw").alias("text")).withColumn("hash", payload_hash(F.col("text")))
    for r in rows.collect():
        expected = CASES[r["id"]][1]
        assert r["text"] == expected, CASES[r["id"]][0][:60]
        assert r["hash"] == (expected and hashlib.sha256(expected.encode()).hexdigest())


def test_layout_does_not_change_the_hash(spark):
    raw = ['{"k": [1.50, {"x": "é", "w": 2}], "a": true}', '{ "a":true,\n"k":[1.5,{"w":2,"x":"\\u00e9"}] }']
    rows = spark.createDataFrame([(r,) for r in raw], "raw string")
    assert rows.select(payload_hash(canonical_free_json(F.col("raw")))).distinct().count() == 1
