"""Canonical payload text and hashes (P1, P2, P7) as column expressions.

A payload with fixed columns is rendered by ``to_json`` over a struct whose
fields are in sorted name order; money is carried as exact decimal text and
instants as UTC ISO text, so the hash does not depend on the session zone.
Free-form JSON goes through an Arrow-batched UDF over the JSON reader and writer of
Python, since Spark's variant rewrites numbers (``1.0`` as ``1``, long integers as
decimals): keys are sorted by code point at every depth, of repeated keys the last counts,
white space goes, text stays unescaped, integers keep all digits and other numbers are the
shortest text that reads back as the same double, always with a point or an exponent.
"""

import json
import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, StringType, TimestampNTZType, TimestampType

from .timeutil import iso_utc


def _json_ready(col: Column, dtype) -> Column:
    if isinstance(dtype, DecimalType):
        return col.cast("string")
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return iso_utc(col.cast("timestamp"))
    if isinstance(dtype, DateType):
        return F.date_format(col, "yyyy-MM-dd")
    return col


def canonical_json(df, columns: list[str]) -> Column:
    """P1 for fixed columns: sorted keys, compact, NULL fields kept as null."""
    types = {f.name: f.dataType for f in df.schema.fields}
    fields = [_json_ready(F.col(c), types[c]).alias(c) for c in sorted(columns)]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def _finite(text: str) -> float:
    value = float(text)
    if not math.isfinite(value):
        raise ValueError("a number beyond a double")
    return value


def _refused(name: str):
    raise ValueError(f"{name} is not JSON")


def canonical_text(text: str | None) -> str | None:
    """The canonical form of one JSON text; None if it has none."""
    if text is None:
        return None
    try:
        value = json.loads(text, parse_float=_finite, parse_constant=_refused)
        made = json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"), allow_nan=False)
        made.encode()  # half a surrogate pair has no UTF-8
    except (ValueError, RecursionError):
        return None
    return made


@F.pandas_udf(StringType())
def _canonical(texts: pd.Series) -> pd.Series:
    return texts.map(canonical_text, na_action="ignore")


def canonical_free_json(text) -> Column:
    """P1 for free JSON text; NULL when the text is not JSON, holds NaN, an infinite number or half a
    surrogate pair, or is nested too deeply to read."""
    return _canonical(F.col(text) if isinstance(text, str) else text)


def payload_hash(canonical: Column) -> Column:
    """Lowercase hex SHA-256 of the canonical text."""
    return F.sha2(canonical, 256)


def packed_hash(col: Column) -> Column:
    """A SHA-256 or MD5 in lowercase hex as bytes, for shuffles; other text whole.  The first byte tells them apart,
    so different texts stay different."""
    return F.when(col.rlike(r"\A(?:[0-9a-f]{32}){1,2}\z"), F.concat(F.lit(b"\x01"), F.unhex(col))) \
            .otherwise(F.concat(F.lit(b"\x00"), col.cast("binary")))


def unpacked_hash(col: Column) -> Column:
    """The text that ``packed_hash`` was given."""
    rest = F.substring(col, 2, 2**31 - 1)
    return F.when(F.substring(col, 1, 1) == F.lit(b"\x01"), F.lower(F.hex(rest))).otherwise(rest.cast("string"))


def surrogate_key(*parts: Column) -> Column:
    """md5 of the parts joined by '|'; NULL if any part is NULL (like ||)."""
    pieces: list[Column] = []
    for i, p in enumerate(parts):
        if i:
            pieces.append(F.lit("|"))
        pieces.append(p.cast("string"))
    return F.md5(F.concat(*pieces))
