"""Time scalars: business date (P6), date parts (P9), calendar (P10), zone checks.

All are built-in column expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The business time zone and the calendar bounds of the dimension.
BUSINESS_TZ = "Asia/Jakarta"
CALENDAR_START = "2026-09-01"
CALENDAR_END = "2026-10-31"

# An ISO-8601 instant that carries an explicit offset ("Z" or +hh:mm).
ZONED_ISO = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|z|[+-]\d{2}:?\d{2})$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def business_date(ts) -> Column:
    """The Asia/Jakarta calendar date of a UTC instant (session tz is UTC)."""
    return F.to_date(F.from_utc_timestamp(_col(ts), BUSINESS_TZ))


def as_utc_instant(ntz) -> Column:
    """Read a TIMESTAMP_NTZ column as a UTC instant (session tz is UTC)."""
    return _col(ntz).cast("timestamp")


def has_zone(text) -> Column:
    """True when an ISO text names its offset; Spark itself parses naive text."""
    return _col(text).rlike(ZONED_ISO)


def parse_zoned(text) -> Column:
    """P5: text -> TIMESTAMP, NULL when unparsable or without an offset."""
    t = _col(text)
    return F.when(has_zone(t), F.try_to_timestamp(F.regexp_replace(t, "[zZ]$", "+00:00")))


def zoned_or_fail(text) -> Column:
    """P5 for landed payloads: NULL stays NULL, a text without offset or no time at all fails the job."""
    t, at = _col(text), parse_zoned(text)
    bad = F.raise_error(F.concat(F.lit("payload_time_invalid: "), t)).cast("timestamp")
    return F.when(t.isNotNull() & at.isNull(), bad).otherwise(at)


def iso_utc(ts) -> Column:
    """Canonical text of an instant: microseconds and explicit offset, in UTC."""
    return F.date_format(_col(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")


def date_parts(day) -> list[Column]:
    """Integer year, month and day of a DATE column."""
    d = _col(day)
    return [F.year(d).alias("year"), F.month(d).alias("month"), F.dayofmonth(d).alias("day")]


def calendar(spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END) -> DataFrame:
    """P10 / M5 dim_date: one row per day in [start, end] inclusive.

    The range is generated on executors by ``sequence``; it is a handful of
    rows whatever the data size.
    """
    days = spark.range(1).select(
        F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)),
                             F.expr("interval 1 day"))).alias("date_day"))
    return days.select("date_day", *date_parts("date_day"))
