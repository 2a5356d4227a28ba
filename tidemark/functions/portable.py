"""Engine-neutral result columns for cross-engine comparison and reports.

Dates become ISO text, instants UTC text with microseconds, exact decimals
DOUBLE (they are summed exactly first, so the nearest double is the same in
every engine) and all integers BIGINT.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DateType, DecimalType, IntegerType, LongType,
                               ShortType, TimestampNTZType, TimestampType)

TS_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
# The same formats for the DuckDB oracle text.
SQL_TS_TEXT = "%Y-%m-%d %H:%M:%S.%f"


def portable(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(t, (TimestampType, TimestampNTZType)):
            c = F.date_format(c, TS_TEXT)
        elif isinstance(t, DecimalType):
            c = c.cast("double")
        elif isinstance(t, (ByteType, ShortType, IntegerType, LongType)):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(*cols)
