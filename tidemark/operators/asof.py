"""History-aware (Type 2) lookup.

Each fact row takes the dimension version whose half-open validity
``[valid_from, valid_to)`` holds the fact's instant; an open ``valid_to``
(NULL) means "still valid".  Expressed as an equi join on the entity key with
a range residual, so Spark plans a sort-merge (or, when AQE sees a small side,
broadcast-hash) join -- never a nested loop.  A hot entity key is split by
AQE's skew-join handling on the fact side; the dimension side of one entity
is its short history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def asof_left_join(facts: DataFrame, history: DataFrame, key: str, at: str,
                   valid_from: str = "valid_from", valid_to: str = "valid_to",
                   take: list[str] | None = None) -> DataFrame:
    """Left join ``facts`` to the ``history`` version valid at ``facts[at]``.

    ``take`` lists the history columns to attach (default: all but the key and
    the validity bounds).  Unmatched facts keep NULLs.
    """
    take = take or [c for c in history.columns if c not in (key, valid_from, valid_to)]
    h = history.select(F.col(key).alias("_hk"), F.col(valid_from).alias("_vf"),
                       F.col(valid_to).alias("_vt"), *take)
    cond = ((facts[key] == h["_hk"]) & (facts[at] >= h["_vf"])
            & (h["_vt"].isNull() | (facts[at] < h["_vt"])))
    return facts.join(h, cond, "left").drop("_hk", "_vf", "_vt")
