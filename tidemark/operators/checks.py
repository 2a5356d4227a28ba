"""Data checks as DataFrame plans: constraints (V6, V7), generic model tests
(Q7-Q10), history overlap (J5) and two-path reconciliation (J9).

Every check returns a small DataFrame of counts or offending keys; only the
caller decides whether to collect it (a handful of rows) and raise.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.canonical import packed_hash, unpacked_hash


@dataclass(frozen=True)
class Constraint:
    """One declared rule of a table.

    kind: ``check`` (``predicate`` must hold; NULL counts as holding, as in SQL
    CHECK), ``not_null``, ``unique`` (NULL keys ignored) or ``foreign_key``
    (non-NULL child keys must exist in ``parent``).
    """
    name: str
    kind: str
    columns: tuple[str, ...] = ()
    predicate: str | None = None
    parent: str | None = None
    parent_columns: tuple[str, ...] = field(default_factory=tuple)


def _row_check_counts(df: DataFrame, rules: Sequence[Constraint]) -> DataFrame | None:
    """All row-local rules in one aggregate pass (one scan, partial agg)."""
    aggs = []
    for r in rules:
        if r.kind == "check":
            bad = F.coalesce(~F.expr(r.predicate), F.lit(False))
        else:  # not_null
            bad = F.lit(False)
            for c in r.columns:
                bad = bad | F.col(c).isNull()
        aggs.append(F.count_if(bad).alias(r.name))
    if not aggs:
        return None
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{r.name}', `{r.name}`" for r in rules)
    return wide.selectExpr(f"stack({len(rules)}, {stack}) as (constraint_name, violations)")


def unique_violations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keys (all parts non-NULL) that occur more than once; the grouped count
    combines map-side, so a hot key costs one row per partition."""
    cols = list(cols)
    nn = F.lit(True)
    for c in cols:
        nn = nn & F.col(c).isNotNull()
    texts = [f.name for f in df.select(*cols).schema.fields if isinstance(f.dataType, StringType)]
    # surrogate keys are half as long while they are grouped
    packed = df.where(nn).select(*cols).withColumns({c: packed_hash(F.col(c)) for c in texts})
    found = packed.groupBy(*cols).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    return found.withColumns({c: unpacked_hash(F.col(c)) for c in texts})


def relationship_violations(child: DataFrame, cols: Sequence[str], parent: DataFrame,
                            parent_cols: Sequence[str]) -> DataFrame:
    """Non-NULL child keys without a parent row (left anti join)."""
    cols, parent_cols = list(cols), list(parent_cols)
    p = parent.select(*[F.col(pc).alias(c) for pc, c in zip(parent_cols, cols)])
    nn = F.lit(True)
    for c in cols:
        nn = nn & F.col(c).isNotNull()
    return child.select(*cols).where(nn).join(p, on=cols, how="left_anti")


def check_constraints(df: DataFrame, rules: Sequence[Constraint],
                      parents: dict[str, DataFrame] | None = None) -> DataFrame:
    """(constraint_name, violations) for every rule, as one unioned plan."""
    parents = parents or {}
    spark = df.sparkSession
    parts = []
    rows = _row_check_counts(df, [r for r in rules if r.kind in ("check", "not_null")])
    if rows is not None:
        parts.append(rows)
    for r in rules:
        if r.kind == "unique":
            v = unique_violations(df, r.columns).agg(F.count(F.lit(1)).alias("violations"))
        elif r.kind == "foreign_key":
            v = relationship_violations(df, r.columns, parents[r.parent], r.parent_columns) \
                .agg(F.count(F.lit(1)).alias("violations"))
        else:
            continue
        parts.append(v.select(F.lit(r.name).alias("constraint_name"), "violations"))
    if not parts:
        return spark.createDataFrame([], "constraint_name string, violations bigint")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def history_overlaps(history: DataFrame, key: str = "customer_id", valid_from: str = "valid_from",
                     valid_to: str = "valid_to") -> DataFrame:
    """Rows whose validity starts before an earlier row of the same key ends.

    Exact replacement of the theta self join by a running ``max(valid_to)`` over
    the earlier rows (open end = +infinity).  Rows are grouped by (key, day of
    ``valid_from``), a value of the row itself, so a hot key is spread over its
    days and every plan puts a row into the same group:

    1. inside each group the running maximum of the earlier rows;
    2. per group its maximum, and over the groups of a key (one row per day)
       the maximum of the earlier days: the carry;
    3. a row overlaps when it starts before the larger of both.
    """
    far = F.lit("9999-12-31 23:59:59").cast("timestamp")
    dated = history.withColumns({"_day": F.to_date(valid_from), "_end": F.coalesce(F.col(valid_to), far)})
    group = Window.partitionBy(key, "_day")
    earlier = group.orderBy(valid_from).rowsBetween(Window.unboundedPreceding, -1)
    days = dated.groupBy(key, "_day").agg(F.max("_end").alias("_day_max"))
    before = Window.partitionBy(key).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    carry = days.withColumn("_carry", F.max("_day_max").over(before)).select(
        F.col(key).alias("_key"), F.col("_day").alias("_on"), "_carry")
    rows = dated.withColumn("_prior", F.max("_end").over(earlier))
    rows = rows.join(carry, rows[key].eqNullSafe(F.col("_key")) & rows["_day"].eqNullSafe(F.col("_on")))
    limit = F.greatest("_prior", "_carry")  # NULLs are skipped
    return rows.where(limit > F.col(valid_from)).select(*history.columns)


def reconcile(left: DataFrame, right: DataFrame, keys: Sequence[str], measures: Sequence[str],
              left_tag: str = "lake", right_tag: str = "warehouse") -> DataFrame:
    """Full outer join on null-safe keys; ``matched`` is false where any
    measure differs (or a side is missing).  Filter ``~matched`` for failures."""
    keys = list(keys)
    l = left.select(*[F.col(k).alias(f"_l_{k}") for k in keys],
                    *[F.col(m).alias(f"{left_tag}_{m}") for m in measures])
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                     *[F.col(m).alias(f"{right_tag}_{m}") for m in measures])
    cond = None
    for k in keys:
        c = l[f"_l_{k}"].eqNullSafe(r[f"_r_{k}"])
        cond = c if cond is None else cond & c
    j = l.join(r, cond, "full_outer")
    same: Column = F.lit(True)
    for m in measures:
        same = same & F.col(f"{left_tag}_{m}").eqNullSafe(F.col(f"{right_tag}_{m}"))
    return j.select(*[F.coalesce(F.col(f"_l_{k}"), F.col(f"_r_{k}")).alias(k) for k in keys],
                    *[F.col(f"{left_tag}_{m}") for m in measures],
                    *[F.col(f"{right_tag}_{m}") for m in measures],
                    same.alias("matched"))
