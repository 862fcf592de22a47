"""Change operators over ordered series: previous-row change, calendar-aware change,
anomaly flag and gate, revision flag.

All windows partition by the series key, so a chain of them shares one
exchange. Calendar-aware changes use a RANGE frame on an integer period index
(``[-step, -step]``) instead of a self join: same shuffle as the ``lag``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orrery.functions.numeric import anomaly_flag, pct_change


def _asc(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in cols]


def prev_value(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], value: str = "value",
               out: str = "prev_value") -> DataFrame:
    """``lag(value, 1)`` per series; NULL order values sort first (W-01)."""
    w = Window.partitionBy(*keys).orderBy(*_asc(order))
    return df.withColumn(out, F.lag(value, 1).over(w))


def pct_change_prev(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], value: str = "value",
                    out: str = "yoy_change", scale: int | None = 4, use_abs: bool = True,
                    keep_prev: bool = True) -> DataFrame:
    """Change against whatever row comes before (W-01 + W-02): the pipeline's ``yoy_change``."""
    w = Window.partitionBy(*keys).orderBy(*_asc(order))
    prev = F.lag(value, 1).over(w)
    if keep_prev:
        return df.withColumns({"prev_value": prev, out: pct_change(value, prev, scale, use_abs)})
    return df.withColumn(out, pct_change(value, prev, scale, use_abs))


def period_index(year: str | Column, sub: str | Column | None = None, per_year: int = 1) -> Column:
    """Integer index of a period: ``year*per_year + (sub-1)``; consecutive periods differ by 1."""
    y = F.col(year) if isinstance(year, str) else year
    if sub is None:
        return y.cast("int")
    s = F.col(sub) if isinstance(sub, str) else sub
    return (y * per_year + s - 1).cast("int")


def calendar_change(df: DataFrame, keys: Sequence[str], index: str, value: str = "value", step: int = 1,
                    out: str = "change", scale: int | None = 4, use_abs: bool = True) -> DataFrame:
    """Change against the row exactly ``step`` periods earlier (NULL across a gap).

    ``index`` is an integer period index unique per series (see ``period_index``):
    month index with step 12 = YoY on monthly data, step 1 = MoM; quarter index
    with step 1 = QoQ (D-01..D-03).
    """
    w = Window.partitionBy(*keys).orderBy(F.col(index)).rangeBetween(-step, -step)
    prev = F.max(F.col(value)).over(w)
    return df.withColumn(out, pct_change(F.col(value), prev, scale, use_abs))


def flag_anomalies(df: DataFrame, col: str = "yoy_change", threshold: float = 200.0,
                   out: str = "is_anomaly") -> DataFrame:
    return df.withColumn(out, anomaly_flag(col, threshold))


def anomaly_gate(df: DataFrame, col: str = "yoy_change", threshold: float = 200.0,
                 keep_unscored: bool = False, flag: str = "is_anomaly") -> DataFrame:
    """Keep rows whose change is not anomalous (W-04 + F-03).

    By default a NULL flag (first row of a series, previous value 0) is dropped
    too, like a three-valued ``flag == False`` filter; ``keep_unscored`` keeps it.
    """
    flagged = df if flag in df.columns else flag_anomalies(df, col, threshold, flag)
    cond = ~F.col(flag)
    if keep_unscored:
        cond = cond | F.col(flag).isNull()
    return flagged.filter(cond)


def revision_flag(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str = "value",
                  out: str = "is_revised", bucket: str | Column | None = None) -> DataFrame:
    """``is_revised``: the value differs from the previous version of the same key (D-09).

    With ``bucket`` (e.g. the day of the version timestamp) the work splits by
    (key, bucket) so one hot key does not land in a single task: a row whose
    predecessor is in an earlier bucket takes it from a per-bucket last-value
    table (one row per key and bucket, built by a map-side-combined aggregate).
    """
    if bucket is None:
        w = Window.partitionBy(*keys).orderBy(*_asc(order))
        prev = F.lag(value, 1).over(w)
        return df.withColumn(out, F.coalesce(prev != F.col(value), F.lit(False)))

    b = F.col(bucket) if isinstance(bucket, str) else bucket
    tagged = df.withColumn("__bucket", b)
    w_in = Window.partitionBy(*keys, "__bucket").orderBy(*_asc(order))
    inner = tagged.withColumns({"__prev_in": F.lag(value, 1).over(w_in),
                                "__first_in": F.row_number().over(w_in) == 1})
    order_struct = F.struct(*[F.col(c) for c in order])
    last = (tagged.groupBy(*keys, "__bucket")
            .agg(F.max_by(F.col(value), order_struct).alias("__last")))
    w_b = Window.partitionBy(*keys).orderBy("__bucket")
    carry = last.withColumn("__prev_bucket_last", F.lag("__last", 1).over(w_b)).drop("__last")
    carry = carry.withColumnsRenamed({c: f"__c_{c}" for c in [*keys, "__bucket"]})
    same = F.lit(True)
    for c in [*keys, "__bucket"]:  # a NULL key is a key like any other
        same = same & F.col(c).eqNullSafe(F.col(f"__c_{c}"))
    joined = inner.join(carry, same, "left").drop(*[f"__c_{c}" for c in [*keys, "__bucket"]])
    prev = F.when(F.col("__first_in"), F.col("__prev_bucket_last")).otherwise(F.col("__prev_in"))
    return (joined.withColumn(out, F.coalesce(prev != F.col(value), F.lit(False)))
            .drop("__bucket", "__prev_in", "__first_in", "__prev_bucket_last"))
