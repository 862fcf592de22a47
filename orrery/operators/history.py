"""Facts with the time at which each value was known (D-09).

Besides the period that a fact is about (its date key), every row has the interval of load
times in which it was the table's answer: ``valid_from`` on and before ``valid_to`` (NULL: still).
A changed value closes the interval and opens another; nothing is lost, and any
state of the table can be read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _differs(columns: Sequence[str], a: str, b: str) -> Column:
    out = F.lit(False)
    for c in columns:
        out = out | ~F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return out


def revise(history: DataFrame | None, batch: DataFrame, keys: Sequence[str], attributes: Sequence[str], at: Column,
           value: str = "value", retracted: str | None = None) -> DataFrame:
    """The history after ``batch`` (one row per key, no NULL in a key) was loaded at time ``at``.

    A key that is new gets a row from ``at`` on; one whose ``attributes`` differ has its open row
    closed at ``at`` and a new one opened, ``is_revised`` where ``value`` differs from the row
    before; equal ones and keys that the batch does not hold stay. Where the column
    ``retracted`` is true the open row is closed and none follows. Loading the same
    batch again changes nothing. The open rows meet the batch in one join on the key.
    """
    row = [*keys, *attributes]
    gone = F.coalesce(F.col(retracted), F.lit(False)) if retracted else F.lit(False)
    new = batch.select(F.struct(*row).alias("new"), gone.alias("__gone"), *[F.col(k).alias(f"__{k}") for k in keys])
    if history is None:
        return new.filter(~F.col("__gone")).select("new.*", at.alias("valid_from"), F.lit(None).cast("timestamp").alias("valid_to"),
                                                   F.lit(False).alias("is_revised"))
    columns = [*row, "valid_from", "valid_to", "is_revised"]
    closed = history.filter(F.col("valid_to").isNotNull()).select(columns)
    # the value before a key came back: its last closed one
    last = closed.groupBy(*keys).agg(F.max_by(value, "valid_to").alias("__last"), F.lit(True).alias("__had"))
    opened = history.filter(F.col("valid_to").isNull()).select(F.struct(*columns).alias("old"), *[F.col(k).alias(f"__{k}") for k in keys])
    both = opened.join(new, [f"__{k}" for k in keys], "full")
    both = both.join(last.select(*[F.col(k).alias(f"__{k}") for k in keys], "__last", "__had"), [f"__{k}" for k in keys], "left")
    had_old, had_new = F.col("old").isNotNull(), F.col("new").isNotNull() & ~F.coalesce(F.col("__gone"), F.lit(False))
    changed = had_old & (F.coalesce(F.col("__gone"), F.lit(False)) | (had_new & _differs(attributes, "old", "new")))
    same_value = F.when(had_old, F.col(f"old.{value}").eqNullSafe(F.col(f"new.{value}"))).when(
        F.col("__had"), F.col("__last").eqNullSafe(F.col(f"new.{value}"))).otherwise(True)

    def as_row(side: str, start: Column, end: Column, revised: Column) -> Column:
        return F.struct(*[F.col(f"{side}.{c}").alias(c) for c in row], start.alias("valid_from"), end.cast("timestamp").alias("valid_to"), revised.alias("is_revised"))

    kept = F.when(had_old, as_row("old", F.col("old.valid_from"), F.when(changed, at), F.col("old.is_revised")))
    fresh = F.when(had_new & (~had_old | changed), as_row("new", at, F.lit(None), ~same_value))
    rows = both.select(F.explode(F.filter(F.array(kept, fresh), lambda x: x.isNotNull())).alias("r")).select("r.*")
    return closed.unionByName(rows.select(columns))


def as_of(history: DataFrame, at: Column) -> DataFrame:
    """The rows that were the table's answer at time ``at``."""
    return history.filter((F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (F.col("valid_to") > at)))
