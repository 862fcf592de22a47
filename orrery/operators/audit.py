"""Audits the warehouse cannot enforce: foreign keys, uniqueness, NOT NULL,
completeness against an expected grid, and the quarantine split of staging rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fk_audit(fact: DataFrame, checks: Sequence[tuple[str, str, DataFrame, str]]) -> DataFrame:
    """Orphan counts per foreign key (D-06): ``checks`` are
    ``(name, fact_column, dimension, dimension_key)``; one result row per check.

    One pass over the fact: each row is emitted once per foreign key as
    ``(fk, value)`` and reduced to one row per distinct value with its row count
    (combined map-side, so a hot key costs one row per task). Only those
    distinct values are anti-joined with the dimension keys. Rows with a NULL
    key count as orphan rows (an inner join to the dimension drops them) but not
    as a key. Values are compared as text so keys of any type share one column.
    """
    pairs = [F.struct(F.lit(name).alias("fk"), F.col(col).cast("string").alias("v")) for name, col, _, _ in checks]
    per_key = (fact.select(F.explode(F.array(*pairs)).alias("x")).select("x.fk", "x.v")
               .groupBy("fk", "v").agg(F.count(F.lit(1)).alias("n")))
    dim_keys = reduce(DataFrame.unionByName, [
        dim.select(F.lit(name).alias("fk"), F.col(key).cast("string").alias("v")) for name, _, dim, key in checks
    ]).distinct()
    orphans = per_key.join(dim_keys, ["fk", "v"], "left_anti").groupBy("fk").agg(
        F.sum("n").alias("orphan_rows"), F.count("v").alias("orphan_keys"))
    spark = fact.sparkSession
    names = F.broadcast(spark.createDataFrame([(name,) for name, *_ in checks], "fk_name string"))
    return names.join(orphans, names.fk_name == orphans.fk, "left").select(
        "fk_name", F.coalesce("orphan_rows", F.lit(0)).cast("long").alias("orphan_rows"),
        F.coalesce("orphan_keys", F.lit(0)).cast("long").alias("orphan_keys"))


def unique_audit(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their count (D-07)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def null_audit(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """NULL count per column in one pass, returned long: ``(column_name, null_count)``."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    stack = "stack({n}, {pairs}) as (column_name, null_count)".format(
        n=len(cols), pairs=", ".join(f"'{c}', `{c}`" for c in cols))
    return wide.selectExpr(stack)


def completeness_gap(expected: DataFrame, present: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Expected key combinations with no row in ``present`` (D-08)."""
    return expected.select(*keys).join(present.select(*keys), list(keys), "left_anti")


def expected_grid(base: DataFrame, arrays: dict[str, Column]) -> DataFrame:
    """Expand each ``base`` row by array-valued columns (codes, a year sequence):
    the grid size is |base| x product of array lengths, all bounded by dimensions."""
    out = base
    for name, arr in arrays.items():
        out = out.withColumn(name, F.explode(arr))
    return out


def quarantine_tagged(staging: DataFrame, value_col: str = "raw_value", value_type: str = "double",
                      checks: Sequence[tuple[Column, str]] = ()) -> DataFrame:
    """Staging rows with a typed ``value``, ``error_message`` (NULL when the row is
    good) and ``processed`` (D-05), in one pass.

    ``value_col`` is cast with ``try_cast`` (no ANSI error); a row whose text is
    present but does not cast, or that fails one of ``checks`` (``(ok_condition,
    message)``), gets the messages joined by ``; ``.
    """
    typed = staging.withColumn("value", F.col(value_col).try_cast(value_type))
    msgs = [F.when(F.col(value_col).isNotNull() & F.col("value").isNull(), F.lit(f"value not {value_type}"))]
    msgs += [F.when(~F.coalesce(ok, F.lit(False)), F.lit(msg)) for ok, msg in checks]
    msg = F.concat_ws("; ", *msgs)
    return typed.withColumns({"error_message": F.nullif(msg, F.lit("")), "processed": msg == ""})


def quarantine_split(staging: DataFrame, value_col: str = "raw_value", value_type: str = "double",
                     checks: Sequence[tuple[Column, str]] = ()) -> tuple[DataFrame, DataFrame]:
    """Split staging rows into ``(good, quarantine)`` (D-05): the two filters of
    ``quarantine_tagged``. Good rows drop ``error_message``."""
    tagged = quarantine_tagged(staging, value_col, value_type, checks)
    return tagged.filter(F.col("processed")).drop("error_message"), tagged.filter(~F.col("processed"))


class AuditFailure(ValueError):
    """What a gate found: ``findings`` maps each failed check to its count."""

    def __init__(self, findings: dict[str, int]):
        super().__init__(", ".join(f"{k}: {n}" for k, n in findings.items()))
        self.findings = findings


def audit_counts(df: DataFrame, keys: Sequence[str] = (), not_null: Sequence[str] = (),
                 foreign: Sequence[tuple[str, str, DataFrame, str]] = (), expected: DataFrame | None = None) -> DataFrame:
    """(check, failures) of D-06, D-07 and D-08 over one table: keys held more than once, NULLs per
    column, rows without a partner per foreign key (a NULL has none), and expected keys that are not there."""
    parts = []
    if keys:
        parts.append(unique_audit(df, keys).agg(F.count(F.lit(1)).alias("failures")).select(F.lit("duplicate keys").alias("check"), "failures"))
    if not_null:
        parts.append(null_audit(df, not_null).select(F.concat(F.lit("null "), "column_name").alias("check"), F.col("null_count").alias("failures")))
    if foreign:
        parts.append(fk_audit(df, foreign).select(F.concat(F.lit("orphans "), "fk_name").alias("check"), F.col("orphan_rows").alias("failures")))
    if expected is not None:
        parts.append(completeness_gap(expected, df, list(expected.columns)).agg(F.count(F.lit(1)).alias("failures"))
                     .select(F.lit("missing keys").alias("check"), "failures"))
    return reduce(DataFrame.unionByName, parts).select("check", F.col("failures").cast("long").alias("failures"))


def gate(**checks) -> Callable[[DataFrame], None]:
    """A function that raises ``AuditFailure`` where ``audit_counts`` with these checks finds anything; a row per check comes to the driver."""
    def check(df: DataFrame) -> None:
        found = {r["check"]: r["failures"] for r in audit_counts(df, **checks).collect() if r["failures"]}
        if found:
            raise AuditFailure(found)
    return check


def page_audit(pages: DataFrame) -> DataFrame:
    """Landed pages against what they declare, per indicator and run (D-08 over S-01).

    ``pages`` has ``indicator_code, run, page, pages, total, rows`` per landed document (``payload_pages``).
    A page that landed more than once counts once; ``missing_pages`` lists the numbers that never landed (bounded by
    the declared number of pages), ``rows_short`` is what the declared total has beyond the landed rows."""
    each = pages.groupBy("indicator_code", "run", "page").agg(F.count(F.lit(1)).alias("n"), F.max("pages").alias("pages"), F.max("total").alias("total"),
                                                              F.max("rows").alias("rows"))
    numbered = F.col("page").isNotNull()
    g = each.groupBy("indicator_code", "run").agg(
        F.max("pages").alias("pages"), F.max("total").alias("total"), F.count_if(numbered).alias("landed"),
        F.sum(F.when(numbered, F.col("n") - 1).otherwise(0)).alias("double"), F.sum(F.when(~numbered, F.col("n")).otherwise(0)).alias("unnumbered"),
        F.sum("rows").alias("rows"), F.collect_set("page").alias("__seen"))
    missing = F.array_except(F.when(F.col("pages") >= 1, F.sequence(F.lit(1), F.col("pages"))).otherwise(F.array().cast("array<int>")), "__seen")
    return g.select("indicator_code", "run", "pages", "landed", "double", "unnumbered", "total", "rows",
                    F.array_sort(missing).alias("missing_pages"), (F.col("total") - F.col("rows")).alias("rows_short"))
