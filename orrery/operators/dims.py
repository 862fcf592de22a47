"""Dimension builders: calendar and sequential surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F



def calendar_between(start: Column, end: Column, spark: SparkSession,
                     fiscal_shift_months: int = 0) -> DataFrame:
    """One row per day in ``[start, end]`` (L-04). ``start``/``end`` are date columns
    that may be literals or scalar subqueries; the row count is bounded by the span.

    Names are unpadded (``January``, ``Monday``); ``week`` is the ISO week;
    weekend is Saturday or Sunday; the fiscal year starts ``fiscal_shift_months``
    before the calendar year (D-10, default 0 = calendar year).
    """
    days = spark.range(1).select(F.explode(F.sequence(start, end, F.expr("INTERVAL 1 DAY"))).alias("d"))
    fiscal = F.add_months(F.col("d"), fiscal_shift_months) if fiscal_shift_months else F.col("d")
    return days.select(
        F.date_format("d", "yyyyMMdd").cast("int").alias("date_key"),
        F.col("d").alias("full_date"),
        F.year("d").cast("short").alias("year"),
        F.quarter("d").cast("short").alias("quarter"),
        F.month("d").cast("short").alias("month"),
        F.date_format("d", "MMMM").alias("month_name"),
        F.weekofyear("d").cast("short").alias("week"),
        F.dayofmonth("d").cast("short").alias("day_of_month"),
        F.date_format("d", "EEEE").alias("day_name"),
        F.dayofweek("d").isin(1, 7).alias("is_weekend"),
        F.year(fiscal).cast("short").alias("fiscal_year"),
        F.quarter(fiscal).cast("short").alias("fiscal_quarter"),
    )


def calendar(spark: SparkSession, start: str = "2015-01-01", end: str = "2030-12-31",
             fiscal_shift_months: int = 0) -> DataFrame:
    """Calendar over a literal date range (default 2015-01-01..2030-12-31: 5,844 rows)."""
    return calendar_between(F.to_date(F.lit(start)), F.to_date(F.lit(end)), spark, fiscal_shift_months)


def sequential_keys(df: DataFrame, order: Sequence[str], out: str = "key", start: int = 1) -> DataFrame:
    """Dense 1-based surrogate keys in ``order`` (P-07), plus an offset ``start - 1``.

    The rows are range-partitioned by a global sort and numbered within their
    partition; each partition's offset is the number of rows before it. Only the
    row counts, one per partition, meet in one place. The sorted rows are
    written once to the shared folder (a job runs when the plan is built), so both passes
    and any retry see the same partitions.
    """
    from orrery.session import work_dir
    path = work_dir(df.sparkSession, "keys")
    df.sort(*[F.col(c).asc_nulls_first() for c in order]).withColumns({
        "__pid": F.spark_partition_id(), "__mid": F.monotonically_increasing_id()}).write.parquet(path)
    placed = df.sparkSession.read.parquet(path)
    counts = placed.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"), F.min("__mid").alias("__first"))
    before = F.sum("__n").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("__pid", "__first", F.coalesce(before, F.lit(0)).alias("__off"))
    return (placed.join(F.broadcast(offsets), "__pid")
            .withColumn(out, (F.col("__mid") - F.col("__first") + F.col("__off") + start).cast("long"))
            .drop("__pid", "__mid", "__first", "__off"))
