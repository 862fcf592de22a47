"""Sinks: JSON rows with NULLs kept, CSV report, JDBC export, pipeline metrics (S-07, S-12..S-15)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pyspark.sql.types import ArrayType, DataType, DecimalType, DoubleType, FloatType, StructField, StructType

from orrery.operators.load import observed_rows
from orrery.schemas import PIPELINE_METRICS


def fixed_numbers(kind: DataType, decimals: int = 6) -> DataType:
    """``kind`` with every float or double in it as a decimal, whose text has no exponent."""
    if isinstance(kind, (FloatType, DoubleType)):
        return DecimalType(38, decimals)
    if isinstance(kind, ArrayType):
        return ArrayType(fixed_numbers(kind.elementType, decimals), kind.containsNull)
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, fixed_numbers(f.dataType, decimals), f.nullable) for f in kind.fields])
    return kind


def json_rows(df: DataFrame, out: str = "json", decimals: int = 6) -> DataFrame:
    """One JSON object per row; NULL fields are written as ``null`` instead of dropped, and
    numbers with ``decimals`` places, so their text does not depend on their size."""
    cols = [F.col(f"`{f.name}`").cast(fixed_numbers(f.dataType, decimals)).alias(f.name) for f in df.schema.fields]
    return df.select(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias(out))


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV report with a header line."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None,
               truncate: bool = True) -> None:
    """Staging export to a database: truncate-and-reload keeps the table definition."""
    (df.write.format("jdbc").option("url", url).option("dbtable", table)
       .option("truncate", str(truncate).lower()).options(**(properties or {})).mode("overwrite").save())


def counted_write(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> int:
    """Write and return the row count observed during the write (no second job, S-13)."""
    obs = Observation("rows")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode).format(fmt).save(path)
    return observed_rows(obs)


def metrics_frame(spark: SparkSession, run_id: str, stage: str, record_count: int, status: str) -> DataFrame:
    return spark.createDataFrame([(run_id, stage, int(record_count), status, None)], PIPELINE_METRICS) \
        .withColumn("recorded_at", F.current_timestamp())


def append_metrics(spark: SparkSession, path: str, run_id: str, stage: str, record_count: int, status: str) -> None:
    """Append one metrics record (S-14) to the ``pipeline_metrics`` table."""
    metrics_frame(spark, run_id, stage, record_count, status).coalesce(1).write.mode("append").parquet(path)
