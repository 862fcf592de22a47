"""Run-partitioned Parquet zones (raw and processed): write one run, read all runs
with partition discovery, or read a single run by partition filter (S-02..S-06).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from orrery.schemas import RAW_OBSERVATION

RUN_COL = "run"


def write_run(df: DataFrame, root: str, run_id: str, max_records_per_file: int = 5_000_000) -> None:
    """Overwrite the ``run=<run_id>`` partition only (dynamic partition overwrite),
    leaving earlier runs in place. ``rebalance`` lets AQE size the files (no flood
    of small files from many tiny tasks, no single huge task)."""
    (df.withColumn(RUN_COL, F.lit(run_id)).hint("rebalance")
       .write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .option("maxRecordsPerFile", max_records_per_file)
       .partitionBy(RUN_COL)
       .parquet(root))


def read_all_runs(spark: SparkSession, root: str, schema: StructType | None = None) -> DataFrame:
    """Every run; ``run`` is discovered from the folder names as a string."""
    reader = spark.read.option("basePath", root)
    if schema is not None:
        reader = reader.schema(StructType(list(schema.fields) + [StructField(RUN_COL, StringType())]))
    return reader.parquet(root)


def read_run(spark: SparkSession, root: str, run_id: str, schema: StructType | None = None) -> DataFrame:
    """One run, by a partition filter the scan prunes on (only that folder is listed and read)."""
    return read_all_runs(spark, root, schema).filter(F.col(RUN_COL) == run_id)


def read_raw(spark: SparkSession, root: str) -> DataFrame:
    """Raw zone with the explicit raw-observation schema (no inference)."""
    return read_all_runs(spark, root, RAW_OBSERVATION)
