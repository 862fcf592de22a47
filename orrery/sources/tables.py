"""Scans of the warehouse input tables (one Parquet dataset per table).

Scans are lazy; Catalyst prunes columns and pushes filters into the Parquet
reader, so callers select and filter on the returned frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan ``{sf_dir}/{name}.parquet``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Tables:
    """Lazy handles on every input table of one data folder; each folder is listed once per object."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._scans: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        if name not in self._scans:
            self._scans[name] = table(self.spark, self.sf_dir, name)
        return self._scans[name]
