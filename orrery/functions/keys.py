"""Keys, labels and lineage columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_key(*cols: str | Column) -> Column:
    """Fact surrogate key from the natural key: no global ordering, no single-task window."""
    return F.xxhash64(*[F.col(c) if isinstance(c, str) else c for c in cols])


def index_label(country_key: str | Column, sector_key: str | Column, prefix: str = "IDX") -> Column:
    """``IDX_{country}_{sector}`` label."""
    return F.format_string(f"{prefix}_%s_%s", F.col(country_key) if isinstance(country_key, str) else country_key,
                           F.col(sector_key) if isinstance(sector_key, str) else sector_key)


def run_id_of(ts: Column | None = None) -> Column:
    """Run id text ``yyyyMMdd_HHmmss`` from a timestamp (default: query start time)."""
    return F.date_format(ts if ts is not None else F.current_timestamp(), "yyyyMMdd_HHmmss")


def with_lineage(df, source: str, run_id: str, loaded_col: str = "loaded_at"):
    """Add ``source``, ``pipeline_run_id`` and a load timestamp."""
    return (df.withColumn("source", F.lit(source))
              .withColumn("pipeline_run_id", F.lit(run_id))
              .withColumn(loaded_col, F.current_timestamp()))


def with_defaults(df, defaults: dict):
    """Column defaults (P-08): add each missing column as its default and replace
    NULLs in present ones. ``defaults`` maps column -> Python literal or Column."""
    cols = {}
    for name, value in defaults.items():
        lit = value if isinstance(value, Column) else F.lit(value)
        cols[name] = F.coalesce(F.col(name), lit) if name in df.columns else lit
    return df.withColumns(cols)
