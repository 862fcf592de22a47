"""Idempotent fact loading: latest-version reduce, batch dedupe, key resolution,
insert-if-absent, and the append/overwrite writes.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def latest_version(df: DataFrame, keys: Sequence[str], version: Sequence[str], earliest: bool = False) -> DataFrame:
    """One row per key: the row with the greatest ``version`` tuple (A-08), or the
    smallest with ``earliest``.

    ``max_by`` over a struct is a plain aggregate, so a hot key is combined
    map-side before the shuffle (unlike a ranking window).
    """
    rest = [c for c in df.columns if c not in keys]
    vstruct = F.struct(*[F.col(c) for c in version])
    row = F.struct(*[F.col(c) for c in rest])
    pick = F.min_by if earliest else F.max_by
    return (df.groupBy(*keys).agg(pick(row, vstruct).alias("__row"))
            .select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest]))


def dedupe_batch(df: DataFrame, keys: Sequence[str], version: Sequence[str] | None = None,
                 earliest: bool = False) -> DataFrame:
    """Drop in-batch duplicates on ``keys`` (A-09): the latest ``version`` wins (the earliest
    with ``earliest``). The other columns, in order, break ties and are the version where none
    is given, so the winner does not depend on how the rows are partitioned."""
    rest = [c for c in df.columns if c not in keys and c not in (version or ())]
    order = [*(version or ()), *rest]
    if not order:
        return df.distinct()
    return latest_version(df, keys, order, earliest if version else True)


@dataclass(frozen=True)
class DimRef:
    """A natural-key -> surrogate-key lookup: ``fact[fact_col] = dim[natural]`` gives ``dim[surrogate]``.

    ``dim`` is a DataFrame (joined; the planner broadcasts it if its size allows) or a
    small dict ``{natural: surrogate}`` (a map-literal lookup, no join at all). A natural
    key that a frame holds twice takes its smallest surrogate, so no fact is doubled.
    """
    dim: DataFrame | dict
    fact_col: str
    natural: str
    surrogate: str


def resolve_keys(df: DataFrame, dims: Sequence[DimRef]) -> tuple[DataFrame, DataFrame]:
    """Swap natural codes for surrogate keys (J-04). Returns ``(matched, orphans)``:
    rows that miss any dimension go to ``orphans`` with a ``missing`` column
    instead of vanishing silently (D-06)."""
    out = df
    for i, d in enumerate(dims):
        if isinstance(d.dim, dict):
            pairs = [F.lit(x) for kv in d.dim.items() for x in kv]
            out = out.withColumn(d.surrogate, F.try_element_at(F.create_map(*pairs), F.col(d.fact_col)))
            continue
        lookup = d.dim.groupBy(F.col(d.natural).alias(f"__nat{i}")).agg(F.min(d.surrogate).alias(d.surrogate))
        out = out.join(lookup, out[d.fact_col] == lookup[f"__nat{i}"], "left").drop(f"__nat{i}")
    missing = F.concat_ws(",", *[F.when(F.col(d.surrogate).isNull(), F.lit(d.fact_col)) for d in dims])
    tagged = out.withColumn("__missing", missing)
    matched = tagged.filter(F.col("__missing") == "").drop("__missing")
    orphans = tagged.filter(F.col("__missing") != "").withColumnRenamed("__missing", "missing")
    return matched, orphans


def insert_if_absent(batch: DataFrame, target: DataFrame, keys: Sequence[str],
                     version: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows of ``batch`` whose natural key is not in ``target`` (L-01, J-05, U-02).

    The batch is deduplicated first (two copies of a new key insert once) and
    rows with a NULL key component are rejected (a NULL key never matches, so it
    would be re-inserted every run). Returns ``(new_rows, rejected)``.
    """
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    rejected = batch.filter(null_key)
    clean = dedupe_batch(batch.filter(~null_key), keys, version)
    existing = target.select(*keys)
    new_rows = clean.join(existing, list(keys), "left_anti")
    return new_rows, rejected


def merged_table(batch: DataFrame, target: DataFrame, keys: Sequence[str],
                 version: Sequence[str] | None = None) -> DataFrame:
    """``target`` plus the rows ``insert_if_absent`` would append: the table after the load."""
    new_rows, _ = insert_if_absent(batch, target, keys, version)
    return target.unionByName(new_rows.select(*target.columns))


def append_rows(df: DataFrame, path: str, partition_by: Sequence[str] = (), sort_within: Sequence[str] = ()) -> None:
    """Append to a Parquet table; files sorted inside each partition keep min/max stats tight.

    The ``rebalance`` hint clusters rows by the partition columns but lets AQE
    split a large partition value over several tasks and files (a plain
    ``repartition(year)`` would send a whole year to one task) and merge small
    ones, so the output files come out near the advisory size.
    """
    out = df.hint("rebalance", *partition_by)
    if sort_within:
        out = out.sortWithinPartitions(*sort_within)
    w = out.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def batch_partitions(target: DataFrame, batch: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """The partitions of ``target`` that ``batch`` can have keys in, as a filter that prunes
    the scan. ``partition_by`` must be functions of the key (a year of a date key, say). At
    most one row per partition of the batch comes to the driver, to become the filter."""
    if not partition_by:
        return target
    rows = batch.select(*partition_by).distinct().collect()
    if len(partition_by) == 1:
        return target.filter(F.col(partition_by[0]).isin([r[0] for r in rows]))
    wanted = F.lit(False)
    for r in rows:
        one = F.lit(True)
        for c in partition_by:
            one = one & (F.col(c) == F.lit(r[c]))
        wanted = wanted | one
    return target.filter(wanted)


def load_if_absent(batch: DataFrame, target_path: str, keys: Sequence[str], partition_by: Sequence[str] = (),
                   version: Sequence[str] | None = None, sort_within: Sequence[str] = (),
                   rejected_path: str | None = None) -> int:
    """Idempotent load of ``batch`` into the Parquet table at ``target_path``.

    New rows are computed against the files listed before the write starts and
    appended; the path being read is never overwritten. Of a partitioned target only
    the batch's partitions are read. Loading the same batch twice appends nothing the
    second time. Rows with a NULL key are appended to ``rejected_path`` if given.
    Returns the number of appended rows.
    """
    from orrery.session import path_exists
    spark = batch.sparkSession
    if path_exists(spark, target_path):
        target = batch_partitions(spark.read.parquet(target_path), batch, partition_by)
    else:
        target = batch.limit(0)
    new_rows, rejected = insert_if_absent(batch, target, keys, version)
    if rejected_path:
        append_rows(rejected, rejected_path)
    obs = Observation("load")
    new_rows = new_rows.select(*batch.columns).observe(obs, F.count(F.lit(1)).alias("rows"))
    append_rows(new_rows, target_path, partition_by, sort_within)
    return observed_rows(obs)


def observed_rows(obs: Observation, name: str = "rows") -> int:
    """The count that a write observed; 0 where the planner proved the frame empty, as it then drops the observation with it."""
    try:
        return int(obs.get[name])
    except Py4JJavaError as e:
        if "AssertionError" not in str(e.java_exception):
            raise
        return 0


def overwrite_staging(df: DataFrame, path: str) -> None:
    """Staging truncate-and-reload (L-02)."""
    df.write.mode("overwrite").parquet(path)
