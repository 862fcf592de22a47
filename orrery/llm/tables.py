"""Tables between steps, written in the cluster's shared folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_dir


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs inside go when it ends. Spark otherwise keeps them until the driver's garbage
    collector meets their query, so the disk would hold those of all steps at once."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written as Parquet under ``spark.checkpoint.dir`` and read again: cuts lineage, and survives lost executors."""
    spark = df.sparkSession
    path = work_dir(spark, purpose)
    with tidy(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def aside(df: DataFrame, own: tuple[str, ...], made: tuple[str, ...] = ()) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df`` with all columns but ``own`` under names that no step uses, and without those of the names ``made``;
    and a function that gives a result, which holds the former and the columns ``made``, the names and the order of ``df``
    back, new columns last. So a caller's columns may have any names."""
    mine, new = {c.lower() for c in own}, {c.lower() for c in made}
    names = {c: c if c.lower() in mine else f"__aside_{i}" for i, c in enumerate(df.columns)}
    moved = df.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items() if c.lower() in mine or c.lower() not in new])

    def back(result: DataFrame) -> DataFrame:
        there = [F.col(f"`{c if c.lower() in new else names[c]}`").alias(c) for c in df.columns]
        held = {c.lower() for c in df.columns}
        return result.select(*there, *[F.col(f"`{m}`") for m in made if m.lower() not in held])

    return moved, back


def keyed(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """``docs`` with the hashes _d1 and _d2 of id and text, which name a document."""
    own = (F.col(f"`{id_column}`"), F.col(f"`{text}`").cast("string"))
    return docs.withColumn("_d1", F.xxhash64(*own)).withColumn("_d2", F.xxhash64(F.lit(1), *own))
