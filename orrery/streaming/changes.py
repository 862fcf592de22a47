"""Period-over-period changes over a stream of observations (W-01, W-02, D-01..D-03).

A change needs the observation before, which may come later than the one it scores, or be
revised after it. So the ordered series are the state: a versioned table with the latest
delivery of each observation and its changes, dealt over buckets of series. A micro-batch
takes its rows into the buckets of its series and scores these again, neighbours included, so
the state is at every moment what the batch windows would give over all rows so far, in
whatever order they came.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.operators.change import calendar_change, pct_change_prev
from orrery.operators.load import latest_version
from orrery.sources.versions import VersionedTable
from orrery.streaming.sources import stream_path


def scored(rows: DataFrame, keys: Sequence[str], index: str, value: str, steps: dict[str, int], scale: int = 4) -> DataFrame:
    """Rows with ``change_prev`` and a change per name of ``steps`` (so many periods earlier); one window order for all."""
    out = pct_change_prev(rows, keys, [index], value, "change_prev", scale, keep_prev=False)
    for name, step in steps.items():
        out = calendar_change(out, keys, index, value, step, name, scale)
    return out


def keep_changes(spark: SparkSession, source: str, root: str, checkpoint: str, keys: Sequence[str], index: str, value: str, version: Sequence[str],
                 steps: dict[str, int], buckets: int = 64, files_per_batch: int = 1000, available_now: bool = True, refresh: str = "30 seconds"):
    """Stream the observations at ``source`` (one row per series, period ``index`` and ``version``) into the scored state at ``root``.

    Rows without a key or a period go to ``{root}-rejected``, each micro-batch under its id."""
    schema = spark.read.parquet(source).schema
    columns = [*keys, index, value, *version]
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(stream_path(source))
    table = VersionedTable(spark, root)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")

    def take_in(batch: DataFrame, epoch_id: int) -> None:
        head = table.head()
        if head and int(head["label"]) >= epoch_id:
            return
        bad = F.lit(False)
        for c in (*keys, index):
            bad = bad | F.col(c).isNull()
        batch.filter(bad).write.mode("overwrite").parquet(f"{root}-rejected/batch={epoch_id}")
        rows = batch.filter(~bad).select(columns)
        touched = [r["b"] for r in rows.select(bucket.alias("b")).distinct().collect()]  # at most one row a bucket
        if not touched:
            return
        before = table.read(touched)
        if before is not None:
            rows = rows.unionByName(before.select(columns))
        newest = latest_version(rows, [*keys, index], [*version, value])
        table.publish(scored(newest, keys, index, value, steps), bucket, touched, str(epoch_id), (*keys, index))
        table.vacuum()

    w = stream.writeStream.foreachBatch(take_in).option("checkpointLocation", checkpoint)
    if available_now:
        q = w.trigger(availableNow=True).start()
        q.awaitTermination()
        return q
    return w.trigger(processingTime=refresh).start()
