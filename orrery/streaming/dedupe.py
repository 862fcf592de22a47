"""Streaming dedupe of repeated observations (T-04).

The same observation can come with every run, hours or days after its first delivery, and
a first delivery can be late as well. So nothing is decided by a watermark: each
micro-batch is reduced to one row per id and appended where the target does not hold the
id yet. The target is partitioned by the day of the event time, which copies share, so a
micro-batch reads the days it has rows of and no others. A replayed micro-batch appends
nothing twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.operators.load import load_if_absent

DAY = "day"


def dedupe_events(spark: SparkSession, landing: str, target: str, checkpoint: str, id_col: str = "event_id", ts: str = "ts",
                  files_per_batch: int = 1000):
    """Append what is new in the files at ``landing`` since the last call to ``target``, each id once.

    Rows without an id or a time go to ``{target}-rejected``. Returns the finished query.
    """
    stream = (spark.readStream.schema(spark.read.parquet(landing).schema).option("maxFilesPerTrigger", files_per_batch)
              .parquet(landing).withColumn(DAY, F.to_date(ts)))

    def append_new(batch: DataFrame, epoch_id: int) -> None:
        load_if_absent(batch, target, [id_col, DAY], [DAY], rejected_path=f"{target}-rejected")

    q = (stream.writeStream.foreachBatch(append_new).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q
