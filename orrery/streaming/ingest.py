"""Incremental load of the raw zone (T-01, T-02).

New raw files are picked up by a file-source stream; each micro-batch is
loaded with the same insert-if-absent rule as the batch job, so a replayed
batch (after a failure, ``foreachBatch`` may run an epoch again) appends
nothing twice. ``trigger(availableNow=True)`` processes what has landed and
stops, which is the on-arrival / scheduled run; the checkpoint remembers
which files were done, so the next run sees only new files. When several runs
land in one micro-batch, the earliest run wins for a key (ordered on the
``run`` column), the same first-writer rule as across micro-batches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from orrery.operators.load import dedupe_batch, load_if_absent
from orrery.schemas import RAW_OBSERVATION
from orrery.session import path_exists


def incremental_load(spark: SparkSession, raw_root: str, target: str, checkpoint: str, keys: Sequence[str],
                     partition_by: Sequence[str] = (), files_per_batch: int = 1000,
                     available_now: bool = True, processing_time: str | None = None):
    """Stream ``raw_root`` (run-partitioned Parquet) into ``target`` with insert-if-absent.

    Rows with a NULL in a key go to ``{target}-rejected``. Returns the finished query when ``available_now`` (default), else the running query.
    """
    schema = spark.read.parquet(raw_root).schema  # includes the discovered ``run`` column
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
              .option("basePath", raw_root).parquet(raw_root))

    def upsert(batch: DataFrame, epoch_id: int) -> None:
        first = dedupe_batch(batch, list(keys), ["run"], earliest=True) if "run" in batch.columns else batch
        load_if_absent(first.drop("run"), target, list(keys), list(partition_by), rejected_path=f"{target}-rejected")

    w = stream.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint)
    if available_now:
        q = w.trigger(availableNow=True).start()
        q.awaitTermination()
        return q
    return w.trigger(processingTime=processing_time or "30 seconds").start()


def ingest_landing(spark: SparkSession, landing: str, raw_root: str, checkpoint: str, run_id: str,
                   indicator_from_path: str = r"([^/]+)\.json$", source: str = "World Bank",
                   files_per_batch: int = 100):
    """Landed payload files -> raw zone, on arrival (T-01 with S-01).

    Each new file in ``landing`` is one ``[meta, rows]`` document; the
    indicator code is taken from its file name. Rows are flattened with the
    batch parser and appended to the raw zone under ``run=<run_id>``. The
    checkpoint records which files were ingested, so a re-run reads only new
    files. Runs with ``availableNow`` and returns the finished query.
    """
    from pyspark.sql import functions as F

    from orrery.sources.payload import flatten_payload

    docs = (spark.readStream.format("text").option("wholetext", True).option("maxFilesPerTrigger", files_per_batch)
            .load(landing)
            .select(F.col("value").alias("text"),
                    F.regexp_extract(F.input_file_name(), indicator_from_path, 1).alias("indicator_code")))
    raw = flatten_payload(docs, "text", "indicator_code", source=source, run_id=run_id).withColumn(
        "run", F.lit(run_id))
    q = (raw.writeStream.format("parquet").option("path", raw_root).option("checkpointLocation", checkpoint)
         .partitionBy("run").outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return q


#: Columns of the tables of ``ingest_checked``, besides run and batch.
ZONE = {"raw": RAW_OBSERVATION, "rejected": RAW_OBSERVATION,
        "quarantine": StructType([StructField(c, StringType()) for c in ("indicator_code", "reason", "text")]),
        "pages": StructType([StructField("indicator_code", StringType()), StructField("page", IntegerType()), StructField("pages", IntegerType()),
                             StructField("total", LongType()), StructField("rows", LongType())])}


def read_zone(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table of ``ingest_checked``, also where nothing has come into it yet."""
    schema = StructType([*ZONE[table].fields, StructField("run", StringType()), StructField("batch", LongType())])
    path = f"{root}/{table}"
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)


def ingest_checked(spark: SparkSession, landing: str, root: str, checkpoint: str, run_id: str, source: str = "World Bank",
                   loaded_at: str | None = None, files_per_batch: int = 100):
    """Landed payloads to four tables in one stream (T-01 with S-01, D-05, D-08).

    ``landing`` holds text files with one ``[meta, rows]`` document a line, under ``indicator_code=<code>`` folders.
    Each micro-batch writes ``{root}/raw`` (rows with a country and a period), ``{root}/rejected`` (rows without),
    ``{root}/quarantine`` (documents and rows that do not parse, with the reason) and ``{root}/pages`` (what each
    document declares). All four are partitioned by run and micro-batch, and a micro-batch overwrites its own
    partitions, so one that is run again after a failure adds nothing. Returns the finished query.
    """
    from pyspark.sql import functions as F

    from orrery.sources.payload import flatten_payload, payload_pages, payload_quarantine

    docs = (spark.readStream.schema("value string, indicator_code string").format("text").option("maxFilesPerTrigger", files_per_batch)
            .load(landing).withColumnRenamed("value", "text"))

    def take_in(batch: DataFrame, epoch_id: int) -> None:
        batch = batch.persist()  # a micro-batch of documents, read by four sinks

        def put(rows: DataFrame, table: str) -> None:
            (rows.withColumns({"run": F.lit(run_id), "batch": F.lit(epoch_id)}).hint("rebalance").write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("run", "batch").parquet(f"{root}/{table}"))

        try:
            rows = flatten_payload(batch, "text", "indicator_code", source, run_id, F.lit(loaded_at) if loaded_at else None)
            keyless = (F.coalesce(F.trim("country_code_2"), F.lit("")) == "") | (F.coalesce(F.trim("period"), F.lit("")) == "")
            put(rows.filter(~keyless), "raw")
            put(rows.filter(keyless), "rejected")
            put(payload_quarantine(batch, "text", "indicator_code"), "quarantine")
            put(payload_pages(batch, "text", "indicator_code"), "pages")
        finally:
            batch.unpersist()

    q = docs.writeStream.foreachBatch(take_in).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q
