"""Session helpers: a local session for tests and bench, and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "8g", app: str = "orrery",
                  checkpoint_dir: str | None = None) -> SparkSession:
    """Session for tests and the bench. On a cluster, use the cluster's own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if checkpoint_dir:
        builder = (builder.config("spark.checkpoint.dir", checkpoint_dir)
                   .config("spark.sql.warehouse.dir", f"{checkpoint_dir.rstrip('/')}/warehouse"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_conf(input_bytes: int, target_partition_bytes: int = 256 << 20, executors: int = 1000,
                 cores_per_executor: int = 8) -> dict[str, str]:
    """Settings for a cluster run over ``input_bytes`` of Parquet.

    Shuffle partitions are sized so a partition of the largest shuffle (about
    the input size after projection) stays near ``target_partition_bytes``,
    and never fall below two waves of the cluster's cores; AQE then coalesces
    small partitions and splits skewed ones at run time. Broadcasts stay at the
    default size check (10 MB), which only the dimension-sized sides pass.
    """
    cores = executors * cores_per_executor
    partitions = max(2 * cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(10 << 20),
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.session.timeZone": "UTC",
        # streaming state (dedupe ids, latest-per-key) kept off-heap, with incremental checkpoints
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        # checkpoint() files are removed once their data is no longer referenced
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` is read from the session; only when it is unset
    (local tests) is a temporary folder created and registered.
    """
    return f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder: ``spark.checkpoint.dir`` if set, else the
    context's checkpoint folder; only when neither is set a temporary folder is
    created, and only under a local master: elsewhere that raises. The folder is also registered as the context's
    checkpoint folder when none is registered, so ``checkpoint()`` works."""
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="orrery-run-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base.rstrip("/")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on its file system (local, HDFS or object store)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
