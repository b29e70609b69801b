"""Session helpers for tests, the bench and the library's checkpoint needs."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tillscope") -> SparkSession:
    """A local session configured the way the tests and the bench expect.

    On a cluster use your own builder; the library only relies on
    ``spark.sql.session.timeZone=UTC`` (for date extraction from
    timestamps) and, for the distributed NTILE, ``spark.checkpoint.dir``.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.default.parallelism", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TILLSCOPE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    # tests and local runs: the given folder, else a fresh scratch folder per session
    ckpt = os.environ.get("TILLSCOPE_CHECKPOINT_DIR") or tempfile.mkdtemp(prefix="tillscope-ckpt-", dir="/tmp")
    builder = builder.config("spark.checkpoint.dir", ckpt)
    if not os.environ.get("TILLSCOPE_KEEP_WAREHOUSE"):
        builder = builder.config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tillscope-wh-", dir="/tmp"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Point the SparkContext at the shared checkpoint folder.

    The folder comes from the session setting ``spark.checkpoint.dir``
    (on a cluster: a shared, reliable file system).  Only when it is unset
    and Spark runs in local mode do we fall back to a fresh folder under
    /tmp; on a cluster an unset value is an error, since a machine-local
    folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; set it to a shared folder (HDFS/S3/ABFS) "
                "before running operators that cut lineage"
            )
        path = tempfile.mkdtemp(prefix="tillscope-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return path


def cluster_conf(input_bytes: int, executor_cores_total: int, target_partition_mb: int = 256) -> dict[str, str]:
    """Settings to size a cluster session for a given input volume.

    Shuffle partitions are chosen so that an all-to-all shuffle of the whole
    input lands near ``target_partition_mb`` per reducer (bounded below by
    2× the cores, so every core has work); AQE then coalesces small ones
    and splits skewed ones.  Scan splits stay at 256 MB so a task's input
    fits comfortably in an executor's memory share.  Pass the result to
    ``SparkSession.builder.config(map=...)``; ``spark.checkpoint.dir`` must
    additionally name a shared, reliable folder.
    """
    target = target_partition_mb * 1024 * 1024
    partitions = max(2 * executor_cores_total, -(-input_bytes // target))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 * 1024 * 1024),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.session.timeZone": "UTC",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
