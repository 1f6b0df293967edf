"""SparkSession construction and shared-folder helpers."""

from __future__ import annotations

import math
import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: UTC timestamps (stable text output), AQE for
# runtime re-planning (coalescing, skew-join splitting, broadcast conversion
# from *measured* shuffle sizes), and no web UI.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only what AQE measured to be small at runtime.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    # HotSpot does not JIT-compile methods above 8000 bytes of bytecode; let
    # Spark split such code instead of running it interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Cached relations keep their hash partitioning, so operators above a
    # persisted, repartitioned input need no second shuffle.
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "false",
    # Checkpoint files go when their DataFrame does.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# SQL settings the queries rely on, also set on sessions created elsewhere by
# ``configure``. The caller's broadcast thresholds are left alone.
RUNTIME_KEYS = [
    "spark.sql.session.timeZone",
    "spark.sql.adaptive.enabled",
    "spark.sql.adaptive.coalescePartitions.enabled",
    "spark.sql.adaptive.skewJoin.enabled",
    "spark.sql.codegen.hugeMethodLimit",
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning",
]

# Shuffled MB that AQE joins into one task, at most: the sorts of the history
# hold some 15 times as much in memory (64 MB, Spark's default, took 0.9 GB).
ADVISORY_SIZE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
TASK_BYTES = 16 << 20

# MB of a file that one task reads, at most: a task that deals its rows to more
# than 200 partitions holds some 10 times as much in memory until it writes them.
READ_SIZE = "spark.sql.files.maxPartitionBytes"
READ_BYTES = 32 << 20

# Rows of a job's largest table per shuffle partition before AQE joins them.
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
ROWS_PER_PARTITION = 100_000


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the queries rely on (UTC text timestamps,
    AQE, the JIT-friendly codegen limit) to an existing session. A setting
    that cannot be changed raises: results would differ silently. AQE's task
    size is lowered to TASK_BYTES and the file splits to READ_BYTES; a caller's
    smaller ones are left alone."""
    for key, most in ((ADVISORY_SIZE, TASK_BYTES), (READ_SIZE, READ_BYTES)):
        size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))
        if size > most:
            spark.conf.set(key, str(most))
    for k in RUNTIME_KEYS:
        if spark.conf.get(k, None) != BASE_CONF[k]:
            spark.conf.set(k, BASE_CONF[k])
    return spark


def size_shuffles(spark: SparkSession, rows: int) -> None:
    """Deal shuffles into partitions in proportion to the ``rows`` of a job's
    largest table. AQE joins small partitions up to TASK_BYTES, but a window's
    partition cannot be divided, so with a fixed number of them a task's sorts
    grow with the table. A larger number that is set already is left alone."""
    have = spark.conf.get(INITIAL_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions")
    want = math.ceil(rows / ROWS_PER_PARTITION)
    if want > int(have):
        spark.conf.set(INITIAL_PARTITIONS, str(want))


def build_session(
    master: str | None = None,
    app_name: str = "linecast",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session with the project defaults applied.

    ``master`` is only set when given (on a cluster spark-submit decides).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # local mode: the driver JVM is the only executor
            builder = builder.config("spark.driver.host", "127.0.0.1").config(
                "spark.driver.memory", os.environ.get("LINECAST_DRIVER_MEMORY", "8g")
            )
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder comes from the session configuration and must be a
    shared file system. Only when it is unset (local runs and tests) a scratch
    folder is created here.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = sc.master or ""
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder "
                "(HDFS/S3/ABFS) so checkpoints survive executor loss"
            )
        configured = tempfile.mkdtemp(prefix="linecast-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
