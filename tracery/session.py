"""Spark session defaults for lineage jobs.

Only settings that change plans or results are set here. On a cluster the
session already exists and its own settings win; ``ensure_checkpoint_dir``
reads ``spark.checkpoint.dir`` from the session and only sets a scratch
folder when nothing is configured (local tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every lineage job relies on (set at runtime, so they also apply to
# an existing cluster session).
RUNTIME_CONF = {
    # N10 formats event times as UTC wall-clock text.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Joins on (execution_id, node_id) may reuse a partitioning on
    # execution_id alone: all per-execution work stays in one exchange.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # Lineage joins pair large per-execution tables that are bucketed alike;
    # sort-merge joins on the buckets need no exchange. Small sides are
    # broadcast explicitly, after their size is checked.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    # A task that writes few buckets or kinds keeps their files open instead of
    # sorting its rows by them first.
    "spark.sql.maxConcurrentOutputFileWriters": "4",
    # Written steps are read once or twice and then dropped: less disk for some CPU.
    "spark.sql.parquet.compression.codec": "zstd",
}


def apply_runtime_conf(spark: SparkSession, buckets: int = 1) -> SparkSession:
    """Sets ``RUNTIME_CONF``, and at least as many shuffle partitions as the data
    set has buckets, so a shuffle's partitions do not grow with the data either
    (adaptive execution joins small ones)."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    if buckets > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set("spark.sql.shuffle.partitions", str(buckets))
    return spark


def local_session(app_name: str = "tracery", cores: int | str = "*",
                  shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the local bench (no UI, no servers)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    apply_runtime_conf(spark)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the session names.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is used
    as is. Only when it is unset (local tests) is a fresh scratch folder made.
    """
    configured = spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="tracery-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", configured)
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tracery-{name}-{uuid.uuid4().hex[:12]}"


# Target input rows per bucket when sizing the bucket count of a data set.
ROWS_PER_BUCKET = 4_000_000


def bucket_count(spark: SparkSession, input_rows: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    """Buckets for one data set's lineage tables: as many as shuffle
    partitions or cores for small inputs (whichever are fewer), and about
    ``rows_per_bucket`` input rows each for large ones, so a bucket's size
    does not grow with the data."""
    least = min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return max(1, least, -(-input_rows // rows_per_bucket))


def write_table(frame, name: str, bucket_by: str | list[str] | None = None, buckets: int | None = None):
    """Cut lineage by writing ``frame`` under the shared checkpoint folder.

    Unlike a reliable RDD checkpoint this computes the frame once. With
    ``bucket_by`` the table is bucketed like the lineage inputs, so later joins
    on that key need no exchange. The frame should be partitioned like the
    buckets (``repartition(buckets, key)`` or joins of such tables): a task then
    writes one bucket, and there are not tasks times buckets files.
    """
    spark = frame.sparkSession
    table = f"tracery_{name}_{uuid.uuid4().hex}"
    path = scratch_path(spark, name)
    writer = frame.write.mode("overwrite").format("parquet").option("path", path)
    if bucket_by:
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        writer = writer.bucketBy(buckets, bucket_by)
    writer.saveAsTable(table)
    out = spark.table(table)
    out.written_as = (table, path)
    if bucket_by:
        out.dealt = ([bucket_by] if isinstance(bucket_by, str) else list(bucket_by), buckets)
    return out


def drop_written(frames) -> None:
    """Drop tables made by ``write_table`` and their files."""
    for frame in frames:
        table, path = frame.written_as
        frame.sparkSession.sql(f"drop table if exists {table}")
        delete_path(frame.sparkSession, path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote below the checkpoint folder."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
