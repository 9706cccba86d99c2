"""Session construction and checkpoint-directory handling."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def cluster_conf(input_bytes: int, total_cores: int, target_partition_mb: int = 256) -> dict[str, str]:
    """Partition sizing for a cluster run.

    Shuffle partitions start at about one per ``target_partition_mb`` of
    input (at least 2 per core) and AQE coalesces them down at run time;
    scans split at the same size; skewed join partitions over 4× the median
    (and 1 GB) are split.  E.g. 100 TB on 8,000 cores gives ~400k
    partitions before coalescing.
    """
    target = target_partition_mb * 1024 * 1024
    parts = max(2 * total_cores, -(-input_bytes // target))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": f"{target_partition_mb}m",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{target_partition_mb}m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
    }


def build_session(master: str | None = None, app_name: str = "churnlens",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or fetch) a session with AQE on and UTC as session zone."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory of this session.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that value
    is always used.  Only a local-mode session without the setting (tests)
    gets a fresh scratch folder; a cluster without it is an error, because a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
    path = tempfile.mkdtemp(prefix="churnlens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def scratch_path(spark: SparkSession, kind: str, name: str) -> str:
    """A fresh folder under the session's shared checkpoint directory."""
    import uuid
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/churnlens/{kind}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df, name: str = "stage"):
    """Write ``df`` once as Parquet under the shared checkpoint folder and
    read it back: cuts lineage (a lost executor re-reads files instead of
    replaying the plan), and the read side has file statistics, column
    pruning and filter pushdown."""
    spark = df.sparkSession
    path = scratch_path(spark, "stages", name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
