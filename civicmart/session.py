"""Session construction and lineage helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. Session time zone UTC makes TIMESTAMP <-> text conversions
# independent of the host; AQE re-plans joins and coalesces shuffle partitions at run time,
# and splits skewed join partitions.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # coalesce shuffle output to the advisory size (64 MB) rather than keeping many tiny
    # partitions: fewer tasks per stage on a busy cluster
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot key even where later joins reuse the partitioning (one more shuffle, then only)
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # static: no Python call-site capture on every DataFrame call (error context only);
    # halves the time to build large plans from Python
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # checkpoints go when the last result that reads them does
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str = "local[*]",
    app_name: str = "civicmart",
    shuffle_partitions: int = 8,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Local/test session. On a cluster use the cluster's session and :func:`configure`."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings the jobs rely on to an existing (cluster) session."""
    for k, v in BASE_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is; when it
    is missing there, this fails rather than falling back to a machine-local folder. Only in
    local mode (tests) with the setting unset is a fresh scratch folder created.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote (Connect) sessions have no SparkContext
        if configured:
            return configured
        raise RuntimeError("spark.checkpoint.dir must name a shared folder") from None
    current = configured or sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="civicmart-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable, eager checkpoint into the shared checkpoint folder (never a local one).

    Used before overwriting data that the plan itself reads, so that the rewrite no longer
    depends on the files it replaces and survives executor loss.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def recommended_settings(shuffle_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Partition sizing for a cluster run whose largest shuffle moves ``shuffle_bytes``.

    That is what is left after column pruning, filters and partial aggregation, not the input:
    blocks number map tasks times partitions, so a count taken from 100 TB of input would drown
    a job that shuffles 1 TB of it. The initial partition count is the larger of those bytes in
    pieces of ``target_partition_bytes`` and 4x the cores; AQE then coalesces down to 128 MB
    and splits skewed partitions. 1 TB on 1,000 cores: 4,096 partitions.
    """
    pieces = -(-shuffle_bytes // target_partition_bytes)
    partitions = max(4 * total_cores, pieces)
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
    }
