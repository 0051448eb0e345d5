"""SparkSession defaults and the checkpoint-folder rule.

Cluster jobs read ``spark.checkpoint.dir`` from the session (a shared folder the cluster names).
Only when it is unset (tests, local runs) do we set one of our own.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Session settings this library relies on; applied with ``setdefault`` semantics.
SQL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Timestamps are TIMESTAMP_NTZ end to end; UTC keeps any stray conversion zone-free.
    "spark.sql.session.timeZone": "UTC",
}


# Cluster settings applied only where the user has not set them (``apply_cluster_defaults``).
# Sizing for ~100 TB of events: the largest shuffle (exposure dedupe) carries ~4e11 rows x ~60 B
# ~ 24 TB before the map-side top-1 cuts it; at a 256 MB advisory size that needs ~100k reduce
# partitions. AQE can merge partitions but not split them (except skewed joins), so the initial
# count is sized for the largest shuffle and AQE coalesces every smaller one toward 256 MB.
# Scans split at 512 MB (100 TB -> ~200k tasks, ~25 waves on 8,000 cores).
CLUSTER_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "100000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.shuffle.partitions": "16384",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def apply_cluster_defaults(spark: SparkSession, force: bool = False) -> None:
    """Set each CLUSTER_DEFAULTS key unless the session already carries an explicit value.

    Local masters keep their own settings (100k shuffle partitions make no sense on one machine)
    unless ``force`` is set.
    """
    ensure_checkpoint_dir(spark)
    if spark.sparkContext.master.startswith("local") and not force:
        return
    for k, v in CLUSTER_DEFAULTS.items():
        if not spark.conf.isModifiable(k):
            continue
        explicit = spark.sparkContext.getConf().contains(k)
        if not explicit:
            spark.conf.set(k, v)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "abx") -> SparkSession:
    """A local session for tests and benchmarks (UI off, no server ports beyond Spark's own)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in SQL_DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, creating a local one only if none is configured."""
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(conf_dir)
        return conf_dir
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        # A folder of the driver's machine would be out of reach of the executors.
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    # Unset (local/test run only): a fresh scratch folder.
    local_dir = tempfile.mkdtemp(prefix="abx-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", local_dir)
    spark.sparkContext.setCheckpointDir(local_dir)
    return local_dir


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)
