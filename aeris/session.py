"""Session construction and the shared scratch folder.

On a cluster the caller owns the session; ``build_session`` is for tests,
the bench and local runs.  Lineage cuts and stream checkpoints go under the
folder named by ``spark.checkpoint.dir`` (a shared, fault-tolerant store on a
cluster).  Only when that setting is absent (tests, local runs) do we pick a
folder of our own.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Starting point for a large cluster (hundreds of executors, ~100 TB inputs).
# Shuffles start wide and AQE coalesces them to ~256 MB partitions, so no
# reduce task holds more than a few hundred MB whatever the data size; scans
# split files into 512 MB tasks; skewed join partitions (5x the median and
# above 512 MB) are split; a join side is broadcast when its size is known or
# measured to be below 64 MB.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
}


def apply_cluster_conf(spark: SparkSession, overrides: dict[str, str] | None = None) -> None:
    """Set the SQL-level settings above on a running session (static ones belong in spark-submit)."""
    for key, value in {**CLUSTER_CONF, **(overrides or {})}.items():
        spark.conf.set(key, value)


def build_session(
    master: str = "local[8]",
    shuffle_partitions: int = 8,
    app_name: str = "aeris",
    driver_memory: str = "16g",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; a local one is made only for a local master that names none."""
    current = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return current.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors of {master} share")
    local = tempfile.mkdtemp(prefix="aeris-ckpt-", dir=os.environ.get("AERIS_SCRATCH", "/tmp"))
    spark.conf.set(CHECKPOINT_CONF, local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for one job."""
    return f"{ensure_checkpoint_dir(spark)}/aeris/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df, name: str, paths: list[str] | None = None):
    """Write ``df`` as parquet under the shared checkpoint folder and read it back.

    This cuts the lineage at a stage boundary: later jobs (statistics, the
    final write) read the written table instead of recomputing the shuffles above it, and
    a lost executor cannot force that recomputation either.  The folder is
    appended to ``paths``; hand that list to ``remove_paths`` when the results are written.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if paths is not None:
        paths.append(path)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def remove_paths(spark: SparkSession, paths: list[str]) -> None:
    """Delete folders of ``materialize`` on whatever file system they are."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)
    paths.clear()
