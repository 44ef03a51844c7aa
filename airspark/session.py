"""Session and shared-storage helpers.

Intermediate tables and checkpoints go under the folder the cluster names in
``spark.checkpoint.dir`` (a shared file system on a cluster).  A default is
set only when the session has none, as in local tests.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

LOCAL_DEFAULT_CHECKPOINT_DIR = "/tmp/airspark-checkpoints"


def get_session(master: str = "local[*]", shuffle_partitions: int = 8,
                driver_memory: str | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master)
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    spark = (
        builder
        .appName("airspark")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    tune_session(spark)
    return spark


def tune_session(spark: SparkSession) -> None:
    """Optimizer settings for wide feature plans.

    Constraint propagation infers predicates from every alias of every
    column; on 30+ column plans with many derived expressions it grows
    combinatorially and dominates planning (it ran a 1 GB driver out of
    heap).  It only adds inferred filters, so turning it off changes no
    result.
    """
    spark.conf.set("spark.sql.constraintPropagation.enabled", "false")
    # A series window bucket holds up to 8,192 + 23 rows: keep it in memory.
    spark.conf.set("spark.sql.windowExec.buffer.in.memory.threshold", "16384")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not sc.master.startswith(("local[", "local-cluster[")) and sc.master != "local":
        raise ValueError("Set spark.checkpoint.dir to a folder that all executors share.")
    sc.setCheckpointDir(configured or LOCAL_DEFAULT_CHECKPOINT_DIR)
    return sc.getCheckpointDir()


_SCRATCH: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/airspark/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release_scratch(spark: SparkSession) -> int:
    """Delete every folder that ``scratch_path`` has named in this application; returns how many there were.

    For a job's end: results that were not written elsewhere read these folders, so nothing here deletes them
    on its own.
    """
    paths = _SCRATCH.pop(spark.sparkContext.applicationId, [])
    there = [p for p in paths if path_exists(spark, p)]
    for p in there:
        drop_scratch(spark, p)
    return len(there)


def checkpoint(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut lineage with a written table in the shared checkpoint folder.

    One write, then a columnar read-back (pruning and pushdown still apply).
    Unlike ``Dataset.checkpoint`` this does not recompute the plan to save
    it, and the table survives executor loss like any shared file.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table folder exists (the only test for "not written yet")."""
    p = hadoop_path(spark, path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a folder made by ``scratch_path``; any other path is refused."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/airspark/"
    if not path.startswith(base):
        raise ValueError(f"Not a scratch folder: {path}")
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
