"""Session settings shared by every job."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str = "barflow", master: str | None = None, **settings) -> SparkSession:
    """Create (or reuse) a session; ``settings`` use ``__`` for the dots of a key."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in RUNTIME_SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def pin_settings(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session somebody else built."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    A temporary folder is used only in local mode, where driver and executors are
    one process; on a cluster a missing setting is an error.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    current = sc.getCheckpointDir()
    if configured:
        if current is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if current is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="barflow-"))
        current = sc.getCheckpointDir()
    return current.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder for a table a job writes and reads back."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def path_exists(spark: SparkSession, path: str) -> bool:
    files, place = _file_system(spark, path)
    return files.exists(place)


def mark_path(spark: SparkSession, path: str) -> None:
    """Make an empty folder that says a step is done."""
    files, place = _file_system(spark, path)
    files.mkdirs(place)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a table that this code wrote below the shared folder."""
    files, place = _file_system(spark, path)
    files.delete(place, True)


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """Hash-partition rows that are few but costly to process.

    With the number given, adaptive execution does not merge the partitions by their small size,
    so the work stays spread over the cluster.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(partitions, *columns)
