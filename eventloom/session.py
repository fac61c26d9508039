"""Spark session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "eventloom",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the settings the engine relies on.

    On a cluster ``master`` is left to spark-submit; tests pass ``local[*]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_engine_conf(spark: SparkSession) -> None:
    """Session settings results depend on, applied to a session made elsewhere.

    Times are stamped and formatted in UTC; sinks overwrite only the
    partitions a batch writes (idempotent retries); finished jobs hold no disk.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    # A job's shuffle files go when it ends, not when the driver happens to collect garbage.
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    restore_settings(spark)
    ensure_checkpoint_dir(spark)
    ship_package(spark)


_KEPT = "eventloom.caller."


def remember_setting(spark: SparkSession, key: str, value: str) -> None:
    """Set ``key`` for the queries to come, until ``restore_settings``; plans are made after a query
    function returns, so it cannot be set back at its end."""
    if spark.conf.get(_KEPT + key, None) is None:
        spark.conf.set(_KEPT + key, spark.conf.get(key))
    spark.conf.set(key, value)


def restore_settings(spark: SparkSession) -> None:
    """The caller's values of what ``remember_setting`` changed."""
    for key in ("spark.sql.execution.arrow.maxRecordsPerBatch",):
        kept = spark.conf.get(_KEPT + key, None)
        if kept is not None:
            spark.conf.set(key, kept)
            spark.conf.unset(_KEPT + key)


def ship_package(spark: SparkSession) -> None:
    """Make ``eventloom`` importable in every Python worker, once per context.

    Workers unpickle UDFs by module name. The package is zipped into a
    temporary file of the driver, and ``addPyFile`` has Spark's file server
    hand it to the executors; no shared folder takes part.
    """
    import shutil

    sc = spark.sparkContext
    if getattr(sc, "_eventloom_shipped", False):
        return
    package_dir = os.path.dirname(os.path.abspath(__file__))
    base = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="eventloom-code-")), "eventloom_code")
    archive = shutil.make_archive(base, "zip", os.path.dirname(package_dir), "eventloom")
    sc.addPyFile(archive)
    sc._eventloom_shipped = True


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster names that folder. One is made up only where the session has
    none and the master is local (tests, one machine); anywhere else a folder
    of the driver's own would not be seen by the executors, so that raises.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not current:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="eventloom-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint root for written tables."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
