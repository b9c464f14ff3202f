"""Settings the jobs rely on, and the shared folder for intermediate results."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

from .errors import JobError


def _checkpoint_setting(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")


def _own_folder(spark: SparkSession) -> str:
    """A folder of this machine, which is enough only where all tasks run on it."""
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise JobError(f'Set "spark.checkpoint.dir" to a folder that all executors of {master} share.')
    return tempfile.mkdtemp(prefix="sluice-")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """The cluster's own checkpoint folder; a fresh one only where none is named, as in tests."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(_checkpoint_setting(spark) or _own_folder(spark))


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """Path of a new folder, not yet created, that every executor can reach."""
    base = _checkpoint_setting(spark) or spark.sparkContext.getCheckpointDir() or _own_folder(spark)
    return os.path.join(base, f"{purpose}-{uuid.uuid4().hex}")


def build_session(app_name: str = "sluicegate", **settings: str) -> SparkSession:
    """Session with the settings the operators assume: wall times in UTC and adaptive plans."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.scheduler.mode", "FAIR")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
