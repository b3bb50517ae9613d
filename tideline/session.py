"""Session set-up shared by every operator."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_UTC_NAMES = {"UTC", "Etc/UTC", "GMT", "Etc/GMT", "Z", "+00:00", "Zulu", "Universal"}

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Follow the advisory size when AQE merges shuffle partitions, so that a
    # big cluster does not write one tiny file per core.
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # A daily load writes one or two days: keep a writer open for each
    # instead of sorting the wide rows by day first.
    "spark.sql.maxConcurrentOutputFileWriters": "4",
    # Remove checkpoint files once nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app: str = "tideline", **conf: str) -> SparkSession:
    """Get or create a session with the settings this package relies on.

    Extra settings are given with underscores for dots:
    ``build_session(spark_sql_shuffle_partitions="8")``; they win over the defaults.
    """
    settings = _DEFAULTS | {name.replace("_", "."): value for name, value in conf.items()}
    builder = SparkSession.builder.appName(app)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def check_session(spark: SparkSession) -> None:
    """Refuse to work with local times unless the session zone is UTC."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in _UTC_NAMES:
        raise ValueError(
            f"spark.sql.session.timeZone is {zone!r}; set it to 'UTC', "
            "otherwise wall-clock columns are read in the wrong zone"
        )


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, taken from ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured.rstrip("/")
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the whole cluster")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tideline-"))
    return context.getCheckpointDir().rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/tideline/{label}-{uuid.uuid4().hex}"


def scratch_database(spark: SparkSession, name: str = "tideline_staging") -> str:
    """Database whose managed tables live in the shared folder."""
    spark.sql(
        f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{shared_folder(spark)}/tideline/{name}'"
    )
    return name


def new_table(spark: SparkSession, label: str) -> str:
    """Unused table name in the scratch database."""
    return f"{scratch_database(spark)}.{label}_{uuid.uuid4().hex}"
