"""Session settings and the shared folder used for written intermediate tables."""

from __future__ import annotations

import hashlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}

SETTINGS = {
    # Dates and epoch seconds are UTC everywhere in the data model.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: join strategy, partition coalescing and skew splits
    # follow the sizes seen in the shuffles rather than the estimates.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Upserts replace only the partitions that a batch touches.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # A table of some decades of months is listed by the driver, without a job.
    "spark.sql.sources.parallelPartitionDiscovery.threshold": "1000",
}

# Settings that must be there when the session starts.
STATIC_SETTINGS = {
    # No call-site capture per column expression: it costs more than the planning.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_session(app_name: str = "satlake", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **STATIC_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that somebody else created."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, as named in spark.checkpoint.dir.

    Only a local-mode session without the setting gets a temporary folder: on
    a cluster a machine-local folder would be lost with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = context.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="satlake-")
        context.setCheckpointDir(_local_dirs[app])
    return _local_dirs[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing has been written to yet."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/satlake-{app}/{label}-{uuid.uuid4().hex[:12]}"


def work_path(spark: SparkSession, table_path: str) -> str:
    """Folder below the shared one that belongs to a table and is used again."""
    digest = hashlib.sha256(table_path.encode()).hexdigest()[:16]
    return f"{shared_dir(spark)}/satlake-work/{digest}"


def widen(df: DataFrame) -> DataFrame:
    """Spread an input of fewer splits than cores over all cores.

    Meant for scans in front of heavy work per row; an input with enough
    splits is left as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
