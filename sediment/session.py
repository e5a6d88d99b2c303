"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SCRATCH: list[str] = []


def build_session(app_name: str = "sediment", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, UTC timestamps and Arrow transfer switched on."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Folder for written intermediate tables, shared by all executors.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session without that
    setting falls back to a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="sediment-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unused path below the scratch folder."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` once to the scratch folder and return the written table.

    Cuts the lineage on storage that outlives an executor, and later readers prune columns.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release_scratch(spark: SparkSession) -> int:
    """Delete the scratch tables this process has written; frames that read them end with it."""
    removed = 0
    while _SCRATCH:
        path = spark._jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        removed += bool(fs.delete(path, True))
    return removed
