"""Session settings and the few cluster-aware helpers the operators share."""

from __future__ import annotations

import gc
import tempfile
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows up to which a lookup side may be broadcast. The size is checked at run time.
BROADCAST_ROWS = 200_000


def build_session(app: str = "loamline", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings every operator relies on (UTC days, AQE with skew joins)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session, as in tests,
    may fall back to a folder of this machine.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="loamline-checkpoint-"))
    return sc.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: computed once, survives the loss of executors."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def scratch_dir(spark: SparkSession) -> str:
    """Folder of this application below the shared folder; ``clear_scratch`` removes it."""
    return f"{checkpoint_dir(spark).rstrip('/')}/loamline-{spark.sparkContext.applicationId}"


_PASSING = threading.local()


def stored(df: DataFrame) -> DataFrame:
    """The frame as a Parquet table in the shared folder: computed once, lineage cut there.

    Unlike a checkpoint the table has a known size, so joins with it are planned right, and its
    readers take only the columns they need.
    """
    uri = f"{scratch_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(uri)
    if getattr(_PASSING, "uris", None) is not None:
        _PASSING.uris.append(uri)
    return df.sparkSession.read.schema(df.schema).parquet(uri)


def stored_alone(
    spark: SparkSession, made: Callable[[], DataFrame], keep: Callable[[DataFrame], DataFrame] = stored
) -> DataFrame:
    """What ``made`` returns, stored by ``keep``; the tables that this thread stored on the way and the
    shuffles of their plans are removed from the disks at once.

    Spark deletes a shuffle's files when the driver's garbage collector finds it unused, which on
    a driver with room to spare may be long after the plan is done.
    """
    outer, _PASSING.uris = getattr(_PASSING, "uris", None), []
    try:
        df, passing = made(), _PASSING.uris
    finally:
        _PASSING.uris = outer
    table = keep(df)
    del df
    for uri in passing:
        remove(spark, uri)
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return table


def remove(spark: SparkSession, uri: str) -> None:
    """Removes a folder; frames read from there end with it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def clear_scratch(spark: SparkSession) -> None:
    """Removes all that this application has stored; frames read from there end with it."""
    remove(spark, scratch_dir(spark))


def bounded_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, weight: Column | None = None
) -> DataFrame:
    """Broadcast hint only if the side is counted to hold at most ``max_rows`` rows.

    Where rows carry arrays, ``weight`` is their length, and the sum of the lengths is
    checked instead. Beyond the bound the plain frame is returned, so the join shuffles and
    adaptive execution splits skewed partitions.
    """
    if weight is None:
        size = df.limit(max_rows + 1).count()
    else:
        size = df.agg(F.sum(weight)).first()[0] or 0
    return F.broadcast(df) if size <= max_rows else df
