"""Session helpers: where checkpoints and written intermediate tables go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SETTING = "spark.checkpoint.dir"

# Largest table that is sent whole to every executor or gathered on the driver.
SMALL_BYTES = 64 << 20


def checkpoint_folder(spark: SparkSession) -> str:
    """Return the shared folder for checkpoints, and make sure Spark uses it.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session
    without the setting gets a folder of its own; on a cluster a folder on one
    machine would be lost with that machine, so a missing setting is an error.
    """
    context = spark.sparkContext
    named = spark.conf.get(_SETTING, None)
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named
    current = context.getCheckpointDir()
    if current:
        return current
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tallyspan-"))
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to reliable storage and cut its lineage."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for a written intermediate table, beside the checkpoints."""
    return f"{checkpoint_folder(spark).rstrip('/')}/tallyspan-{uuid.uuid4().hex}/{name}"


def broadcast_if_small(df: DataFrame, rows: int, row_bytes: int = 64) -> DataFrame:
    """Hint a broadcast of ``df`` when its known size allows it.

    A larger table is left as it is, and Spark joins it by shuffling.
    """
    return F.broadcast(df) if rows * row_bytes <= SMALL_BYTES else df


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` as a table in the shared folder, read again, and where it is; see :func:`discard`."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table at a :func:`scratch_path`, with the folder made for it, when nothing reads it any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path).getParent()
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
