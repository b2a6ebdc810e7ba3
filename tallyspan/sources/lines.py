"""Text sources and sinks, one row per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyspan.session import broadcast_if_small, checkpointed


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One ``value STRING`` row per line of a file, folder or glob."""
    return spark.read.text(path)


def write_lines(df: DataFrame, line: Column | str, path: str) -> None:
    """Write one text line per row, in the row order of ``df``."""
    line = F.col(line) if isinstance(line, str) else line
    df.select(line.alias("value")).write.text(path)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(position, value)``: lines numbered from 0 in file order.

    The lines are written once with their file split and their place in it, as
    a cluster that gains or loses executors may split files differently the
    next time it reads them. They are never sorted or shuffled: a running sum
    over the line counts of the splits (one row per 128 MB or so of input)
    gives the position where each split starts. That short table is broadcast,
    or joined if it is not short. Several files follow one another by path.
    """
    lines = checkpointed(
        spark.read.text(path).select(
            "value",
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("mark"),
        )
    )
    splits = lines.groupBy("file", "block").agg(
        F.count(F.lit(1)).alias("lines"), F.min("mark").alias("first_mark")
    )
    before = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    starts = checkpointed(
        splits.select(
            "file",
            "block",
            "first_mark",
            F.coalesce(F.sum("lines").over(before), F.lit(0)).alias("start"),
        )
    )
    starts = broadcast_if_small(starts, starts.count(), row_bytes=256)
    return lines.join(starts, ["file", "block"]).select(
        (F.col("start") + F.col("mark") - F.col("first_mark")).alias("position"), "value"
    )
