"""Class counts and partition statistics of keyed objects ``(i, gamma)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.functions.keys import partition_key
from tallyspan.session import checkpointed


def with_partition_key(
    objects: DataFrame, parts: int, key: str = "i", signed: bool = False
) -> DataFrame:
    """Add ``part``, the key modulo the number of parts."""
    return objects.withColumn("part", partition_key(key, parts, signed))


def with_physical_part(df: DataFrame, parts: int | None = None) -> DataFrame:
    """Add ``part``, the number of the Spark partition that holds the row.

    With ``parts`` the rows are first dealt out evenly over that many
    partitions; without it they stay where the scan put them.
    """
    if parts is not None:
        df = df.repartition(parts)
    return df.withColumn("part", F.spark_partition_id().cast("bigint"))


def count_per_part(objects: DataFrame, class_col: str = "gamma") -> DataFrame:
    """First round: ``(part, gamma, n)``, the count of each class in each part."""
    return objects.groupBy("part", class_col).agg(F.count(F.lit(1)).alias("n"))


def class_count(
    objects: DataFrame,
    plan: str = "single",
    parts: int | None = None,
    key: str = "i",
    class_col: str = "gamma",
) -> DataFrame:
    """``(gamma, n)``: objects per class, sorted by class.

    ``single`` aggregates once, ``two_round`` first within ``key mod parts``,
    ``physical`` first within Spark partitions. The answer is the same; the
    first moves the least data, as Spark combines before its one shuffle.
    """
    if plan == "single":
        counts = objects.groupBy(class_col).agg(F.count(F.lit(1)).alias("n"))
    elif plan in ("two_round", "physical"):
        if plan == "two_round":
            keyed = with_partition_key(objects, parts or 1, key)
        else:
            keyed = with_physical_part(objects, parts)
        counts = count_per_part(keyed, class_col).groupBy(class_col).agg(F.sum("n").alias("n"))
    else:
        raise ValueError(f"unknown plan {plan!r}")
    return counts.orderBy(class_col)


def partition_sizes(keyed: DataFrame, parts: int) -> DataFrame:
    """``(part, size)`` for parts 0 to parts-1, 0 for an empty one."""
    sizes = keyed.groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    every = keyed.sparkSession.range(parts).select(F.col("id").alias("part"))
    return every.join(sizes, "part", "left").select(
        "part", F.coalesce("size", F.lit(0)).cast("bigint").alias("size")
    )


def max_partition_size(keyed: DataFrame) -> DataFrame:
    """One row with the size of the largest part, NULL without any object."""
    sizes = keyed.groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    return sizes.agg(F.max("size").alias("max_partition_size"))


def most_frequent(counts: DataFrame, class_col: str = "gamma", count_col: str = "n") -> DataFrame:
    """The row with the largest count; of equal counts the first class in order."""
    return counts.orderBy(F.desc(count_col), F.asc(class_col)).limit(1)


def group_values(
    objects: DataFrame,
    key_col: str = "gamma",
    value_col: str = "i",
    chunk_rows: int = 4096,
) -> DataFrame:
    """``(key, chunk, values)``: all values of each key, uncombined.

    A key's values, in order, are cut into chunks of ``chunk_rows`` rows, the
    last one shorter, so a key that holds a third of the table is spread over
    many tasks whatever its values are. Values ascend within a chunk and from
    chunk to chunk; NULL values are left out.

    The values are range-sorted and written once, equal ones dealt out too; the
    rows of each key in each sorted partition then give the key's first
    position in the next.
    """
    rows = objects.select(key_col, value_col).filter(F.col(value_col).isNotNull())
    mark = F.monotonically_increasing_id()
    # rows of equal key and value are the same, so any order of them will do
    ordered = rows.withColumn("_tie", mark).orderBy(key_col, value_col, "_tie").drop("_tie")
    placed = checkpointed(ordered.withColumn("_mark", mark))
    split = placed.withColumn("_split", F.shiftright("_mark", 33))
    runs = split.groupBy(key_col, "_split").agg(
        F.min("_mark").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    before = Window.partitionBy(key_col).orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select(
        F.col(key_col).alias("_key"),
        F.col("_split").alias("_part"),
        "_first",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
    )
    same = split[key_col].eqNullSafe(starts["_key"]) & (split["_split"] == starts["_part"])
    position = F.col("_before") + F.col("_mark") - F.col("_first")
    chunk = F.call_function("div", position, F.lit(chunk_rows)).alias("chunk")
    return (
        split.join(starts, same)
        .select(key_col, chunk, value_col)
        .groupBy(key_col, "chunk")
        .agg(F.sort_array(F.collect_list(value_col)).alias("values"))
    )
