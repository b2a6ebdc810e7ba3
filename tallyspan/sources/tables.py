"""Tables as they are read."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread_over_cores(table: DataFrame) -> DataFrame:
    """Deal a small table out over the cores, before work that outweighs reading.

    For a table as it is read from files. One that Spark reads in fewer tasks
    than half the cores is shuffled once, evenly; it is no larger than that
    many file splits. Any other table stays where it is.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table.repartition(cores) if 2 * table.rdd.getNumPartitions() <= cores else table
