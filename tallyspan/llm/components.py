"""Connected components by alternating large and small stars, one shuffle round after another."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.session import checkpointed


# Edges for each task of a round; few edges take few tasks.
EDGES = 250_000


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) of every node of the (a, b) ``edges``; a component is its smallest id.

    Nulls and loops are ignored, repeated and reversed edges allowed. Each
    round hangs every node's larger neighbours, then its smaller ones, on the
    smallest node it sees; rounds stop when the edges are stars. Joins meet a
    hub's edges with one row, so Spark can split a hub. Edges stay on the
    cluster.
    """
    links = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where(
        "a IS NOT NULL AND b IS NOT NULL AND a <> b"
    )
    links = checkpointed(links.distinct())
    tasks = -(-links.count() // EDGES)
    most = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def tight(df: DataFrame) -> DataFrame:
        return df.coalesce(max(1, tasks)) if tasks < most else df

    while not _are_stars(tight(links)):
        links = tight(links)
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = tight(tight(large).distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        moved = tight(moved).unionByName(tight(least.withColumnRenamed("m", "b")))
        links = checkpointed(tight(moved.distinct()))
    roots = links.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots)


def _are_stars(links: DataFrame) -> bool:
    """Whether every node hangs on one other, on which nothing else is hung further up."""
    ends = links.select(F.col("a").alias("id"), F.lit(1).alias("up"))
    ends = ends.unionByName(links.select(F.col("b").alias("id"), F.lit(0).alias("up")))
    nodes = ends.groupBy("id").agg(F.sum("up").alias("ups"), F.min("up").alias("low"))
    return nodes.where("ups > 1 OR (ups > 0 AND low = 0)").limit(1).count() == 0


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest linked place of each of ``n`` places, given the links i-j, inside a task."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        while True:
            jumped = new[new]
            if np.array_equal(jumped, new):
                break
            new = jumped
        label = new[label]
        apart = label[i] != label[j]
        i, j = i[apart], j[apart]
    return label
