"""Coresets: k farthest-first centers from each of L parts of a point table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.functions.keys import SEED, partition_key
from tallyspan.operators.centers import k_center
from tallyspan.operators.classes import with_physical_part
from tallyspan.session import checkpointed


def with_parts(points: DataFrame, parts: int, partitioning: str = "key") -> DataFrame:
    """Add ``part``: the id modulo ``parts``, or the Spark partition.

    Spark partitions are written once, so that every later pass sees the same.
    """
    if partitioning == "key":
        return points.withColumn("part", partition_key("point_id", parts).cast("bigint"))
    if partitioning == "physical":
        return checkpointed(with_physical_part(points, parts))
    raise ValueError(f"unknown partitioning {partitioning!r}")


def coreset(
    points: DataFrame,
    k: int,
    parts: int,
    partitioning: str = "key",
    seed: int = SEED,
    first_ids=None,
) -> DataFrame:
    """``(part, rank, point_id, features, distance)``: at most k times L points.

    A part of fewer than k points gives all of them, an empty one none.
    """
    keyed = with_parts(points, parts, partitioning)
    written = partitioning == "physical"
    return k_center(keyed, k, num_parts=parts, seed=seed, first_ids=first_ids, written=written)


def coreset_tree(
    points: DataFrame,
    k: int,
    parts: int,
    levels: int = 1,
    fan: int = 16,
    partitioning: str = "key",
    seed: int = SEED,
) -> DataFrame:
    """``(part, rank, point_id, features, distance)``: a coreset of coresets, ``levels`` deep.

    The first level is :func:`coreset`. Each further one puts ``fan`` parts
    together and takes k centers of what the level before has left of them, so
    the last has at most k times ceil(L / fan ** (levels - 1)) points, however
    many parts the table needs, and none but the first reads the table. If a
    coreset keeps diversity up to a factor, a level's points are a coreset of
    those below up to that factor, and ``levels`` of them up to its power: take
    as few levels as a matching can do with.
    """
    if levels < 1 or fan < 2:
        raise ValueError("levels must be at least 1 and fan at least 2")
    core = coreset(points, k, parts, partitioning, seed)
    for _ in range(levels - 1):
        parts = -(-parts // fan)
        merged = F.call_function("div", F.col("part"), F.lit(fan))
        core = k_center(core.withColumn("part", merged), k, num_parts=parts, seed=seed)
    return core
