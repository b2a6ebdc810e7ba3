"""All pairs of a point table, compared block by block.

Points are dealt into B blocks by a hash of the id. Each point is sent to the
B block pairs its block belongs to, and one task compares one pair of blocks
at a time, so that every pair of points meets exactly once. No task holds more
than two blocks, and no pair of points ever becomes a row: a task returns only
its farthest pairs or its sum. With blocks of s points each point travels n/s
times, the least possible when a task can hold 2s points.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.functions.keys import salt
from tallyspan.functions.kernels import ExactSum, FarthestPairs, distance_sum, feature_matrix
from tallyspan.session import checkpointed
from tallyspan.sources.points import checked_points, dimension_of

# Bytes of coordinates in one block, and the most points whatever their width.
BLOCK_BYTES = 32 << 20
BLOCK_ROWS = 65_536
# Below this many points a second block does not pay.
_SINGLE_BLOCK = 1_024
# Most pairs that tasks gather, and the tasks that merge their lists.
_MOST_PAIRS = 2_000_000
_MERGE_TASKS = 256


def block_count(n: int, dimension: int, cores: int) -> int:
    """Blocks that fit the size bounds and give the cores enough block pairs."""
    rows = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * max(dimension, 1))))
    blocks = math.ceil(n / rows)
    if n > _SINGLE_BLOCK:
        # b(b+1)/2 block pairs for about two per core
        blocks = max(blocks, min(math.ceil(2 * math.sqrt(cores)), n // (_SINGLE_BLOCK // 4)))
    return max(blocks, 1)


def _block_pairs(points: DataFrame, blocks: int) -> DataFrame:
    block = F.col("block")
    other = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    placed = points.select(salt("point_id", blocks).cast("int").alias("block"), "point_id", "features")
    spread = placed.select("*", other.alias("other")).select(
        F.least(block, "other").alias("low"),
        F.greatest(block, "other").alias("high"),
        "block",
        "point_id",
        "features",
    )
    return grouped_pairs(spread, blocks * (blocks + 1) // 2)


def grouped_pairs(spread: DataFrame, pairs: int):
    """One partition for a few block pairs: many comparisons per byte shuffled."""
    return spread.repartition(max(1, min(pairs, 20_000)), "low", "high").groupBy("low", "high")


def sides(table: pa.Table):
    """The two blocks of a group as (ids, matrix), in id order whatever came first."""
    ids = table["point_id"].to_numpy()
    block = table["block"].to_numpy()
    matrix = feature_matrix(table["features"])
    low, high = table["low"][0].as_py(), table["high"][0].as_py()
    found = []
    for number in (low, high):
        rows = np.flatnonzero(block == number)
        rows = rows[np.argsort(ids[rows], kind="stable")]
        found.append((ids[rows], matrix[rows]))
    return found[0], found[1], low == high


def farthest_pairs(
    points: DataFrame, rows: int, n: int | None = None, floor: float = float("-inf")
) -> DataFrame:
    """``(i, j, d2)``: the ``rows`` farthest pairs of points, i < j.

    In order of squared distance, largest first, and then of i and j. ``n``
    saves a count when the number of points is known; a known squared distance
    that the pairs wanted at least have, as ``floor``, saves comparisons. Tasks
    hold ``rows`` pairs, so there is a limit to them.
    """
    found = _tile_pairs(points, rows, n, floor, None)
    return _first_pairs(found, rows)


def leading_pairs(
    points: DataFrame, rows: int, cap: int, n: int | None = None
) -> tuple[list[tuple[int, int]], int]:
    """Farthest pairs (i, j) in order, and how many of the first are sure.

    At most ``rows`` of them, without pairs of a point that has ``cap`` farther
    ones. A pair is sure if every pair before it is in the list, but for those
    of points with ``cap`` farther ones; the first pair always is.
    """
    found = checkpointed(_tile_pairs(points, rows, n, float("-inf"), cap))
    bound = found.agg(F.max("bound")).first()[0]
    pairs = _first_pairs(found.filter("i IS NOT NULL"), rows).collect()
    if bound is None:
        bound = float("-inf")
    if len(pairs) == rows:
        bound = max(bound, pairs[-1]["d2"])
    sure = sum(pair["d2"] > bound for pair in pairs)
    return [(pair["i"], pair["j"]) for pair in pairs], max(sure, min(1, len(pairs)))


def _first_pairs(found: DataFrame, rows: int) -> DataFrame:
    """The first pairs of the tiles' lists, merged in up to 256 tasks before one."""
    salted = found.withColumn("salt", F.pmod(F.xxhash64("i", "j"), F.lit(_MERGE_TASKS)))
    within = Window.partitionBy("salt").orderBy(F.desc("d2"), "i", "j")
    kept = salted.withColumn("place", F.row_number().over(within)).filter(F.col("place") <= rows)
    return kept.orderBy(F.desc("d2"), "i", "j").limit(rows).select("i", "j", "d2")


def _tile_pairs(points: DataFrame, rows: int, n: int | None, floor: float, cap: int | None) -> DataFrame:
    """``(i, j, d2, bound)``: the first pairs of every tile; with a cap, also a row of NULLs and the bound."""
    if not 0 < rows <= _MOST_PAIRS:
        raise ValueError(f"between 1 and {_MOST_PAIRS} pairs can be asked for")
    points = checked_points(points)
    if n is None:
        n = points.count()
    cores = points.sparkSession.sparkContext.defaultParallelism
    return compare_blocks(_block_pairs(points, block_count(n, dimension_of(points), cores)), rows, floor, cap)


def compare_blocks(grouped, rows: int, floor: float, cap: int | None = None) -> DataFrame:
    """``(i, j, d2, bound)`` of every block pair; see :func:`leading_pairs` for the bound."""

    def compare(table: pa.Table) -> pa.Table:
        (ids_a, a), (ids_b, b), same = sides(table)
        best = FarthestPairs(rows, floor, cap)
        if len(a) and len(b):
            best.compare(ids_a, a, ids_b, b, same)
        i, j, d2 = best.i.tolist(), best.j.tolist(), best.d2.tolist()
        more = [None] if cap is not None and best.bound > -np.inf else []
        return pa.table(
            {
                "i": pa.array(i + more, pa.int64()),
                "j": pa.array(j + more, pa.int64()),
                "d2": pa.array(d2 + more, pa.float64()),
                "bound": pa.array([None] * len(i) + [best.bound] * len(more), pa.float64()),
            }
        )

    return grouped.applyInArrow(compare, "i bigint, j bigint, d2 double, bound double")


def pairwise_distance_sum(points: DataFrame, n: int | None = None) -> DataFrame:
    """One row ``(total, pairs)``: sum and number of all pairwise distances.

    The sum is exact and rounded once, so it is the same to the last bit
    however points are dealt into blocks. Integer sums are combined per binary
    exponent, and the last task sees at most one row for each.
    """
    points = checked_points(points)
    if n is None:
        n = points.count()
    cores = points.sparkSession.sparkContext.defaultParallelism

    def add(table: pa.Table) -> pa.Table:
        (_, a), (_, b), same = sides(table)
        total, pairs = distance_sum(a, b, same)
        exponents, high, low = total.parts()
        return pa.table(
            {
                "exponent": pa.array([*exponents.tolist(), 0], pa.int32()),
                "high": pa.array([*high.tolist(), 0], pa.int64()),
                "low": pa.array([*low.tolist(), 0], pa.int64()),
                "pairs": pa.array([0] * len(exponents) + [pairs], pa.int64()),
            }
        )

    def finish(table: pa.Table) -> pa.Table:
        exponents, high, low, pairs = (table[c].to_pylist() for c in ("exponent", "high", "low", "pairs"))
        return pa.table({"total": [ExactSum.total(exponents, high, low)], "pairs": pa.array([sum(pairs)], pa.int64())})

    grouped = _block_pairs(points, block_count(n, dimension_of(points), cores))
    sums = grouped.applyInArrow(add, "exponent int, high bigint, low bigint, pairs bigint")
    # a table without points has a sum as well
    nothing = points.sparkSession.range(1).selectExpr("0 AS exponent", "0L AS high", "0L AS low", "0L AS pairs")
    wide = [F.sum(F.col(c).cast("decimal(28,0)")).alias(c) for c in ("high", "low")]
    by_exponent = sums.unionByName(nothing).groupBy("exponent").agg(*wide, F.sum("pairs").alias("pairs"))
    return by_exponent.groupBy().applyInArrow(finish, "total double, pairs bigint")
