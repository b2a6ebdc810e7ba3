"""Diverse subsets by greedy matching, and how good a subset is."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.operators.blocks import leading_pairs, pairwise_distance_sum
from tallyspan.operators.sampling import dense_positions
from tallyspan.operators.tiles import TileHeap
from tallyspan.session import broadcast_if_small, checkpointed
from tallyspan.sources.points import checked_points

# Points from which on block pairs are opened one after the other.
HEAP_FROM = 8_192
# Most pairs that one pass returns to the driver.
PAIR_POOL = 4_096
# Most pairs that one pass settles.
PASS_PAIRS = 64


def pairs_needed(candidates: int, rounds: int) -> int:
    """How many of the farthest pairs can decide ``rounds`` rounds of matching.

    Each round before the last takes two points, and each of them rules out
    fewer pairs than there are candidates.
    """
    return 2 * (rounds - 1) * (candidates - 1) + 1


def remaining_candidates(points: DataFrame, chosen: DataFrame, num_chosen: int) -> DataFrame:
    """The points whose id is not among the chosen ones."""
    ids = broadcast_if_small(chosen.select("point_id"), num_chosen)
    return points.join(ids, "point_id", "left_anti")


def _ids(points: DataFrame, ids: list[int]) -> DataFrame:
    ranks = pa.array(range(1, len(ids) + 1), pa.int32())
    table = pa.table({"rank": ranks, "point_id": pa.array(ids, pa.int64())})
    return points.sparkSession.createDataFrame(table)


def greedy_matching(
    points: DataFrame, k: int, n: int | None = None, pair_pool: int = PAIR_POOL
) -> DataFrame:
    """``(rank, point_id, features)``: k points that lie far apart.

    Again and again the farthest pair of the remaining points is taken, of
    equally far ones the first by ids, and for an odd k the remaining point of
    lowest id at the end. With k at or above the number of points all are
    taken, in id order.

    More than HEAP_FROM points are written once, and pairs of blocks are opened
    only when they may hold the next pair, see :mod:`tallyspan.operators.tiles`.

    Of fewer points, a pass over the block pairs returns farthest pairs in order, at most
    ``pair_pool``, and of each point only its first few: whatever else a point
    is in cannot be taken before those few partners are used up. So one point
    that is far from all others does not fill the list, and a pass settles
    ``PASS_PAIRS`` pairs unless the list ends before. Then another pass looks
    at the remaining points.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    points = checked_points(points).select("point_id", "features")
    if n is None:
        n = points.count()
    if k >= n:
        places = dense_positions(points, "point_id")
        ranked = places.select((F.col("position") + 1).cast("int").alias("rank"), "point_id")
        return points.join(broadcast_if_small(ranked, n), "point_id").select("rank", "point_id", "features")
    taken: list[int] = []
    if n > HEAP_FROM:
        points = checkpointed(points)
        heap = TileHeap(points, n)
        taken = heap.take(k // 2, pair_pool)
        heap.close()
    while len(taken) < k - k % 2:
        rest = remaining_candidates(points, _ids(points, taken), len(taken)) if taken else points
        left, rounds = n - len(taken), k // 2 - len(taken) // 2
        settle = min(rounds, PASS_PAIRS)
        # before the last of these pairs, 2 * settle - 2 partners of a point can be used up
        pairs, sure = leading_pairs(rest, min(pairs_needed(left, rounds), pair_pool), 2 * settle - 1, left)
        used: set[int] = set()
        for i, j in pairs[:sure]:
            if i not in used and j not in used and len(used) < 2 * settle:
                taken += [i, j]
                used |= {i, j}
    if k % 2:
        rest = remaining_candidates(points, _ids(points, taken), len(taken)) if taken else points
        taken.append(rest.agg(F.min("point_id")).first()[0])
    ranked = broadcast_if_small(_ids(points, taken), k)
    return points.join(ranked, "point_id").select("rank", "point_id", "features")


def avg_pairwise_distance(points: DataFrame, n: int | None = None) -> DataFrame:
    """One row ``avg_distance``: average over all pairs, NULL without a pair."""
    sums = pairwise_distance_sum(points, n)
    return sums.select(
        F.expr("total / nullif(pairs, 0)").alias("avg_distance"),
    )
