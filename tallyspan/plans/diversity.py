"""Reports on distances and diversity."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tallyspan.functions.keys import SEED
from tallyspan.operators.centers import require_fewer
from tallyspan.operators.coresets import coreset_tree
from tallyspan.operators.diameter import exact_mpd, k_center_mpd, two_approx_mpd
from tallyspan.operators.matching import avg_pairwise_distance, greedy_matching
from tallyspan.session import checkpointed, written
from tallyspan.sources.points import checked_points, dimension_of, with_dimension


def mpd_compare(points: DataFrame, k: int, seed: int = SEED) -> DataFrame:
    """``(algorithm, k, max_distance)`` of the three largest-distance algorithms.

    The points are read and counted once, and written for all three.
    """
    points = checkpointed(checked_points(points))
    n = points.count()
    require_fewer(points, k, n)
    answers = {
        "exact": (None, exact_mpd(points, n, written=True)),
        "sample": (k, two_approx_mpd(points, k, seed, n=n)),
        "k_center": (k, k_center_mpd(points, k, seed, written=True)),
    }
    rows = None
    for name, (used, answer) in answers.items():
        row = answer.select(
            F.lit(name).alias("algorithm"), F.lit(used).cast("int").alias("k"), "max_distance"
        )
        rows = row if rows is None else rows.unionByName(row)
    return rows


def diversity_max(
    points: DataFrame,
    k: int,
    parts: int,
    partitioning: str = "key",
    seed: int = SEED,
    levels: int = 1,
    fan: int = 16,
) -> DataFrame:
    """``(rank, point_id, features)``: k diverse points in ``levels`` + 1 rounds.

    A coreset of the parts, if wanted coresets of ``fan`` coresets at a time
    (see :func:`tallyspan.operators.coresets.coreset_tree`), then greedy matching.
    """
    return greedy_matching(coreset_tree(points, k, parts, levels, fan, partitioning, seed), k)


def diversity_report(
    points: DataFrame,
    k: int,
    parts: int,
    partitioning: str = "key",
    seed: int = SEED,
    levels: int = 1,
    fan: int = 16,
) -> DataFrame:
    """One row: number of points, k, L, size of the (last) coreset, average distance.

    The points are counted by the pass that writes them for the coreset.
    """
    seen = Observation()
    counted = checked_points(points).observe(seen, F.count(F.lit(1)).alias("n"))
    stored, _ = written(counted.select("point_id", "features"), "points")
    stored = with_dimension(stored, dimension_of(points))
    core = coreset_tree(stored, k, parts, levels, fan, partitioning, seed)
    size = core.count()
    average = avg_pairwise_distance(greedy_matching(core, k, size), min(k, size))
    return average.select(
        F.lit(seen.get["n"]).cast("bigint").alias("n"),
        F.lit(k).alias("k"),
        F.lit(parts).alias("parts"),
        F.lit(size).cast("bigint").alias("coreset_size"),
        "avg_distance",
    )
