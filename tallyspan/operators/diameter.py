"""Maximum pairwise distance: exact, from a sample, and from k centers."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan import session
from tallyspan.functions.kernels import distances_to, feature_column, feature_matrix
from tallyspan.functions.keys import SEED
from tallyspan.operators.balls import farthest_distance
from tallyspan.operators.blocks import farthest_pairs
from tallyspan.operators.centers import k_center, require_fewer
from tallyspan.operators.sampling import sample_points
from tallyspan.session import checkpointed
from tallyspan.sources.points import checked_points, dimension_of, with_dimension

# Points that are compared at once; for more, leaving some out pays for the passes.
DIRECT = 32_768


def _mean(points: DataFrame, n: int) -> np.ndarray:
    def add(batches):
        total = None
        for batch in batches:
            matrix = feature_matrix(batch.column("features"))
            if len(matrix):
                share = matrix.sum(axis=0) / n
                total = share if total is None else total + share
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(total)), pa.int32()), pa.array(total)], names=["at", "share"]
            )

    shares = points.select("features").mapInArrow(add, "at int, share double")
    rows = shares.groupBy("at").agg(F.sum("share").alias("mean")).collect()
    return np.array([row["mean"] for row in sorted(rows)])


def _farthest(points: DataFrame, target: np.ndarray) -> tuple[float, np.ndarray]:
    """Largest distance to one place, and the coordinates of the point there."""

    def search(batches):
        best = None
        for batch in batches:
            matrix = feature_matrix(batch.column("features"))
            if len(matrix):
                dist = distances_to(matrix, target)
                at = int(dist.argmax())
                if best is None or dist[at] > best[0]:
                    best = dist[at], matrix[at : at + 1].copy()
        if best is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([best[0]]), feature_column(best[1])], names=["dist", "features"]
            )

    found = points.select("features").mapInArrow(search, "dist double, features array<double>")
    row = found.agg(F.max(F.struct("dist", "features")).alias("best")).first()["best"]
    return row["dist"], np.array(row["features"])


def outer_points(points: DataFrame, n: int) -> tuple[DataFrame, float]:
    """The points that can end a longest pair, and the length of a long pair.

    It takes a few passes and no shuffle of points.

    Let R be the largest distance from the mean, and LB the length of a long
    pair, found by walking twice to the farthest point. Both ends of a pair at
    least as long as LB lie at least LB - R from the mean, as the other end is
    at most R away from it. All other points go. On points that all lie equally
    far out, such as unit vectors, nothing goes and the cost is the passes.
    """
    mean = _mean(points, n)
    radius, start = _farthest(points, mean)
    length, end = _farthest(points, start)
    length = max(length, _farthest(points, end)[0])
    bound = (length - radius) - 1e-9 * (length + radius + np.abs(mean).max(initial=0.0))
    if not np.isfinite(bound):  # sums or distances beyond the largest number say nothing
        return points, 0.0
    if bound <= 0:
        return points, length

    def keep(batches):
        for batch in batches:
            dist = distances_to(feature_matrix(batch.column("features")), mean)
            yield batch.filter(pa.array(dist >= bound))

    kept = points.select("point_id", "features").mapInArrow(
        keep, "point_id bigint, features array<double>"
    )
    return checkpointed(kept), length


def exact_mpd(points: DataFrame, n: int | None = None, written: bool = False) -> DataFrame:
    """One row ``max_distance``: the largest distance of any two points.

    0 for fewer than two points. Up to DIRECT points are compared block by block
    at once. More are written once, unless they are ``written`` already, and
    reduced to those that can end a longest pair; a hierarchy of balls then says
    which pairs of blocks to compare, see :mod:`tallyspan.operators.balls`.
    """
    points = checked_points(points).select("point_id", "features")
    if n is None:
        n = points.count()
    if n < 2:
        return points.sparkSession.range(1).select(F.lit(0.0).alias("max_distance"))
    if n <= DIRECT:
        return farthest_pairs(points, 1, n).agg(F.coalesce(F.sqrt(F.max("d2")), F.lit(0.0)).alias("max_distance"))
    if not written:
        points = checkpointed(points)
    dimension = dimension_of(points)
    outer, length = outer_points(points, n)
    outer = with_dimension(outer, dimension)
    length = farthest_distance(outer, outer.count(), length)[0]
    return points.sparkSession.range(1).select(F.lit(float(length)).alias("max_distance"))


def _max_distance_to(points: DataFrame, targets: np.ndarray) -> DataFrame:
    def search(batches):
        best = 0.0
        for batch in batches:
            matrix = feature_matrix(batch.column("features"))
            for target in targets if len(matrix) else ():
                best = max(best, float(distances_to(matrix, target).max()))
        yield pa.RecordBatch.from_arrays([pa.array([best])], names=["dist"])

    return points.select("features").mapInArrow(search, "dist double")


def max_distance_to(points: DataFrame, sample: DataFrame, k: int) -> DataFrame:
    """One row ``max_distance``: the largest distance of a point and a sample point.

    The sample of k points goes to every map task. A sample too large for that
    is cut into shares, and the table is read once for each.
    """
    total = k * (8 * dimension_of(points) + 64)
    shares = 1 if total <= session.SMALL_BYTES else 2 * math.ceil(total / session.SMALL_BYTES)
    if shares > 1:
        sample = checkpointed(sample)
    maxima = None
    for share in range(shares):
        rows = sample if shares == 1 else sample.filter(F.pmod(F.xxhash64("draw"), F.lit(shares)) == share)
        targets = np.array([row["features"] for row in rows.select("features").collect()])
        found = _max_distance_to(points, targets)
        maxima = found if maxima is None else maxima.unionByName(found)
    return maxima.agg(F.coalesce(F.max("dist"), F.lit(0.0)).alias("max_distance"))


def two_approx_mpd(
    points: DataFrame,
    k: int,
    seed: int = SEED,
    with_replacement: bool = False,
    n: int | None = None,
) -> DataFrame:
    """One row ``max_distance``: the largest distance to k seeded sample points.

    At least half of the largest distance of any two points.
    """
    points = checked_points(points)
    require_fewer(points, k, n)
    return max_distance_to(points, sample_points(points, k, seed, with_replacement), k)


def k_center_mpd(
    points: DataFrame, k: int, seed: int = SEED, first_ids=None, written: bool = False
) -> DataFrame:
    """One row ``max_distance``: the largest distance of k farthest-first centers.

    Never more than the largest distance of any two points.
    """
    return exact_mpd(k_center(points, k, seed=seed, first_ids=first_ids, written=written), k)
