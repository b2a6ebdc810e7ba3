"""Farthest-first traversal of a whole table, or of each of its parts.

The first center of a part is its first point in the seeded random order; each
further one is the point farthest from the centers chosen before. All parts
advance together in passes over the table. No pass shuffles the points, and a
part may be larger than any executor:

1. Each map task computes its points' distance to the nearest center of their
   part and keeps the farthest few of every part, the *pool*.
2. The pools are merged per part, in two steps when there are many map tasks.
3. One task per part runs the traversal on the merged pool. Distances to the
   nearest center only ever shrink, so a pool point is the farthest of its part
   for certain while it still ranks before the last point the pool had room
   for. Every pass settles at least one center per part, usually many, and the
   centers are exactly those of a pass per center.

After a fixed number of new centers the distances are written down, and the
centers as well. So what the driver and the map tasks hold is bounded by that
number, not by k; the number shrinks until its size passes a check. Where not
even one center per part passes, groups of parts take turns.

Points carry the number of their nearest center, and tasks get the distances of
the newest centers to all earlier ones, so most distances that cannot matter are
never computed (:mod:`tallyspan.functions.gaps`). As far as these distances
between centers exceed their bound, points of long-known centers are measured.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspan import session
from tallyspan.functions.gaps import gap_table, shrink
from tallyspan.functions.kernels import distances_to, feature_column, feature_matrix, first_rows
from tallyspan.functions.keys import SEED
from tallyspan.operators.sampling import first_of_each_part
from tallyspan.session import checkpointed
from tallyspan.sources.points import checked_points, dimension_of, with_dimension

# Most pool points of one part in a map task, the bytes of its pools of all
# parts, and the bytes of one part's pools from as many tasks as are merged.
POOL_ROWS = 1_024
POOL_BYTES = 16 << 20
MERGE_BYTES = 128 << 20
MERGE_TASKS = 256
# Most new centers per part before distances and centers are written down.
REFRESH_AFTER = 128

CENTER_SCHEMA = (
    "part bigint, rank int, point_id bigint, features array<double>, distance double"
)


class _Centers:
    """The newest centers of each part, as arrays the map tasks use."""

    def __init__(self, rows):
        """From the first center of each part: (part, point_id, features, ...)."""
        rows = sorted(rows, key=lambda row: row[0])
        self.parts = np.array([row[0] for row in rows], np.int64)
        self.ids = [[row[1]] for row in rows]
        self.vectors = [[np.array(row[2], np.float64)] for row in rows]
        self.distances: list[list[float | None]] = [[None] for _ in rows]
        self.counts = [1] * len(rows)
        self.finished = [False] * len(rows)
        self.dimension = len(rows[0][2])
        self.most_gaps = 0
        self.kept = [np.empty((0, self.dimension)) for _ in rows]
        self.dropped = [0] * len(rows)
        self.gaps: list[list[np.ndarray]] = [[np.empty(0)] for _ in rows]

    def know_gaps(self, hold: int, most_bytes: int) -> None:
        """Keep distances between centers for up to ``hold`` newest ones per part, as far as they fit."""
        if 16 * hold * hold * len(self.parts) <= most_bytes:
            self.most_gaps = most_bytes // (16 * (hold + self.dimension))

    def add(self, part: int, point_id: int, vector, dist: float | None, exhausted: bool) -> None:
        at = int(np.searchsorted(self.parts, part))
        if self.most_gaps:
            earlier = [self.kept[at], np.array(self.vectors[at]).reshape(-1, self.dimension)]
            self.gaps[at].append(np.concatenate([distances_to(x, np.array(vector, np.float64)) for x in earlier]))
        self.ids[at].append(point_id)
        self.vectors[at].append(np.array(vector, np.float64))
        self.distances[at].append(dist)
        self.counts[at] += 1
        self.finished[at] = self.finished[at] or exhausted

    def room(self, k: int, at_once: int) -> dict[int, int]:
        """Centers wanted from the next pass, for each part that can give more."""
        return {
            int(part): min(k - count, at_once)
            for part, count, done in zip(self.parts, self.counts, self.finished)
            if count < k and not done
        }

    def held(self) -> int:
        """Most newest centers of one part."""
        return max(map(len, self.ids))

    def flat(self) -> tuple[np.ndarray, np.ndarray]:
        """The newest centers in order of part, and where each part's begin (one more at the end)."""
        starts = np.concatenate(([0], np.cumsum([len(v) for v in self.vectors])))
        vectors = [v for vs in self.vectors for v in vs]
        return np.array(vectors).reshape(starts[-1], self.dimension), starts

    def gap_table(self):
        """What :func:`shrink` wants to know of the distances between centers, if they are kept."""
        return gap_table(self.kept, self.vectors, self.gaps, self.dropped) if self.most_gaps else None

    def chosen(self) -> np.ndarray:
        return np.sort(np.array([i for ids in self.ids for i in ids], np.int64))

    def table(self) -> pa.Table:
        lengths = [len(ids) for ids in self.ids]
        ranks = [
            rank
            for count, held in zip(self.counts, lengths)
            for rank in range(count - held + 1, count + 1)
        ]
        vectors = np.array([v for vs in self.vectors for v in vs])
        return pa.table(
            {
                "part": pa.array(np.repeat(self.parts, lengths), pa.int64()),
                "rank": pa.array(ranks, pa.int32()),
                "point_id": pa.array([i for ids in self.ids for i in ids], pa.int64()),
                "features": feature_column(vectors.reshape(len(ranks), self.dimension)),
                "distance": pa.array([d for ds in self.distances for d in ds], pa.float64()),
            }
        )

    def forget(self) -> None:
        """Drop the newest centers once they are written down, but for the coordinates that gaps need."""
        if self.most_gaps:
            if sum(map(len, self.kept)) + sum(map(len, self.vectors)) > self.most_gaps:
                self.dropped = list(self.counts)
                self.kept = [np.empty((0, self.dimension)) for _ in self.parts]
            else:
                self.kept = [np.vstack([old, *new]) for old, new in zip(self.kept, self.vectors, strict=True)]
            self.gaps = [[] for _ in self.parts]
        self.ids, self.vectors, self.distances = ([[] for _ in self.parts] for _ in range(3))


def _nearest(batch: pa.RecordBatch, parts: np.ndarray, newest: tuple[np.ndarray, np.ndarray], gaps=None):
    """Part numbers, ids, coordinates, distance to the nearest center and its number in the part.

    The distance is NaN in a part that has no center; it may overflow to
    infinity in one that has. The number is -1 unless ``gaps`` are known.
    """
    part = batch.column("part").to_numpy()
    ids = batch.column("point_id").to_numpy()
    matrix = feature_matrix(batch.column("features"))
    vectors, starts = newest
    at = np.minimum(np.searchsorted(parts, part), len(parts) - 1)
    counts = np.where(parts[at] == part, np.diff(starts)[at], 0)
    if "min_dist" in batch.schema.names:
        nearest = batch.column("min_dist").to_numpy(zero_copy_only=False).copy()
    else:
        nearest = np.full(len(ids), np.nan)
    if "owner" in batch.schema.names:
        owner = batch.column("owner").to_numpy(zero_copy_only=False).copy()
    else:
        owner = np.full(len(ids), -1, np.int32)
    if gaps is not None:
        rows = np.flatnonzero(counts)
        if len(rows) == len(ids):
            shrink(matrix, at, nearest, owner, vectors, starts, gaps)
        elif len(rows):
            near, own = nearest[rows], owner[rows]
            shrink(matrix[rows], at[rows], near, own, vectors, starts, gaps)
            nearest[rows], owner[rows] = near, own
        return part, ids, matrix, nearest, owner
    for turn in range(counts.max(initial=0)):
        rows = np.flatnonzero(counts > turn)
        if len(parts) == 1 and len(rows) == len(ids):
            dist = distances_to(matrix, vectors[turn])
        else:
            dist = distances_to(matrix[rows], vectors[starts[at[rows]] + turn])
        nearest[rows] = np.fmin(nearest[rows], dist)
    return part, ids, matrix, nearest, owner


def _pools(state: DataFrame, centers: _Centers, rows: int, open_parts: dict) -> DataFrame:
    """Each map task's ``rows`` farthest points of every unfinished part."""
    parts, newest, chosen, gaps = centers.parts, centers.flat(), centers.chosen(), centers.gap_table()
    wanted = np.isin(parts, np.array(list(open_parts), np.int64))

    def farthest(batches):
        pool = None
        floor = np.full(len(parts), -np.inf)
        for batch in batches:
            part, ids, matrix, nearest, _ = _nearest(batch, parts, newest, gaps)
            at = np.minimum(np.searchsorted(parts, part), len(parts) - 1)
            # a NaN, for a part without centers, is not at least anything
            keep = np.flatnonzero(wanted[at] & (parts[at] == part) & (nearest >= floor[at]))
            keep = keep[~np.isin(ids[keep], chosen)]
            if not len(keep):
                continue
            found = [x[keep] for x in (part, ids, nearest, matrix)]
            pool = found if pool is None else [np.concatenate(x) for x in zip(pool, found)]
            first = first_rows(pool[0], -pool[2], pool[1], rows)
            pool = [x[first] for x in pool]
            # rows are grouped by part, so a full group's last row is its floor
            at, sizes = np.unique(np.searchsorted(parts, pool[0]), return_counts=True)
            full = sizes == rows
            floor[at[full]] = pool[2][np.cumsum(sizes)[full] - 1]
        if pool is not None:
            yield pa.RecordBatch.from_arrays(
                [*map(pa.array, pool[:3]), feature_column(pool[3])],
                names=["part", "point_id", "nearest", "features"],
            )

    schema = "part bigint, point_id bigint, nearest double, features array<double>"
    return state.mapInArrow(farthest, schema)


def _merge_pools(pools: DataFrame, rows: int) -> DataFrame:
    """Keep the first ``rows`` of each part in each of a bounded number of groups."""
    salted = pools.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(MERGE_TASKS)))
    within = Window.partitionBy("part", "salt").orderBy(F.desc("nearest"), "point_id")
    placed = salted.withColumn("place", F.row_number().over(within))
    return placed.filter(F.col("place") <= rows).drop("salt", "place")


def _traverse_pool(pools: DataFrame, rows: int, room: dict[int, int]) -> DataFrame:
    """Run the traversal on each part's pool as far as the pool is conclusive."""

    def advance(table: pa.Table) -> pa.Table:
        part = table["part"][0].as_py()
        ids = table["point_id"].to_numpy()
        nearest = table["nearest"].to_numpy()
        first = np.lexsort((ids, -nearest))[:rows]
        # with room to spare, the pool is all that is left of the part
        whole = len(ids) < rows
        ids, nearest = ids[first], nearest[first].copy()
        matrix = feature_matrix(table["features"])[first]
        last = (-nearest[-1], ids[-1])
        taken, dists = [], []
        open_ = np.ones(len(ids), bool)
        while len(taken) < room[part] and open_.any():
            left = np.flatnonzero(open_)
            best = left[np.lexsort((ids[left], -nearest[left]))[0]]
            if not whole and (-nearest[best], ids[best]) > last:
                break
            taken.append(best)
            dists.append(nearest[best])
            open_[best] = False
            nearest = np.minimum(nearest, distances_to(matrix, matrix[best]))
        exhausted = whole and not open_.any()
        return pa.table(
            {
                "part": pa.array([part] * len(taken), pa.int64()),
                "step": pa.array(range(len(taken)), pa.int32()),
                "point_id": pa.array(ids[taken]),
                "nearest": pa.array(dists, pa.float64()),
                "features": feature_column(matrix[taken]),
                "exhausted": pa.array([exhausted] * len(taken)),
            }
        )

    return pools.groupBy("part").applyInArrow(
        advance,
        "part bigint, step int, point_id bigint, nearest double, "
        "features array<double>, exhausted boolean",
    )


def _first_centers(keyed: DataFrame, seed: int, first_ids) -> DataFrame:
    """``(part, point_id, features, tasks)``: the first center of each part.

    ``tasks`` is how many map tasks read the part, if that is known.
    """
    if first_ids is not None:
        chosen = keyed.filter(F.col("point_id").isin([int(i) for i in first_ids]))
        return chosen.select("part", "point_id", "features", F.lit(None).cast("int").alias("tasks"))

    per_task = first_of_each_part(keyed, 1, seed)
    best = per_task.groupBy("part").agg(
        F.min(F.struct("key", "point_id", "features")).alias("best"),
        F.count(F.lit(1)).cast("int").alias("tasks"),
    )
    return best.select("part", "best.point_id", "best.features", "tasks")


def _with_distances(
    state: DataFrame, centers: _Centers, keep_features: bool, keep_centers: bool = True
) -> DataFrame:
    """Every point with ``min_dist``, its distance to the nearest center, and with coordinates that center's number."""
    parts, newest, chosen, gaps = centers.parts, centers.flat(), centers.chosen(), centers.gap_table()

    def measure(batches):
        for batch in batches:
            if not keep_centers:
                ids = batch.column("point_id").to_numpy()
                batch = batch.filter(pa.array(~np.isin(ids, chosen)))
            part, ids, matrix, nearest, owner = _nearest(batch, parts, newest, gaps)
            arrays = [pa.array(part), pa.array(ids), pa.array(nearest)]
            names = ["part", "point_id", "min_dist"]
            if keep_features:
                arrays += [pa.array(owner, pa.int32()), feature_column(matrix)]
                names += ["owner", "features"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = "part bigint, point_id bigint, min_dist double"
    return state.mapInArrow(measure, schema + (", owner int, features array<double>" if keep_features else ""))


def _center_bytes(centers: int, dimension: int) -> int:
    return centers * (8 * dimension + 64)


def require_fewer(points: DataFrame, k: int, n: int | None = None) -> None:
    """Check 0 < k < n; without a known n, k + 1 rows are counted at most."""
    if k >= 1 and n is None:
        n = points.select(F.lit(1)).limit(k + 1).count()
    if k < 1 or n <= k:
        raise ValueError("k must be greater than 0 and smaller than the number of points")


def k_center(
    points: DataFrame,
    k: int,
    num_parts: int | None = None,
    seed: int = SEED,
    first_ids=None,
    pool_rows: int = POOL_ROWS,
    written: bool = False,
) -> DataFrame:
    """``(part, rank, point_id, features, distance)``: k centers per part.

    Without ``num_parts`` the table is one part, numbered 0, of more than k
    points. With it, ``points`` has a ``part`` column with at most that many
    values, and a part of fewer than k points gives all of them. Ranks count
    from 1; ``distance`` is the distance to the nearest earlier center, NULL at
    rank 1. Of equally far points the lowest id is next; a point is chosen only
    once. ``first_ids`` sets the first centers, one for each part that shall
    have centers.

    Where the newest centers of all parts are too large to hold, groups of
    parts take turns; parts do not depend on each other, and all go through the
    same arithmetic. The points are written once before the passes, unless they
    are ``written`` already, so that all passes see the same.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    points = checked_points(points)
    dimension = dimension_of(points)
    if num_parts is None:
        require_fewer(points, k)
    keyed = points if num_parts is not None else points.withColumn("part", F.lit(0).cast("bigint"))
    num_parts = 1 if num_parts is None else num_parts
    keyed = keyed.select(F.col("part").cast("bigint").alias("part"), "point_id", "features")
    path = None
    if not written:
        keyed, path = session.written(keyed, "points")
    found = _in_turns(keyed, k, num_parts, dimension, seed, first_ids, pool_rows)
    if path:  # the centers are held or written by themselves
        session.discard(keyed.sparkSession, path)
    return with_dimension(found, dimension)


def _in_turns(
    keyed: DataFrame, k: int, num_parts: int, dimension: int, seed: int, first_ids, pool_rows: int
) -> DataFrame:
    """The traversal of all parts, or of groups of parts whose centers can be held."""
    # a pass starts with a center per part at least, adds as many, and groups of parts are uneven
    turns = math.ceil(4 * _center_bytes(num_parts, dimension) / session.SMALL_BYTES)
    if turns <= 2:
        return _traverse(keyed, k, num_parts, dimension, seed, first_ids, pool_rows)
    turn = F.pmod(F.xxhash64(F.lit(SEED), "part"), F.lit(turns))
    found = None
    for number in range(turns):
        own = keyed.filter(turn == number)
        centers = checkpointed(_traverse(own, k, num_parts, dimension, seed, first_ids, pool_rows))
        found = centers if found is None else found.unionByName(centers)
    if found.filter("rank = 1").count() > num_parts:
        raise ValueError(f"expected one first center for each of at most {num_parts} parts")
    return found


def _traverse(
    keyed: DataFrame, k: int, num_parts: int, dimension: int, seed: int, first_ids, pool_rows: int
) -> DataFrame:
    """The traversal of all parts together, at most ``num_parts`` of them."""
    rows = _first_centers(keyed, seed, first_ids).limit(num_parts + 1).collect()
    if len({row[0] for row in rows}) != len(rows) or len(rows) > num_parts:
        raise ValueError(f"expected one first center for each of at most {num_parts} parts")
    spark = keyed.sparkSession
    if not rows:
        return spark.createDataFrame([], CENTER_SCHEMA)
    centers = _Centers(rows)
    num_parts = len(rows)
    # a pass starts with up to this many centers per part and adds as many
    hold = max(1, min(REFRESH_AFTER, session.SMALL_BYTES // (2 * _center_bytes(num_parts, dimension))))
    centers.know_gaps(hold, session.SMALL_BYTES // 8)
    row_bytes = 8 * dimension + 32
    few_tasks = all(row["tasks"] and row["tasks"] <= MERGE_TASKS for row in rows)
    merged = max(row["tasks"] for row in rows) if few_tasks else MERGE_TASKS
    pool_rows = max(
        1,
        min(pool_rows, POOL_BYTES // (num_parts * row_bytes), MERGE_BYTES // (merged * row_bytes)),
    )
    state, before = keyed, None
    written = []
    while room := centers.room(k, hold):
        if centers.held() > hold:
            state, path = session.written(_with_distances(state, centers, True, keep_centers=False), "distances")
            if before:
                session.discard(spark, before)
            before = path
            written.append(checkpointed(spark.createDataFrame(centers.table())))
            centers.forget()
        pools = _pools(state, centers, pool_rows, room)
        if not few_tasks:
            pools = _merge_pools(pools, pool_rows)
        settled = _traverse_pool(pools, pool_rows, room).collect()
        reached = set()
        for row in sorted(settled, key=lambda row: (row["part"], row["step"])):
            centers.add(
                row["part"], row["point_id"], row["features"], row["nearest"], row["exhausted"]
            )
            reached.add(row["part"])
        # a part without any point left has no pool
        for at, part in enumerate(centers.parts):
            if int(part) in room and int(part) not in reached:
                centers.finished[at] = True
    if before:
        session.discard(spark, before)
    found = spark.createDataFrame(centers.table())
    for earlier in written:
        found = earlier.unionByName(found)
    return found


def min_distance(points: DataFrame, centers: DataFrame, num_centers: int | None = None) -> DataFrame:
    """``(part, point_id, min_dist)``: distance to the nearest center of the part.

    ``points`` and ``centers`` are matched by ``part`` if both have that column,
    and points of a part without centers are left out. The centers go to every
    map task; more than fit there are taken in several passes, each adding to
    the written distances of the one before.
    """
    points = checked_points(points)
    by_part = "part" in points.columns and "part" in centers.columns
    part = F.col("part").cast("bigint") if by_part else F.lit(0).cast("bigint")
    state = points.select(part.alias("part"), "point_id", "features")
    centers = centers.select(part.alias("part"), "point_id", "features")
    if num_centers is None:
        num_centers = centers.count()
    total = _center_bytes(num_centers, dimension_of(points))
    passes = 1 if total <= session.SMALL_BYTES else 2 * math.ceil(total / session.SMALL_BYTES)
    for number in range(passes):
        share = centers.filter(F.pmod(F.xxhash64("point_id"), F.lit(passes)) == number)
        groups: dict[int, list] = {}
        for row in share.collect():
            groups.setdefault(row["part"], []).append(row)
        if not groups:
            continue
        gathered = _Centers([group[0] for group in groups.values()])
        for group in groups.values():
            for row in group[1:]:
                gathered.add(row["part"], row["point_id"], row["features"], None, False)
        if number < passes - 1:
            state = checkpointed(_with_distances(state, gathered, keep_features=True))
        else:
            state = _with_distances(state, gathered, keep_features=False)
    if "min_dist" not in state.columns:
        raise ValueError("there are no centers")
    return state.select("part", "point_id", "min_dist").filter(~F.isnan("min_dist"))
