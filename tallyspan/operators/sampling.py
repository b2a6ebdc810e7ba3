"""Seeded samples of points."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspan import session
from tallyspan.functions.kernels import feature_column, feature_matrix, first_rows
from tallyspan.functions.keys import SEED, random_order
from tallyspan.session import broadcast_if_small, checkpointed
from tallyspan.sources.points import dimension_of

_MERGE_TASKS = 256
# Bits of a key by which rows are counted in one step, and rows few enough to be ordered.
_DIGIT = 12
_ORDERED_ROWS = 65_536
# Most groups of ids that the first step of a search for positions counts.
_FIRST_BUCKETS = 65_536


def first_of_each_part(points: DataFrame, rows: int, seed: int) -> DataFrame:
    """``(part, point_id, key, features)``: each map task's first points per part.

    ``rows`` of them in the seeded random order, which ``key`` holds. No task
    sorts its points; it keeps the first ones as they go by.
    """

    def first(batches):
        kept = None
        for batch in batches:
            found = [batch.column(c).to_numpy() for c in ("part", "point_id", "key")]
            found.append(feature_matrix(batch.column("features")))
            if kept is not None:
                found = [np.concatenate(x) for x in zip(kept, found)]
            part, ids, key, _ = found
            order = first_rows(part, key, ids, rows)
            kept = [x[order] for x in found]
        if kept is not None and len(kept[0]):
            part, ids, key, matrix = kept
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), pa.array(ids), pa.array(key), feature_column(matrix)],
                names=["part", "point_id", "key", "features"],
            )

    keyed = points.withColumn("key", random_order("point_id", seed))
    return keyed.select("part", "point_id", "key", "features").mapInArrow(
        first, "part bigint, point_id bigint, key bigint, features array<double>"
    )


def _first(points: DataFrame, rows: int, seed: int) -> DataFrame:
    """The first ``rows`` points of a table in the seeded random order.

    Up to 256 tasks merge the map tasks' short lists and one task merges
    theirs, however many map tasks there were.
    """
    lists = first_of_each_part(points.withColumn("part", F.lit(0).cast("bigint")), rows, seed)
    salted = lists.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(_MERGE_TASKS)))
    within = Window.partitionBy("salt").orderBy("key", "point_id")
    kept = salted.withColumn("place", F.row_number().over(within)).filter(F.col("place") <= rows)
    return kept.orderBy("key", "point_id").limit(rows).select("key", "point_id", "features")


def dense_positions(df: DataFrame, id_col: str, *order: str) -> DataFrame:
    """``(position, id)``: ids numbered from 0 in ascending order.

    The ids alone are range-sorted, by the columns in ``order`` if there are
    any, and written; the rows of each sorted partition then give the first
    position of the next.
    """
    ordered = checkpointed(
        df.select(id_col, *(c for c in order if c != id_col))
        .orderBy(*(order or [id_col]))
        .select(id_col, F.monotonically_increasing_id().alias("_mark"))
    )
    split = ordered.withColumn("_split", F.shiftright("_mark", 33))
    sizes = split.groupBy("_split").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_split", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    )
    place = F.col("_mark").bitwiseAND(F.lit((1 << 33) - 1))
    return split.join(broadcast_if_small(starts, starts.count()), "_split").select(
        (F.col("_start") + place).alias("position"), id_col
    )


def first_keys(keyed: DataFrame, rows: int) -> DataFrame:
    """The first ``rows`` rows of a table by (key, point_id), found without sorting it.

    ``key`` has 60 bits, see :func:`random_order`. The rows under each 12 of
    them are counted, then those under the next 12 where the last wanted row
    is, until few enough are left there to order them. The table is read once
    per count and should be written; with fewer rows all are returned.
    """
    prefix, before = 0, 0
    for shift in range(48, -1, -_DIGIT):
        here = keyed.filter(F.shiftright("key", shift + _DIGIT) == prefix)
        counts = here.groupBy(F.shiftright("key", shift).alias("digits")).agg(F.count(F.lit(1)).alias("n"))
        for digits, n in sorted(map(tuple, counts.collect())):
            if before + n >= rows:
                break
            before += n
        else:
            return keyed
        prefix = digits
        if n <= _ORDERED_ROWS:
            break
    rest = keyed.filter(F.shiftright("key", shift) == prefix).orderBy("key", "point_id").limit(rows - before)
    last = rest.agg(F.max(F.struct("key", "point_id")).alias("last")).first()["last"]
    same = (F.col("key") == last["key"]) & (F.col("point_id") <= last["point_id"])
    return keyed.filter((F.col("key") < last["key"]) | same)


def ids_at(ids: DataFrame, positions: np.ndarray) -> np.ndarray:
    """The ids at the given positions in ascending order, found without sorting the table.

    ``ids`` has the column ``point_id`` and is read once per step, so it should
    be written; positions ascend and lie within it. Ids are counted by their
    leading bits, and then by further bits where a wanted position is. The driver gets
    at most ``_ids_at_once()`` counts a step; there can be half as many positions.
    """
    low, high = ids.agg(F.min("point_id"), F.max("point_id")).first()
    most = _ids_at_once()
    shift, before = 0, 64
    while (high >> shift) - (low >> shift) >= min(_FIRST_BUCKETS, most):
        shift += 1
    parents, parent_starts = np.zeros(1, np.int64), np.zeros(1, np.int64)
    rows = ids
    while True:
        bucket = F.shiftright("point_id", shift).alias("bucket")
        counts = rows.groupBy(bucket).agg(F.count(F.lit(1)).alias("n")).toArrow().sort_by("bucket")
        buckets, sizes = (counts[c].to_numpy() for c in ("bucket", "n"))
        starts = np.cumsum(sizes) - sizes
        if before < 64:
            parent = np.searchsorted(parents, buckets >> (before - shift))
            first = np.flatnonzero(np.diff(parent, prepend=-1))
            starts += np.repeat(parent_starts[parent[first]] - starts[first], np.diff(np.append(first, len(parent))))
        at = np.searchsorted(starts, positions, "right") - 1
        if shift == 0:
            return buckets[at]
        held = np.unique(at)
        parents, parent_starts, before = buckets[held], starts[held], shift
        live = broadcast_if_small(ids.sparkSession.createDataFrame(pa.table({"bucket": parents})), len(parents), 16)
        rows = ids.join(live, F.shiftright("point_id", shift) == F.col("bucket"), "left_semi")
        if sizes[held].sum() <= most:
            shift = 0
        else:
            shift = max(0, shift - max(1, int(np.log2(most / len(held)))))


def _ids_at_once() -> int:
    return max(16, session.SMALL_BYTES // 64)


def sample_points(
    points: DataFrame, k: int, seed: int = SEED, with_replacement: bool = False
) -> DataFrame:
    """``(draw, point_id, features)``: a seeded random sample of k points.

    Without replacement these are the k points that come first in the seeded
    random order of their ids. With replacement each draw takes the point at a
    seeded random position in id order, and a point can come up again. Both
    depend on the ids and the seed only, not on how the table is partitioned.

    A sample too large for the map tasks to hold, and one with replacement, is
    found by counting the written ids by their leading bits, again and again
    where more must be known. Only the ids drawn are ever sorted, unless more
    positions are wanted than the driver may hold.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    spark = points.sparkSession
    if not with_replacement:
        if k * (8 * dimension_of(points) + 64) <= session.SMALL_BYTES // 16:
            draw = F.row_number().over(Window.orderBy("key", "point_id"))
            return _first(points, k, seed).select(draw.alias("draw"), "point_id", "features")
        keyed, path = session.written(points.select("point_id", random_order("point_id", seed).alias("key")), "keys")
        places = dense_positions(first_keys(keyed, k), "point_id", "key", "point_id")
        session.discard(spark, path)  # the ordered ids are written by themselves
        drawn = places.select((F.col("position") + 1).cast("int").alias("draw"), "point_id")
    else:
        ids, path = session.written(points.select("point_id"), "ids")
        n = ids.count()
        if n == 0:
            raise ValueError("cannot draw from no points")
        digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"))
        number = F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")
        draws = spark.range(k).select(
            (F.col("id") + 1).cast("int").alias("draw"), F.pmod(number, F.lit(n)).alias("position")
        )
        if 2 * k <= _ids_at_once():
            wanted = np.unique(draws.select("position").toArrow()["position"].to_numpy())
            places = spark.createDataFrame(pa.table({"position": wanted, "point_id": ids_at(ids, wanted)}))
        else:
            places = dense_positions(ids, "point_id")
        session.discard(spark, path)
        drawn = places.join(broadcast_if_small(draws, k), "position").select("draw", "point_id")
    return points.join(broadcast_if_small(drawn, k), "point_id").select("draw", "point_id", "features")
