"""A hierarchy of balls over a point table, and the largest distance by opening pairs of them best-first.

A seeded sample is split again and again around farthest-first centers; that
tree, of bounded size, goes to all tasks. One pass takes every point down to a
leaf and measures the balls' radii. Leaves are cut into blocks of bounded size.
Two points are no further apart than their balls' centers and both radii: pairs
of blocks with a bound below a known distance are never compared, and the
others are compared in rounds, largest bound first, each round raising that
distance for the next. Rounds send their blocks through a shuffle. Where the
bounds leave so many pairs that this would be more than SENT times the table,
all others are compared in a Cartesian product of written blocks, which shuffles
nothing. Only the leading pairs that rounds can compare are written.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan import session
from tallyspan.functions.kernels import FarthestPairs, distances_to, feature_matrix
from tallyspan.functions.keys import SEED, random_order
from tallyspan.operators.blocks import block_count, compare_blocks, grouped_pairs
from tallyspan.session import broadcast_if_small, checkpointed
from tallyspan.sources.points import dimension_of

# Children of a ball, sample points for each block, and the fewest points of a block.
FAN = 8
SAMPLES = 32
LEAST_ROWS = 4_096
# A round compares this many pairs of blocks per core, and the next one GROWTH times as many.
ROUND_PAIRS = 4
GROWTH = 4
# Rounds send at most this many points for each point of the table.
SENT = 4


class Tree:
    """Balls as arrays: centers, children, and for leaves their number; radii and sizes once measured."""

    def __init__(self, sample: np.ndarray, leaf: int):
        centers, children, held = [sample.mean(axis=0)], [[]], [np.arange(len(sample))]
        node = 0
        while node < len(centers):
            own = held[node]
            if len(own) > leaf:
                parts = _split(sample[own])
                for center, rows in parts if len(parts) > 1 else ():
                    children[node].append(len(centers))
                    centers.append(center)
                    children.append([])
                    held.append(own[rows])
            held[node] = np.empty(0, np.int64)
            node += 1
        self.centers = np.array(centers)
        self.children = [np.array(c, np.int64) for c in children]
        self.leaves = np.flatnonzero([not len(c) for c in children])
        self.leaf_of = np.full(len(centers), -1)
        self.leaf_of[self.leaves] = np.arange(len(self.leaves))


def _split(points: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(center, rows) of the points nearest to each of FAN farthest-first points."""
    chosen, best, at = [0], distances_to(points, points[0]), np.zeros(len(points), np.int64)
    while len(chosen) < FAN and best.max() > 0:
        chosen.append(int(best.argmax()))
        dist = distances_to(points, points[chosen[-1]])
        closer = dist < best
        best[closer], at[closer] = dist[closer], len(chosen) - 1
    return [(points[c], np.flatnonzero(at == k)) for k, c in enumerate(chosen) if (at == k).any()]


def _descend(matrix: np.ndarray, centers: np.ndarray, children: list, reached=None) -> np.ndarray:
    """The leaf ball of every row; ``reached(balls, distances)`` hears of all balls on the way."""
    at = np.zeros(len(matrix), np.int64)
    if reached:
        reached(at, distances_to(matrix, centers[0]))
    inner = np.arange(len(matrix))
    while len(inner):
        going = []
        for node in np.unique(at[inner]):
            rows = inner[at[inner] == node]
            if not len(children[node]):
                continue
            best, next_ = np.full(len(rows), np.inf), np.full(len(rows), children[node][0])
            for child in children[node]:
                dist = distances_to(matrix[rows], centers[child])
                closer = dist < best
                best[closer], next_[closer] = dist[closer], child
            at[rows] = next_
            if reached:
                reached(next_, best)
            going.append(rows)
        inner = np.concatenate(going) if going else np.empty(0, np.int64)
    return at


class Balls:
    """Points dealt into blocks by leaf ball, written, and the distances that pairs of blocks cannot exceed."""

    def __init__(self, points: DataFrame, n: int, rows: int):
        spark = points.sparkSession
        dimension = dimension_of(points)
        most = max(FAN, session.SMALL_BYTES // (2 * 8 * max(dimension, 1)))
        wanted = min(n, most, SAMPLES * math.ceil(n / rows))
        order = random_order("point_id", SEED)
        sample = points.orderBy(order, "point_id").limit(wanted).select("features").toArrow()
        self.tree = Tree(feature_matrix(sample["features"]), max(1, SAMPLES // 2))
        centers, children = self.tree.centers, self.tree.children
        kept = points.select("point_id", "features")

        def measure(batches):
            counts, radii = np.zeros(len(centers), np.int64), np.zeros(len(centers))

            def reached(at, dist):
                np.add.at(counts, at, 1)
                np.maximum.at(radii, at, dist)

            for batch in batches:
                _descend(feature_matrix(batch.column("features")), centers, children, reached)
            some = np.flatnonzero(counts)
            arrays = [pa.array(some), pa.array(counts[some]), pa.array(radii[some])]
            yield pa.RecordBatch.from_arrays(arrays, names=["ball", "n", "r"])

        found = kept.mapInArrow(measure, "ball bigint, n bigint, r double").groupBy("ball")
        told = found.agg(F.sum("n").alias("n"), F.max("r").alias("r")).toArrow()  # a row per ball of the tree
        self.counts, self.radii = np.zeros(len(centers), np.int64), np.zeros(len(centers))
        balls = told["ball"].to_numpy()
        self.counts[balls], self.radii[balls] = told["n"].to_numpy(), told["r"].to_numpy()
        self.parts = -(-self.counts[self.tree.leaves] // rows)
        self.first = np.concatenate(([0], np.cumsum(self.parts)))
        self.sizes = self.counts[self.tree.leaves] / np.maximum(self.parts, 1)  # points of a block of each leaf
        first, parts, leaf_of = self.first, self.parts, self.tree.leaf_of

        def deal(batches):
            for batch in batches:
                leaf = leaf_of[_descend(feature_matrix(batch.column("features")), centers, children)]
                ids = batch.column("point_id").to_numpy().astype(np.uint64)
                spread = (ids * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
                block = first[leaf] + (spread % np.maximum(parts[leaf], 1).astype(np.uint64)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block), *batch.columns], names=["block", "point_id", "features"]
                )

        self.placed = checkpointed(kept.mapInArrow(deal, "block bigint, point_id bigint, features array<double>"))
        self.spark, self.blocks, self.dimension = spark, int(self.first[-1]), dimension

    def pairs(self, length: float) -> DataFrame:
        """``(low, high, upper, points)`` of the pairs of blocks that may hold a pair further apart than ``length``.

        ``points`` is how many of them a pair of blocks sends. Every leaf goes
        down the tree from its own side, past the balls that are too close; so
        the balls in between stand for all that they hold.
        """
        tree, radii, counts, first, parts = self.tree, self.radii, self.counts, self.first, self.parts
        sizes, centers, children = self.sizes, tree.centers, tree.children
        leaves, leaf_of = tree.leaves, tree.leaf_of

        def partners(batches):
            for batch in batches:
                for leaf in batch.column("id").to_pylist():
                    ball, nodes, met = leaves[leaf], np.array([0]), []
                    while len(nodes):
                        upper = distances_to(centers[nodes], centers[ball]) + radii[nodes] + radii[ball]
                        far = (upper * (1 + 1e-9) > length) & (counts[nodes] > 0)
                        nodes, upper = nodes[far], upper[far]
                        ends = leaf_of[nodes] >= leaf
                        met += zip(leaf_of[nodes[ends]].tolist(), upper[ends].tolist(), strict=True)
                        nodes = np.concatenate([children[node] for node in nodes] or [np.empty(0, np.int64)])
                    for other, upper in met:
                        a, b = np.arange(first[leaf], first[leaf + 1]), np.arange(first[other], first[other + 1])
                        low, high = np.repeat(a, len(b)), np.tile(b, len(a))
                        low, high = low[low <= high], high[low <= high]
                        points = sizes[leaf] + np.where(low < high, sizes[other], 0.0)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(low), pa.array(high), pa.array(np.full(len(low), upper)), pa.array(points)],
                            names=["low", "high", "upper", "points"],
                        )

        some = np.flatnonzero(parts)
        ids = self.spark.createDataFrame(pa.table({"id": pa.array(some, pa.int64())}))
        tasks = max(1, min(len(some), 4 * self.spark.sparkContext.defaultParallelism))
        return ids.repartition(tasks).mapInArrow(partners, "low bigint, high bigint, upper double, points double")

    def grouped(self, pairs: DataFrame, count: int, placed: DataFrame | None = None):
        """The points (or those of ``placed``) of ``count`` pairs of blocks; no other block is sent anywhere."""
        ends = F.explode(F.array_distinct(F.array("low", "high"))).alias("block")
        wanted = broadcast_if_small(pairs.select("low", "high", ends), 2 * count)
        placed = self.placed if placed is None else placed
        return grouped_pairs(placed.join(wanted, "block"), count)

    def packed(self, rows: int) -> DataFrame:
        """``(group, blocks, sizes, coordinates)``: neighbouring blocks of about ``rows`` points as one row.

        Every partition holds one row. The points are shuffled once.
        """
        sizes = np.repeat(self.sizes, self.parts)
        group = np.unique((np.cumsum(sizes) - sizes) // rows, return_inverse=True)[1]
        dealt = pa.table({"block": pa.array(range(self.blocks), pa.int64()), "group": pa.array(group, pa.int32())})
        told = broadcast_if_small(self.spark.createDataFrame(dealt), self.blocks)

        def pack(batches):
            held = [batch for batch in batches if batch.num_rows]
            if held:
                table = pa.Table.from_batches(held)
                block = table["block"].to_numpy()
                blocks, sizes = np.unique(block, return_counts=True)
                matrix = feature_matrix(table["features"])[np.argsort(block, kind="stable")]
                columns = [table["group"][0].as_py()], [blocks], [sizes], [matrix.tobytes()]
                kinds = pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()
                arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=["group", "blocks", "sizes", "coordinates"])

        spread = self.placed.join(told, "block").repartitionById(int(group[-1]) + 1, "group")
        schema = "group int, blocks array<bigint>, sizes array<bigint>, coordinates binary"
        return checkpointed(spread.mapInArrow(pack, schema))

    def largest(self, rows: int, length: float, cut: float | None) -> tuple[float, int]:
        """The largest distance if it is over ``length``, and the pairs of blocks compared for it.

        Pairs of blocks that cannot exceed ``length`` are left out, and those
        that may reach ``cut``. A task reads two rows of blocks from where they
        are written.
        """
        tree, radii, first, dimension = self.tree, self.radii, self.first, self.dimension
        centers, leaves = tree.centers, tree.leaves

        def blocks_of(batch, at, side):
            matrix = np.frombuffer(batch.column(f"coordinates_{side}")[at].as_buffer()).reshape(-1, dimension)
            blocks, sizes = (batch.column(f"{name}_{side}")[at].values.to_numpy() for name in ("blocks", "sizes"))
            leaf = leaves[np.searchsorted(first, blocks, "right") - 1]
            return blocks, leaf, np.split(matrix, np.cumsum(sizes)[:-1])

        def compare(batches):
            best, opened = FarthestPairs(1, (length * (1 - 1e-9)) ** 2), 0
            for batch in batches:
                for at in range(batch.num_rows):
                    low, low_leaf, a = blocks_of(batch, at, "low")
                    high, high_leaf, b = blocks_of(batch, at, "high")
                    met = []
                    for i, ball in enumerate(low_leaf):
                        upper = distances_to(centers[high_leaf], centers[ball]) + radii[high_leaf] + radii[ball]
                        due = (high >= low[i]) & (upper * (1 + 1e-9) > length)
                        if cut is not None:
                            due &= upper < cut
                        met += [(upper[j], i, j) for j in np.flatnonzero(due)]
                    for upper, i, j in sorted(met, reverse=True):
                        if len(best.d2) and upper * (1 + 1e-9) <= np.sqrt(best.d2[0]):
                            break
                        opened += 1
                        best.compare(np.arange(len(a[i])), a[i], np.arange(len(b[j])), b[j], low[i] == high[j])
            found = np.sqrt(best.d2)
            yield pa.RecordBatch.from_arrays([pa.array([*found, length][:1]), pa.array([opened])], names=["d", "pairs"])

        packed = self.packed(rows)
        low, high = (packed.select(*(F.col(c).alias(f"{c}_{side}") for c in packed.columns)) for side in ("low", "high"))
        # without the hint Spark may guess the blocks small and send them through the driver
        both = low.hint("shuffle_replicate_nl").crossJoin(high).where("group_low <= group_high")
        found = both.mapInArrow(compare, "d double, pairs bigint").agg(F.max("d"), F.sum("pairs")).first()
        return max(length, found[0]), found[1]


def farthest_distance(points: DataFrame, n: int, length: float) -> tuple[float, int, int]:
    """The largest distance of two of the ``n`` written points, the pairs of blocks compared, and those there are.

    ``length`` is the distance of some pair, or 0. A round returns one number.
    What is shuffled and written grows with the points, not with the pairs of
    blocks: rounds send at most SENT times the points.
    """
    cores = points.sparkSession.sparkContext.defaultParallelism
    together = -(-n // block_count(n, dimension_of(points), cores))
    balls = Balls(points, n, max(LEAST_ROWS, together // 4))
    most, total = SENT * balls.blocks // 2, balls.blocks * (balls.blocks + 1) // 2
    upper = F.col("upper")
    leading = checkpointed(balls.pairs(length).orderBy(F.desc("upper")).limit(most + 1))
    rest = None  # pairs with this bound or a lower one need not be among the leading
    if leading.count() > most:
        rest = leading.agg(F.min("upper")).first()[0]
        leading = leading.where(upper > rest)
    opened, sent, cut, wanted = 0, 0.0, None, min(ROUND_PAIRS * cores, balls.blocks)
    while True:
        below = leading.where(upper * (1 + 1e-9) > length)
        below = below if cut is None else below.where(upper < cut)
        least, some = below.orderBy(F.desc("upper")).limit(wanted).agg(F.min("upper"), F.count("upper")).first()
        if not some and (rest is None or rest * (1 + 1e-9) <= length):
            return length, opened, total
        now = below.where(upper >= least) if some else below
        count, more = now.agg(F.count("upper"), F.sum("points")).first()  # with ties, more than were asked for
        if not some or sent + more > SENT * n:
            length, others = balls.largest(together, length, cut)
            return length, opened + others, total
        found = compare_blocks(balls.grouped(now, count), 1, (length * (1 - 1e-9)) ** 2)
        length = max(length, found.agg(F.coalesce(F.sqrt(F.max("d2")), F.lit(0.0))).first()[0])
        opened, sent, cut, wanted = opened + count, sent + more, least, wanted * GROWTH
