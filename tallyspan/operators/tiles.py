"""Farthest pairs in order, again and again, from pairs of blocks that are opened only when they may hold the next one.

Points lie in blocks by ball. A pair of blocks, a tile, has a limit: no pair of
its points that is not in its written list comes before the limit in the order
of pairs, by distance, largest first, and then by ids. An unopened tile's limit
is what its balls allow. Opening one compares its remaining points and writes
its first pairs; its limit is then the last of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.functions.kernels import FarthestPairs
from tallyspan.operators.balls import Balls
from tallyspan.operators.blocks import sides
from tallyspan.session import broadcast_if_small, discard, written

# Points of a block, and the most blocks; so the driver keeps the limits of 524,800 tiles at most.
TILE_ROWS = 2_048
TILE_BLOCKS = 1_024
# Pairs in a tile's list, and those that may be taken before a list without a point's later pairs is too old.
LIST_PAIRS = 256
LIFE = 64
# Tiles opened at once for each core.
OPEN_TILES = 4

_NONE = -np.inf


class TileHeap:
    """The tiles of ``n`` written points: their limits on the driver, their lists in a written table."""

    def __init__(self, points: DataFrame, n: int):
        self.spark = points.sparkSession
        self.balls = Balls(points, n, max(TILE_ROWS, -(-n // TILE_BLOCKS)))
        tiles = self.balls.pairs(-1.0).drop("points").toArrow()  # a row per tile
        self.low, self.high = tiles["low"].to_numpy(), tiles["high"].to_numpy()
        upper = tiles["upper"].to_numpy() * (1 + 1e-9)
        count = len(upper)
        # a limit is (squared distance, i, j); ids of -1 come before all pairs of that distance
        self.d2, self.i, self.j = upper**2, np.full(count, -1), np.full(count, -1)
        self.omitted, self.opened_at = np.full(count, _NONE), np.zeros(count, np.int64)
        self.taken: list[int] = []
        self.lists: DataFrame | None = None
        self.path: str | None = None
        self.opened = 0

    def _limits(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        old = (len(self.taken) // 2 - self.opened_at >= LIFE) & (self.omitted >= self.d2)
        return np.where(old, self.omitted, self.d2), np.where(old, -1, self.i), np.where(old, -1, self.j)

    def _used(self) -> DataFrame:
        ids = self.spark.createDataFrame(pa.table({"point_id": pa.array(self.taken, pa.int64())}))
        return broadcast_if_small(ids, len(self.taken))

    def _listed(self) -> DataFrame | None:
        """The listed pairs of points that are not taken."""
        if self.lists is None or not self.taken:
            return self.lists
        used = self._used()
        left = self.lists.join(used.withColumnRenamed("point_id", "i"), "i", "left_anti")
        return left.join(used.withColumnRenamed("point_id", "j"), "j", "left_anti")

    def _open(self, tiles: np.ndarray) -> None:
        chosen = pa.table({"low": self.low[tiles], "high": self.high[tiles]})
        wanted = self.spark.createDataFrame(chosen)
        placed = self.balls.placed
        if self.taken:
            placed = placed.join(self._used(), "point_id", "left_anti")
        rows, cap = LIST_PAIRS, 2 * LIFE - 1

        def first_pairs(table: pa.Table) -> pa.Table:
            (ids_a, a), (ids_b, b), same = sides(table)
            best = FarthestPairs(rows, cap=cap)
            if len(a) and len(b):
                best.compare(ids_a, a, ids_b, b, same)
            n, full = len(best.d2), len(best.d2) == rows
            # a point's pairs after its first ``cap`` are not listed, nor further apart than the last that is
            ends, count = np.unique(np.concatenate([best.i, best.j]), return_counts=True)
            capped = np.isin(best.i, ends[count >= cap]) | np.isin(best.j, ends[count >= cap])
            omitted = float(best.d2[capped].max()) if capped.any() else _NONE
            limit = (best.i[-1], best.j[-1], best.d2[-1]) if full else (-1, -1, _NONE)
            return pa.table(
                {
                    "low": pa.array([table["low"][0].as_py()] * (n + 1), pa.int64()),
                    "high": pa.array([table["high"][0].as_py()] * (n + 1), pa.int64()),
                    "i": pa.array([*best.i.tolist(), int(limit[0])], pa.int64()),
                    "j": pa.array([*best.j.tolist(), int(limit[1])], pa.int64()),
                    "d2": pa.array([*best.d2.tolist(), float(limit[2])], pa.float64()),
                    "omitted": pa.array([None] * n + [omitted], pa.float64()),
                }
            )

        schema = "low bigint, high bigint, i bigint, j bigint, d2 double, omitted double"
        found = self.balls.grouped(wanted, len(tiles), placed).applyInArrow(first_pairs, schema)
        kept, before = self._listed(), self.path
        if kept is not None:
            again = broadcast_if_small(wanted, len(tiles))
            kept = kept.join(again, ["low", "high"], "left_anti").withColumn("omitted", F.lit(None).cast("double"))
            found = found.unionByName(kept.select(found.columns))
        table, self.path = written(found, "lists")
        if before:
            discard(self.spark, before)
        self.lists = table.where("omitted IS NULL").drop("omitted")
        told = table.where("omitted IS NOT NULL").toArrow()  # a row per opened tile
        self.d2[tiles], self.i[tiles], self.j[tiles], self.omitted[tiles] = _NONE, -1, -1, _NONE
        self.opened_at[tiles] = len(self.taken) // 2
        place = {pair: k for k, pair in zip(tiles.tolist(), zip(self.low[tiles], self.high[tiles], strict=True), strict=True)}
        for row in told.to_pylist():
            k = place[row["low"], row["high"]]
            self.d2[k], self.i[k], self.j[k], self.omitted[k] = row["d2"], row["i"], row["j"], row["omitted"]
        self.opened += len(tiles)

    def take(self, rounds: int, pool: int) -> list[int]:
        """The ids of ``rounds`` pairs: each time the first pair of the points not taken before.

        At most ``pool`` listed pairs reach the driver at once.
        """
        cores = self.spark.sparkContext.defaultParallelism
        while len(self.taken) < 2 * rounds:
            d2, i, j = self._limits()
            first = np.lexsort((j, i, -d2))
            limit = tuple(float(d2[first[0]]) if x is d2 else int(x[first[0]]) for x in (d2, i, j))
            listed = self._listed()
            pairs = []
            if listed is not None:
                pairs = listed.orderBy(F.desc("d2"), "i", "j").select("i", "j", "d2").limit(pool).collect()
            sure = [p for p in pairs if (-p["d2"], p["i"], p["j"]) <= (-limit[0], limit[1], limit[2])]
            if sure:
                self._settle(sure, rounds)
                continue
            # open what may hold a pair before the first one listed
            best = (-pairs[0]["d2"], pairs[0]["i"], pairs[0]["j"]) if pairs else (np.inf, 0, 0)
            may = [k for k in first[: OPEN_TILES * cores] if d2[k] > _NONE and (-d2[k], i[k], j[k]) < best]
            if not may:
                break
            self._open(np.array(may))
        return self.taken

    def _settle(self, sure: list, rounds: int) -> None:
        """Take the sure pairs in order, until a list with left out pairs is too old."""
        done = len(self.taken) // 2
        young = (self.omitted > _NONE) & (done - self.opened_at < LIFE)
        most = int((LIFE - (done - self.opened_at[young])).min()) if young.any() else rounds
        used: set[int] = set()
        for pair in sure:
            if len(used) == 2 * min(most, rounds - done):
                break
            if pair["i"] not in used and pair["j"] not in used:
                self.taken += [pair["i"], pair["j"]]
                used |= {pair["i"], pair["j"]}

    def close(self) -> None:
        if self.path:
            discard(self.spark, self.path)
