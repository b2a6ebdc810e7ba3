"""Greedy matching from tiles that are opened one after the other."""

import numpy as np
import pyarrow as pa
import pytest

import tallyspan as ts
from tallyspan.operators import matching, tiles


def brute_matching(x, k):
    left, out = list(range(len(x))), []
    d2 = np.square(x[:, None] - x[None]).sum(-1)
    while len(out) < k - k % 2:
        at = np.array(left)
        part = d2[np.ix_(at, at)]
        part[np.tril_indices(len(at))] = -1
        i, j = np.unravel_index(part.argmax(), part.shape)
        out += [left[i], left[j]]
        left = [p for p in left if p not in out[-2:]]
    return out + left[:1] if k % 2 else out


@pytest.fixture
def small_tiles(monkeypatch):
    monkeypatch.setattr(matching, "HEAP_FROM", 0)
    monkeypatch.setattr(tiles, "TILE_ROWS", 15)
    monkeypatch.setattr(tiles, "OPEN_TILES", 1)


CASES = [("normal", 5, 2), ("grid", 5, 2), ("outliers", 40, 6), ("equal", 256, 64), ("grid", 256, 64)]


@pytest.mark.parametrize("kind, lists, life", CASES)
def test_against_brute_force(make_points, monkeypatch, small_tiles, kind, lists, life):
    monkeypatch.setattr(tiles, "LIST_PAIRS", lists)
    monkeypatch.setattr(tiles, "LIFE", life)
    rng = np.random.default_rng(lists)
    x = rng.integers(0, 3, (70, 2)).astype(float) if kind == "grid" else rng.normal(size=(70, 2))
    if kind == "outliers":
        x[[5, 17, 40]] = [[100, 0], [200, 0], [400, 0]]
    if kind == "equal":
        x[:] = 1.0
    k = 25
    found = ts.greedy_matching(make_points(x), k, pair_pool=50).orderBy("rank").collect()
    assert [r["point_id"] for r in found] == brute_matching(x, k)


def test_all_points_but_one(make_points, small_tiles):
    x = np.random.default_rng(9).normal(size=(24, 3))
    found = ts.greedy_matching(make_points(x), 23).orderBy("rank").collect()
    assert [r["point_id"] for r in found] == brute_matching(x, 23)


def test_tiles_that_cannot_hold_the_next_pair_stay_closed(spark):
    rng = np.random.default_rng(4)
    middle = rng.normal(size=(20, 4)) * 3
    x = middle[rng.integers(0, 20, 40_000)] + rng.normal(size=(40_000, 4)) * 0.1
    table = pa.table({"point_id": np.arange(len(x)), "features": list(x)})
    points = ts.points_from_table(spark.createDataFrame(table).repartition(8), dimension=4)
    heap = tiles.TileHeap(points, len(x))
    taken = heap.take(300, matching.PAIR_POOL)
    heap.close()
    assert len(set(taken)) == 600
    # every pass over all block pairs would open all tiles for each 64 of the 300 pairs
    assert heap.opened < 0.5 * len(heap.low) < 0.5 * 5 * len(heap.low)
    d2 = np.square(x[taken[::2]] - x[taken[1::2]]).sum(1)
    assert (np.diff(d2) <= 0).all()
