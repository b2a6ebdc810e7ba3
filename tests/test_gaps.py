"""Distances ruled out by the triangle inequality change no nearest center."""

import numpy as np
import pytest

import tallyspan as ts
from tallyspan import session
from tallyspan.functions.gaps import gap_table, shrink
from tallyspan.functions.kernels import distances_to
from tallyspan.operators import centers


def farthest_first(x, k):
    """Numbers of k centers, and after each generation of 128 the distances and owners."""
    near, own, chosen, states = np.full(len(x), np.inf), np.full(len(x), -1, np.int32), [0], {}
    for turn in range(k):
        if turn % 128 == 0:
            states[turn] = near.copy(), own.copy()
        dist = distances_to(x, x[chosen[turn]])
        closer = dist < near
        near[closer], own[closer] = dist[closer], turn
        chosen.append(int(near.argmax()))
    return chosen[:k], near, states


def table(vectors, low, high, dropped=0):
    rows = [distances_to(vectors[dropped:t], vectors[t]) for t in range(low, high)]
    return gap_table([vectors[dropped:low]], [list(vectors[low:high])], [rows], [dropped])


def test_few_distances_are_measured_late_in_a_traversal():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(150, 8))[rng.integers(0, 150, 200_000)] * 5 + rng.normal(size=(200_000, 8)) * 0.2
    chosen, expected, states = farthest_first(x, 500)
    vectors = x[chosen]
    near, own = (part.copy() for part in states[256])
    measured = 0
    for low, high in ((256, 384), (384, 500)):
        gaps, starts = table(vectors, low, high), np.array([0, high - low])
        for first in range(0, len(x), 10_000):
            some = slice(first, first + 10_000)
            at = np.zeros(10_000, np.int64)
            measured += shrink(x[some], at, near[some], own[some], vectors[low:high], starts, gaps)
    assert np.array_equal(near, expected)
    assert measured < 0.02 * len(x) * (500 - 256)


@pytest.mark.parametrize("grid", [False, True])
@pytest.mark.parametrize("dropped", [0, 7, 30])
def test_outcome_is_that_of_all_distances(grid, dropped):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 6, (900, 2)).astype(float) if grid else rng.normal(size=(900, 2))
    scale = np.array([1.0, 1e-160, 1e153])[rng.integers(0, 3, 900)]
    for points in (x, x * scale[:, None]):
        vectors = points[rng.permutation(900)[:90]]
        with np.errstate(over="ignore", under="ignore"):
            every = np.array([distances_to(points, v) for v in vectors])
            near, own = every[:30].min(0), every[:30].argmin(0).astype(np.int32)
            shrink(points, np.zeros(900, np.int64), near, own, vectors[30:], np.array([0, 60]), table(vectors, 30, 90, dropped))
        assert np.array_equal(near, every.min(0))
        assert np.array_equal(every[own, np.arange(900)], near)


def test_parts_of_unequal_numbers_of_centers():
    rng = np.random.default_rng(4)
    x, at = rng.normal(size=(600, 3)), rng.integers(0, 3, 600)
    found = [[x[rows[i]] for i in range(size)] for size, rows in ((size, np.flatnonzero(at == p)) for p, size in enumerate((1, 5, 40)))]
    rows = [[distances_to(np.array(vs[:t]).reshape(-1, 3), v) for t, v in enumerate(vs)] for vs in found]
    gaps = gap_table([np.empty((0, 3))] * 3, found, rows, [0, 0, 0])
    near, own = np.full(600, np.nan), np.full(600, -1, np.int32)
    shrink(x, at, near, own, np.array([v for vs in found for v in vs]), np.array([0, 1, 6, 46]), gaps)
    for p, vectors in enumerate(found):
        every = np.array([distances_to(x[at == p], v) for v in vectors])
        assert np.array_equal(near[at == p], every.min(0))


@pytest.mark.parametrize(("refresh", "limit"), [(3, 64 << 20), (3, 60_000), (8, 20_000)])
def test_traversal_with_and_without_known_gaps(make_points, monkeypatch, refresh, limit):
    monkeypatch.setattr(centers, "REFRESH_AFTER", refresh)
    monkeypatch.setattr(session, "SMALL_BYTES", limit)
    rng = np.random.default_rng(6)
    x = rng.integers(0, 9, (400, 3)).astype(float)
    found = ts.k_center(make_points(x), 40, first_ids=[0]).orderBy("rank").collect()
    chosen, near = [0], distances_to(x, x[0])
    while len(chosen) < 40:
        open_ = np.setdiff1d(np.arange(400), chosen)
        chosen.append(int(open_[np.lexsort((open_, -near[open_]))[0]]))
        near = np.fmin(near, distances_to(x, x[chosen[-1]]))
    assert [r["point_id"] for r in found] == chosen
