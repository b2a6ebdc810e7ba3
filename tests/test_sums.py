"""Sums of distances do not depend on order or blocks."""

import math
from fractions import Fraction

import numpy as np
import pytest

import tallyspan as ts
from tallyspan.functions.kernels import ExactSum, distances_to
from tallyspan.operators import blocks


def total(*arrays):
    sums = ExactSum()
    for values in arrays:
        sums.add(values)
    return float(sums)


def test_sum_is_rounded_once():
    rng = np.random.default_rng(1)
    values = np.ldexp(rng.random(5000), rng.integers(-1070, 1000, 5000))
    values[:5] = 0.0, 5e-324, 1e-310, 1.0, 2.0**-1022
    expected = float(sum(map(Fraction, values.tolist())))
    assert total(values) == expected == total(values[::-1][:77], values[::-1][77:])
    small = rng.random(3000) * 1e-300
    assert total(small) == math.fsum(small)
    assert total(np.empty(0)) == 0.0
    assert total(np.array([1.0, np.inf])) == math.inf == total(np.full(4, 1.7e308))


@pytest.mark.parametrize("count", [1, 3, 8])
def test_blocks_change_no_bit(make_points, monkeypatch, count):
    x = np.random.default_rng(2).normal(size=(120, 5)) * np.logspace(-8, 8, 120)[:, None]
    monkeypatch.setattr(blocks, "block_count", lambda *a: count)
    row = blocks.pairwise_distance_sum(make_points(x)).first()
    every = [d for i in range(119) for d in distances_to(x[i + 1 :], x[i]).tolist()]
    assert (row["total"], row["pairs"]) == (math.fsum(every), 120 * 119 // 2)


def test_few_points(make_points):
    points = make_points([(1, 2), (4, 6)])
    assert ts.avg_pairwise_distance(points).first()[0] == 5.0
    assert ts.avg_pairwise_distance(points.filter("point_id = 0")).first()[0] is None
    assert ts.avg_pairwise_distance(points.filter("point_id = 9")).first()[0] is None
