"""Size bounds change plans, never answers; odd coordinates are refused or counted in full."""

import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

import tallyspan as ts
from tallyspan import session
from tallyspan.operators import blocks, centers, matching
from tallyspan.operators.centers import _Centers


@pytest.mark.parametrize("limit", [session.SMALL_BYTES, 3000, 1000])
def test_ties_of_permuted_coordinates_do_not_depend_on_the_bound(make_points, monkeypatch, limit):
    monkeypatch.setattr(session, "SMALL_BYTES", limit)
    rng = np.random.default_rng(1)
    one = rng.normal(size=64)
    x = np.array([np.zeros(64), *(rng.permutation(one) for _ in range(79))])
    points = make_points(x).withColumn("part", F.lit(3).cast("bigint"))
    found = ts.k_center(points, 5, num_parts=2, first_ids=[0]).orderBy("rank").collect()
    monkeypatch.undo()
    expected = ts.k_center(make_points(x), 5, first_ids=[0]).orderBy("rank").collect()
    assert [(r["point_id"], r["distance"]) for r in found] == [(r["point_id"], r["distance"]) for r in expected]


def test_distances_beyond_the_largest_number_count(make_points):
    points = make_points([(0, 0), (1e200, 0), (3, 4), (-1e200, 5)])
    found = ts.k_center(points, 3, first_ids=[0]).orderBy("rank").collect()
    assert [r["point_id"] for r in found] == [0, 1, 3]
    assert [r["distance"] for r in found] == [None, math.inf, math.inf]
    near = ts.min_distance(points, points.filter("point_id = 0")).orderBy("point_id").collect()
    assert [r["min_dist"] for r in near] == [0.0, math.inf, 5.0, math.inf]


def test_missing_coordinates_are_refused(spark):
    rows = [(0, [0.0, 1.0]), (1, [3.0, None]), (2, [1.0, 1.0]), (3, [None, None])]
    raw = spark.createDataFrame(rows, "point_id bigint, features array<double>")
    for bad in (raw, raw.filter("point_id <> 3")):
        with pytest.raises(Exception, match="infinite or missing"):
            ts.points_from_table(bad).count()
        with pytest.raises(Exception, match="infinite or missing"):
            ts.k_center(bad, 2).collect()


def test_lines_pass_the_checks_of_points(spark):
    lines = lambda values: spark.createDataFrame(list(enumerate(values)), "position bigint, value string")
    found = ts.decode_points(lines(["1,2", "NaN,3", "4,5"])).collect()
    assert [(r["point_id"], r["features"]) for r in found] == [(0, [1.0, 2.0]), (2, [4.0, 5.0])]
    for bad, message in ((["1,2", "3"], "does not have 2"), (["1,2", "Infinity,0"], "infinite")):
        with pytest.raises(Exception, match=message):
            ts.decode_points(lines(bad)).collect()


@pytest.mark.parametrize("n", [9_000, 12_000])
def test_a_missing_number_changes_no_largest_distance(spark, n):
    x = np.random.default_rng(2).normal(size=(n, 3))
    texts = [",".join(map(repr, row.tolist())) for row in x]
    texts[n // 2] = "NaN,0,0"
    lines = spark.createDataFrame(list(enumerate(texts)), "position bigint, value string")
    kept = np.delete(x, n // 2, 0)
    far = kept[np.square(kept).sum(1) > 4]
    expected = np.sqrt(max(np.square(far - row).sum(1).max() for row in far))
    assert ts.exact_mpd(ts.decode_points(lines)).first()[0] == pytest.approx(expected, abs=1e-12)


def test_centers_of_skewed_parts_stay_small():
    rows = [(part, part, [0.0] * 64) for part in range(500)]
    centers = _Centers(rows)
    for i in range(500):
        centers.add(7, 1000 + i, [1.0] * 64, 1.0, False)
    vectors, starts = centers.flat()
    assert vectors.nbytes + starts.nbytes < 1 << 20
    assert vectors[starts[7] : starts[8]].sum() == 500 * 64


def brute_matching(x, k):
    left, taken = list(range(len(x))), []
    d2 = np.square(x[:, None] - x[None]).sum(-1)
    while len(taken) < k - k % 2:
        pairs = [(-d2[i, j], i, j) for a, i in enumerate(left) for j in left[a + 1 :]]
        _, i, j = min(pairs)
        taken += [i, j]
        left = [p for p in left if p not in (i, j)]
    return taken + ([left[0]] if k % 2 else [])


@pytest.mark.parametrize(("pool", "settle"), [(4096, 64), (50, 64), (7, 2), (1, 1)])
@pytest.mark.parametrize("grid", [False, True])
def test_matching_with_outliers_is_exact(make_points, monkeypatch, pool, settle, grid):
    monkeypatch.setattr(matching, "PASS_PAIRS", settle)
    rng = np.random.default_rng(4)
    x = rng.integers(0, 3, (60, 2)).astype(float) if grid else rng.normal(size=(60, 2))
    x[[5, 17, 40]] = [[100, 0], [200, 0], [400, 0]]
    found = ts.greedy_matching(make_points(x), 9, pair_pool=pool).orderBy("rank").collect()
    assert [r["point_id"] for r in found] == brute_matching(x, 9)


def test_outliers_do_not_cost_passes(make_points, monkeypatch):
    passes = []
    plain = blocks.leading_pairs
    monkeypatch.setattr(matching, "leading_pairs", lambda *a: passes.append(1) or plain(*a))
    rng = np.random.default_rng(5)
    x = np.vstack([rng.normal(size=(3000, 2)), [[100.0 * 2**i, 0] for i in range(10)]])
    found = ts.greedy_matching(make_points(x), 10).orderBy("rank").collect()
    assert len(passes) <= 2
    assert 3009 in [r["point_id"] for r in found[:2]]


def test_all_points_are_numbered_without_one_window(make_points):
    points = make_points([(i, 0) for i in range(20)])
    found = ts.greedy_matching(points, 25).orderBy("rank").collect()
    assert [(r["rank"], r["point_id"]) for r in found] == [(i + 1, i) for i in range(20)]


def test_superseded_tables_are_deleted(spark, make_points, monkeypatch):
    monkeypatch.setattr(centers, "REFRESH_AFTER", 2)
    folder = session.checkpoint_folder(spark).removeprefix("file:")
    most, plain = [], session.written

    def tables():
        return {name for name in os.listdir(folder) if name.startswith("tallyspan-")}

    before = tables()
    monkeypatch.setattr(session, "written", lambda *a: (plain(*a), most.append(len(tables() - before)))[0])
    found = ts.k_center(make_points(np.random.default_rng(1).normal(size=(60, 2))), 11)
    assert found.count() == 11
    assert len(most) >= 3 and max(most) <= 3  # the points, a generation, and the one before it
    assert tables() == before
