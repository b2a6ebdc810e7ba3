"""Against plain brute force on small random tables, with many ties."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import tallyspan as ts
from tallyspan import session
from tallyspan.functions.kernels import FarthestPairs, distance_sum
from tallyspan.operators import blocks, centers, diameter


def grid(n, width, seed, high=6):
    return np.random.default_rng(seed).integers(0, high, size=(n, width)).astype(float)


def order_key(i):
    return int(hashlib.md5(f"{ts.SEED}:{i}".encode()).hexdigest()[:15], 16)


def brute_centers(x, ids, k):
    """[(id, distance)] of the farthest-first traversal, ties to the lowest id."""
    left = list(ids)
    first = min(left, key=lambda i: (order_key(i), i))
    out = [(first, None)]
    left.remove(first)
    near = {i: np.sqrt(((x[i] - x[first]) ** 2).sum()) for i in left}
    while left and len(out) < k:
        best = max(left, key=lambda i: (near[i], -i))
        out.append((best, near[best]))
        left.remove(best)
        near = {i: min(near[i], np.sqrt(((x[i] - x[best]) ** 2).sum())) for i in left}
    return out


def brute_pairs(x, ids):
    pairs = [(-((x[i] - x[j]) ** 2).sum(), i, j) for i in ids for j in ids if i < j]
    return [(i, j, -d) for d, i, j in sorted(pairs)]


def brute_matching(x, ids, k):
    if k >= len(ids):
        return sorted(ids)
    taken = []
    for i, j, _ in brute_pairs(x, ids):
        if len(taken) < k - k % 2 and i not in taken and j not in taken:
            taken += [i, j]
    return taken + ([min(set(ids) - set(taken))] if k % 2 else [])


def by_part(found):
    out = {}
    for r in found.orderBy("part", "rank").collect():
        out.setdefault(r["part"], []).append((r["point_id"], r["distance"]))
    return out


@pytest.mark.parametrize("pool", [1, 3, 64])
@pytest.mark.parametrize("refresh", [2, 64])
def test_k_center_is_exact(make_points, monkeypatch, pool, refresh):
    monkeypatch.setattr(centers, "REFRESH_AFTER", refresh)
    x = grid(150, 2, seed=pool)
    found = ts.k_center(make_points(x, slices=4), 12, pool_rows=pool)
    assert by_part(found)[0] == brute_centers(x, range(150), 12)


def test_k_center_takes_all_points_once(make_points):
    x = grid(40, 2, seed=9, high=3)
    found = by_part(ts.k_center(make_points(x).withColumn("part", F.lit(0)), 60, num_parts=1, pool_rows=8))[0]
    assert found == brute_centers(x, range(40), 60)
    assert sorted(i for i, _ in found) == list(range(40))


@pytest.mark.parametrize("limit", [session.SMALL_BYTES, 1500, 600])
def test_skewed_parts(make_points, monkeypatch, limit):
    """One part holds two thirds of the points; with and without room for centers."""
    monkeypatch.setattr(session, "SMALL_BYTES", limit)
    x = grid(120, 3, seed=4)
    part = F.when(F.col("point_id") % 3 == 0, F.col("point_id") % 5).otherwise(7).cast("bigint")
    found = by_part(ts.k_center(make_points(x).withColumn("part", part), 6, num_parts=8))
    groups = {}
    for i in range(120):
        groups.setdefault(i % 5 if i % 3 == 0 else 7, []).append(i)
    assert found == {p: brute_centers(x, ids, 6) for p, ids in groups.items()}


@pytest.mark.parametrize("limit", [session.SMALL_BYTES, 250])
def test_parts_without_a_first_center_give_none(make_points, monkeypatch, limit):
    monkeypatch.setattr(session, "SMALL_BYTES", limit)
    x = grid(40, 2, seed=11)
    points = make_points(x).withColumn("part", F.col("point_id") % 4)
    found = by_part(ts.k_center(points, 3, num_parts=4, first_ids=[5, 10]))
    assert {part: rows[0][0] for part, rows in found.items()} == {1: 5, 2: 10}
    assert all(len(rows) == 3 for rows in found.values())


@pytest.mark.parametrize("limit", [session.SMALL_BYTES, 250])
def test_too_many_parts_are_refused(make_points, monkeypatch, limit):
    monkeypatch.setattr(session, "SMALL_BYTES", limit)
    points = make_points(grid(9, 2, 1)).withColumn("part", F.col("point_id"))
    with pytest.raises(ValueError):
        ts.k_center(points, 2, num_parts=3)


def test_radii_never_increase_and_partitioning_does_not_matter(make_points):
    x = np.random.default_rng(5).normal(size=(300, 4))
    one = by_part(ts.k_center(make_points(x, slices=1), 15))
    many = by_part(ts.k_center(make_points(x, slices=7), 15, pool_rows=5))
    assert one == many
    radii = [d for _, d in one[0][1:]]
    assert radii == sorted(radii, reverse=True)


def test_physical_coreset(make_points):
    x = grid(60, 2, seed=6)
    found = by_part(ts.coreset(make_points(x), 4, 3, partitioning="physical"))
    chosen = [i for part in found.values() for i, _ in part]
    assert len(found) == 3 and len(set(chosen)) == 12


@pytest.mark.parametrize("limit", [session.SMALL_BYTES, 300])
def test_min_distance(make_points, monkeypatch, limit):
    monkeypatch.setattr(session, "SMALL_BYTES", limit)
    x = grid(80, 2, seed=2)
    points = make_points(x)
    chosen = [3, 14, 15, 65, 79]
    near = ts.min_distance(points, points.filter(F.col("point_id").isin(chosen)))
    expected = np.sqrt(((x[:, None, :] - x[chosen][None]) ** 2).sum(-1)).min(1)
    assert [r["min_dist"] for r in near.orderBy("point_id").collect()] == expected.tolist()


def test_min_distance_by_part(make_points):
    x = grid(40, 2, seed=3)
    points = make_points(x).withColumn("part", F.col("point_id") % 4)
    chosen = [0, 4, 1]
    near = ts.min_distance(points, points.filter(F.col("point_id").isin(chosen))).collect()
    assert {r["point_id"] for r in near} == {i for i in range(40) if i % 4 < 2}
    for r in near:
        own = [c for c in chosen if c % 4 == r["part"]]
        assert r["min_dist"] == min(np.sqrt(((x[r["point_id"]] - x[c]) ** 2).sum()) for c in own)


@pytest.mark.parametrize("rows", [1, 5, 400, 10_000])
def test_farthest_pairs(make_points, monkeypatch, rows):
    monkeypatch.setattr(blocks, "BLOCK_ROWS", 17)
    x = grid(90, 2, seed=rows)
    found = [tuple(r) for r in ts.farthest_pairs(make_points(x), rows).collect()]
    assert found == brute_pairs(x, range(90))[:rows]


def test_average_distance_in_blocks(make_points, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_ROWS", 11)
    x = np.random.default_rng(8).normal(size=(70, 5))
    total, pairs = ts.pairwise_distance_sum(make_points(x)).first()
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    assert pairs == 70 * 69 // 2 and np.isclose(total, d.sum() / 2)


@pytest.mark.parametrize("pool", [1, 2, 7, 4096])
@pytest.mark.parametrize("k", [2, 7, 12])
def test_greedy_matching_is_exact(make_points, pool, k):
    x = grid(30, 2, seed=k)
    found = ts.greedy_matching(make_points(x), k, pair_pool=pool).orderBy("rank").collect()
    assert [r["rank"] for r in found] == list(range(1, k + 1))
    assert [r["point_id"] for r in found] == brute_matching(x, range(30), k)
    assert all(r["features"] == x[r["point_id"]].tolist() for r in found)


@pytest.mark.parametrize("offset, scale", [(0, 1), (1e6, 1), (1e12, 1e-3), (-1e9, 1e5), (0, 1e-160)])
def test_pair_kernel_is_exact_far_from_the_origin(offset, scale):
    """The matrix product only preselects: rounding never decides a pair."""
    x = offset + scale * np.random.default_rng(1).normal(size=(300, 3))
    x[150:170] = x[0]
    ids = np.arange(300)
    for rows in (1, 10, 500):
        best = FarthestPairs(rows)
        best.compare(ids[:120], x[:120], ids[:120], x[:120], True)
        best.compare(ids[:120], x[:120], ids[120:], x[120:], False)
        best.compare(ids[120:], x[120:], ids[120:], x[120:], True)
        i, j = np.triu_indices(300, 1)
        d2 = np.square(x[i] - x[j]).sum(axis=1)
        first = np.lexsort((j, i, -d2))[:rows]
        assert best.i.tolist() == i[first].tolist() and best.j.tolist() == j[first].tolist()
        assert best.d2.tolist() == d2[first].tolist()


@pytest.mark.parametrize("width", [2, 8])
def test_pair_kernel_skips_tiles_exactly(width):
    x = np.random.default_rng(width).normal(size=(3000, width))
    i, j = np.triu_indices(3000, 1)
    d2 = np.square(x[i] - x[j]).sum(axis=1)
    first = np.lexsort((j, i, -d2))[:20]
    for floor in (-np.inf, 0.0, d2[first[-1]]):
        best = FarthestPairs(20, floor)
        best.compare(np.arange(3000), x, np.arange(3000), x, True)
        assert best.i.tolist() == i[first].tolist() and best.j.tolist() == j[first].tolist()


def test_distance_sum_kernel():
    x = grid(20, 3, seed=1)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    for found, expected in (
        (distance_sum(x, x, True), (d.sum() / 2, 190)),
        (distance_sum(x[:5], x[5:], False), (d[:5, 5:].sum(), 75)),
    ):
        assert np.allclose(tuple(map(float, found)), expected)


@pytest.mark.parametrize("width", [1, 2, 5])
def test_outer_points_keep_the_longest_pair(make_points, width):
    x = 100 + np.random.default_rng(width).normal(size=(400, width))
    points = make_points(x)
    assert diameter.outer_points(points, 400)[0].count() < 400
    d = np.sqrt(np.square(x[:, None] - x[None]).sum(-1))
    assert ts.exact_mpd(points).first()[0] == pytest.approx(d.max(), abs=1e-12)


def test_outer_points_of_equal_points(make_points):
    assert ts.exact_mpd(make_points([(0.1, 0.7)] * 30)).first()[0] == 0.0


def test_bounds_of_the_approximations(make_points):
    for seed in range(3):
        points = make_points(np.random.default_rng(seed).normal(size=(100, 3)))
        exact = ts.exact_mpd(points).first()[0]
        sampled = ts.two_approx_mpd(points, 4).first()[0]
        repeated = ts.two_approx_mpd(points, 4, with_replacement=True).first()[0]
        by_centers = ts.k_center_mpd(points, 4).first()[0]
        assert sampled <= exact <= 2 * sampled
        assert repeated <= exact <= 2 * repeated
        assert by_centers <= exact
        compared = {r["algorithm"]: r["max_distance"] for r in ts.mpd_compare(points, 4).collect()}
        assert compared == {"exact": exact, "sample": sampled, "k_center": by_centers}


def test_large_sample_is_read_in_shares(make_points, monkeypatch):
    monkeypatch.setattr(session, "SMALL_BYTES", 400)
    x = grid(60, 2, seed=1)
    found = ts.two_approx_mpd(make_points(x), 20).first()[0]
    chosen = sorted(range(60), key=lambda i: (order_key(i), i))[:20]
    assert found == np.sqrt(((x[:, None] - x[chosen][None]) ** 2).sum(-1)).max()


@pytest.mark.parametrize("limit", [session.SMALL_BYTES, 250])
def test_samples(make_points, monkeypatch, limit):
    monkeypatch.setattr(session, "SMALL_BYTES", limit)
    points = make_points(grid(200, 2, seed=1), slices=6)
    sample = ts.sample_points(points, 9).orderBy("draw").collect()
    assert [r["point_id"] for r in sample] == sorted(range(200), key=lambda i: (order_key(i), i))[:9]
    assert len(ts.sample_points(points, 500).collect()) == 200
    sparse = points.withColumn("point_id", F.col("point_id") * 13 - 70)
    drawn = ts.sample_points(sparse, 400, with_replacement=True).orderBy("draw").collect()
    assert [r["draw"] for r in drawn] == list(range(1, 401))
    assert [(r["point_id"] + 70) // 13 for r in drawn] == [order_key(i) % 200 for i in range(400)]


def test_dense_positions(spark):
    ids = spark.range(0, 5000, 7, 9).select((F.col("id") * 3 - 999).alias("point_id"))
    found = ts.dense_positions(ids, "point_id").collect()
    assert sorted(map(tuple, found)) == list(enumerate(range(-999, 14001, 21)))[: ids.count()]


def test_diversity_chain(make_points):
    x = np.random.default_rng(3).normal(size=(90, 3))
    points = make_points(x)
    core = [i for p in range(3) for i, _ in brute_centers(x, range(p, 90, 3), 5)]
    expected = brute_matching(x, core, 5)
    found = ts.diversity_max(points, 5, 3).orderBy("rank").collect()
    assert [r["point_id"] for r in found] == expected
    report = ts.diversity_report(points, 5, 3).first()
    assert report["n"] == 90 and report["coreset_size"] == 15
    s = x[expected]
    d = np.sqrt(((s[:, None] - s[None]) ** 2).sum(-1)).sum() / 20
    assert report["avg_distance"] == pytest.approx(d)
