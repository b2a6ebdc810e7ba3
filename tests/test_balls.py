"""The hierarchy of balls: the largest distance, and how many pairs of blocks are compared for it."""

import numpy as np
import pyarrow as pa
import pytest

import tallyspan as ts
from tallyspan.operators import balls, diameter


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(diameter, "DIRECT", 10)
    monkeypatch.setattr(balls, "LEAST_ROWS", 20)
    monkeypatch.setattr(balls, "block_count", lambda n, *_: -(-n // 80))
    monkeypatch.setattr(balls, "ROUND_PAIRS", 1)


def largest(x):
    return max(np.sqrt(np.square(x - row).sum(axis=1)).max() for row in x)


def cloud(kind, n, width, seed=1):
    rng = np.random.default_rng(seed)
    if kind == "sphere":
        x = rng.normal(size=(n, width))
        return x / np.linalg.norm(x, axis=1, keepdims=True)
    if kind == "clusters":
        return rng.normal(size=(9, width))[rng.integers(0, 9, n) ** 2 // 9] + rng.normal(size=(n, width)) * 0.03
    if kind == "grid":
        return rng.integers(0, 3, (n, width)).astype(float)
    return np.ones((n, width)) if kind == "equal" else np.exp(rng.normal(size=(n, width)) * 3)


@pytest.mark.parametrize("width", [1, 2, 7])
@pytest.mark.parametrize("kind", ["sphere", "clusters", "grid", "equal", "skewed"])
def test_largest_distance(make_points, small_blocks, kind, width):
    x = cloud(kind, 400, width)
    assert ts.exact_mpd(make_points(x)).first()[0] == largest(x)


def test_far_coordinates_and_two_places(make_points, small_blocks):
    assert ts.exact_mpd(make_points([(0.0, 0.0)] * 60 + [(3.0, 4.0)])).first()[0] == 5.0
    assert ts.exact_mpd(make_points([(1e200, 0.0)] * 30 + [(-1e200, 0.0)] * 30)).first()[0] == float("inf")


def counted(spark, x):
    table = pa.table({"point_id": np.arange(len(x)), "features": list(x)})
    points = ts.points_from_table(spark.createDataFrame(table).repartition(16), dimension=x.shape[1])
    outer, length = diameter.outer_points(points, len(x))
    n = outer.count()
    return n, *balls.farthest_distance(ts.points_from_table(outer, dimension=x.shape[1]), n, length)


def test_pairs_of_blocks_compared_on_unequal_clusters(spark):
    rng = np.random.default_rng(2)
    sizes = [120_000, 40_000, 20_000, 12_000, 6_000, 1_500, 400, 100]
    middle = rng.normal(size=(8, 6))
    middle /= np.linalg.norm(middle, axis=1, keepdims=True)
    x = np.concatenate([m + rng.normal(size=(n, 6)) * 0.05 for m, n in zip(middle, sizes, strict=True)])
    n, found, opened, total = counted(spark, x)
    assert opened < 0.2 * max(total, 30)
    d = np.linalg.norm(x[:, None] - middle, axis=2)
    far = np.unique(np.concatenate([np.argsort(-d[:, k])[:2_000] for k in range(8)]))
    assert found >= largest(x[far]) - 1e-12


def test_pairs_of_blocks_compared_on_a_shell_with_noise(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200_000, 3))
    x *= (1 + rng.normal(size=(len(x), 1)) * 0.001) / np.linalg.norm(x, axis=1, keepdims=True)
    n, found, opened, total = counted(spark, x)
    assert total > 100 and opened < 0.5 * total
    out = x[np.linalg.norm(x, axis=1) > 1.002]
    assert found >= largest(out) - 1e-12


@pytest.mark.parametrize("kind", ["sphere", "equal"])
def test_what_is_sent_grows_with_the_points(make_points, small_blocks, monkeypatch, kind):
    sent, plain = [], balls.Balls.grouped

    def grouped(self, pairs, count, *given):
        ends = pairs.selectExpr("explode(array_distinct(array(low, high))) AS block")
        sent.append(ends.join(self.placed, "block").count())
        assert sum(sent) <= 6 * len(x)
        return plain(self, pairs, count, *given)

    monkeypatch.setattr(balls.Balls, "grouped", grouped)
    x = cloud(kind, 400, 12)
    assert ts.exact_mpd(make_points(x)).first()[0] == largest(x)


def test_rounds_send_at_most_their_share_of_uneven_blocks(spark, small_blocks, monkeypatch):
    sent, listed = [], []
    plain, write = balls.Balls.grouped, balls.checkpointed

    def grouped(self, pairs, count, *given):
        ends = pairs.selectExpr("explode(array_distinct(array(low, high))) AS block")
        sent.append(ends.join(self.placed, "block").count())
        return plain(self, pairs, count, *given)

    def checkpointed(df):
        df = write(df)
        if "upper" in df.columns:
            listed.append(df.count())
        return df

    monkeypatch.setattr(balls.Balls, "grouped", grouped)
    monkeypatch.setattr(balls, "checkpointed", checkpointed)
    x = np.concatenate([np.repeat(1.5 * cloud("sphere", 10, 12), 16, 0), cloud("sphere", 150, 12, 2)])
    x[:160] += np.random.default_rng(3).normal(size=(160, 12)) * 0.6 / np.sqrt(12)
    table = pa.table({"point_id": np.arange(len(x)), "features": list(x)})
    points = ts.points_from_table(spark.createDataFrame(table).repartition(3), dimension=12)
    found, opened, total = balls.farthest_distance(points, len(x), 0.99 * largest(x))
    assert found == largest(x)
    assert len(sent) > 1 and sum(sent) <= balls.SENT * len(x)
    blocks = int(np.sqrt(2 * total))
    assert opened > max(listed) and max(listed) <= balls.SENT * blocks // 2 + 1
