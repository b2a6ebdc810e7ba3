"""Samples found by counting leading bits are those of a sort."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import tallyspan as ts
from tallyspan import session
from tallyspan.operators import sampling


def number(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


IDS = {
    "dense": list(range(700)),
    "sparse": [int(x) for x in np.unique(np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 600))],
    "uneven": [*range(500), -(2**63), 2**63 - 1, *range(10**12, 10**12 + 90)],
}


@pytest.fixture(params=list(IDS))
def named(spark, request):
    ids = sorted(IDS[request.param])
    schema = "point_id bigint, features array<double>"
    rows = [(i, [float(p)]) for p, i in enumerate(ids)]
    return ids, ts.points_from_table(spark.createDataFrame(spark.sparkContext.parallelize(rows[::-1], 5), schema))


@pytest.mark.parametrize("limit", [1024, 64 << 20])
def test_draws_with_replacement_sort_nothing(named, monkeypatch, limit):
    ids, points = named
    monkeypatch.setattr(session, "SMALL_BYTES", limit)
    monkeypatch.setattr(sampling, "dense_positions", None)
    k = 8
    found = ts.sample_points(points, k, seed=9, with_replacement=True).orderBy("draw").collect()
    assert [(r["draw"], r["point_id"]) for r in found] == [(d + 1, ids[number(f"9:{d}") % len(ids)]) for d in range(k)]


@pytest.mark.parametrize("k", [1, 37, 400, 5000])
def test_large_samples_order_only_what_is_drawn(named, monkeypatch, k):
    ids, points = named
    monkeypatch.setattr(session, "SMALL_BYTES", 1)
    monkeypatch.setattr(sampling, "_ORDERED_ROWS", 0 if k == 37 else 3)
    plain, ordered = sampling.dense_positions, []
    monkeypatch.setattr(sampling, "dense_positions", lambda df, *a: ordered.append(df.count()) or plain(df, *a))
    found = ts.sample_points(points, k, seed=9).orderBy("draw").collect()
    expected = sorted(ids, key=lambda i: (number(f"9:{i}"), i))[:k]
    assert [r["point_id"] for r in found] == expected and [r["draw"] for r in found] == list(range(1, len(expected) + 1))
    assert ordered == [len(expected)]


def test_equal_keys_go_by_id(spark):
    keyed = spark.range(100).select(F.col("id").alias("point_id"), (F.col("id") % 3).alias("key"))
    found = sampling.first_keys(keyed, 50).collect()
    expected = sorted((i % 3, i) for i in range(100))[:50]
    assert sorted((r["key"], r["point_id"]) for r in found) == expected


def test_many_positions(spark):
    ids = spark.range(0, 3_000_000, 7).select((F.col("id") * 1_000_003).alias("point_id"))
    wanted = np.unique(np.random.default_rng(2).integers(0, 3_000_000 // 7, 20_000))
    assert np.array_equal(sampling.ids_at(ids, wanted), wanted * 7 * 1_000_003)
