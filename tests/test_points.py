import math

import pytest
from pyspark.sql import functions as F

import tallyspan as ts

RECT = [(0, 0), (3, 4), (6, 8), (0, 8), (6, 0)]


def one(df):
    (row,) = df.collect()
    assert len(row) == 1
    return row[0]


def centers(df):
    return [r["point_id"] for r in df.orderBy("part", "rank").collect()]


def solution(df):
    return [r["point_id"] for r in df.orderBy("rank").collect()]


def test_exact_mpd(make_points):
    points = make_points(RECT)
    assert one(ts.exact_mpd(points)) == 10.0
    assert [tuple(r) for r in ts.farthest_pairs(points, 3).collect()] == [
        (0, 2, 100.0), (3, 4, 100.0), (0, 3, 64.0),
    ]


def test_sampled_mpd_bound_is_tight(make_points):
    from tallyspan.operators.diameter import max_distance_to

    points = make_points(RECT)
    sample = points.filter("point_id = 1").withColumn("draw", F.lit(1))
    assert one(max_distance_to(points, sample, 1)) == 5.0


def test_farthest_first(make_points):
    points = make_points(RECT)
    found = ts.k_center(points, 4, first_ids=[0])
    assert centers(found) == [0, 2, 3, 4]
    assert [r["distance"] for r in found.orderBy("rank").collect()] == [None, 10.0, 6.0, 6.0]
    assert centers(ts.k_center(points, 3, first_ids=[1])) == [1, 0, 2]
    assert one(ts.k_center_mpd(points, 4, first_ids=[0])) == 10.0


def test_coreset(make_points):
    points = make_points(RECT)
    found = ts.coreset(points, 2, 2, first_ids=[0, 1])
    assert [(r["part"], r["point_id"]) for r in found.orderBy("part", "rank").collect()] == [
        (0, 0), (0, 2), (1, 1), (1, 3),
    ]


def test_greedy_matching(make_points):
    points = make_points(RECT)
    assert solution(ts.greedy_matching(points, 4)) == [0, 2, 3, 4]
    assert solution(ts.greedy_matching(points, 3)) == [0, 2, 1]
    assert solution(ts.greedy_matching(points, 1)) == [0]
    assert solution(ts.greedy_matching(points, 5)) == [0, 1, 2, 3, 4]
    assert solution(ts.greedy_matching(points, 9)) == [0, 1, 2, 3, 4]


@pytest.mark.parametrize(
    "ids, expected", [((0, 2, 3, 4), 8.0), ((0, 1, 2), 20 / 3), ((1,), None)]
)
def test_average_distance(make_points, ids, expected):
    subset = make_points(RECT).filter(F.col("point_id").isin(list(ids)))
    found = one(ts.avg_pairwise_distance(subset))
    assert found is None if expected is None else math.isclose(found, expected)


def test_duplicates(make_points):
    points = make_points([(1, 1)] * 4)
    assert one(ts.exact_mpd(points)) == 0.0
    found = ts.k_center(points, 3, first_ids=[0])
    assert centers(found) == [0, 1, 2]
    assert [r["distance"] for r in found.orderBy("rank").collect()] == [None, 0.0, 0.0]
    assert solution(ts.greedy_matching(points, 2)) == [0, 1]
    assert solution(ts.greedy_matching(points, 3)) == [0, 1, 2]


def test_nan_points_are_left_out(make_points):
    points = make_points([(0, 0), (3, 4), (math.nan, 0)])
    assert one(ts.exact_mpd(points)) == 5.0
    everything = ts.k_center(points.withColumn("part", F.lit(0)), 3, num_parts=1)
    assert sorted(centers(everything)) == [0, 1]
    with pytest.raises(ValueError, match="smaller than the number"):
        ts.k_center(points, 2)
    assert sorted(solution(ts.greedy_matching(points, 3))) == [0, 1]


@pytest.mark.parametrize(
    "rows, message",
    [
        ([(0, 0), (1, 2, 3)], "does not have 2 coordinates"),
        ([(0, 0), (math.inf, 3)], "infinite"),
        ([(0, 0), (-math.inf, 3)], "infinite"),
    ],
)
def test_unusable_points(make_points, rows, message):
    for run in (ts.exact_mpd, lambda p: ts.k_center(p, 1), lambda p: ts.greedy_matching(p, 1)):
        with pytest.raises(Exception, match=message):
            run(make_points(rows)).collect()


def test_no_points(make_points):
    points = make_points([])
    assert one(ts.exact_mpd(points)) == 0.0
    with pytest.raises(ValueError):
        ts.k_center(points, 3)
    assert solution(ts.greedy_matching(points, 3)) == []
    assert one(ts.avg_pairwise_distance(points)) is None


def test_argument_checks(make_points):
    points = make_points(RECT)
    for k in (0, 5, 6):
        with pytest.raises(ValueError):
            ts.two_approx_mpd(points, k)
        with pytest.raises(ValueError):
            ts.k_center_mpd(points, k)
    with pytest.raises(ValueError):
        ts.k_center(points, 0)
    with pytest.raises(ValueError):
        ts.greedy_matching(points, 0)
    with pytest.raises(ValueError):
        ts.coreset(points, 2, 2, partitioning="other")


def test_small_parts_give_all_points(make_points):
    points = make_points(RECT)
    found = ts.coreset(points, 4, 3)
    parts = {}
    for r in found.collect():
        parts.setdefault(r["part"], set()).add(r["point_id"])
    assert parts == {0: {0, 3}, 1: {1, 4}, 2: {2}}
    assert len(ts.coreset(points, 2, 50).collect()) == 5


def test_point_file(spark, tmp_path, make_points):
    """Positions follow the file, and a file in several splits keeps its order."""
    path = tmp_path / "points.txt"
    path.write_text("".join(f"{i},{i * 0.5},-1e3\n" for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8000")
    try:
        points = ts.decode_points(spark, str(path))
        assert points.rdd.getNumPartitions() > 1
        found = sorted(map(tuple, points.collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found == [(i, [float(i), i * 0.5, -1000.0]) for i in range(5000)]


def test_point_folder_roundtrip(spark, tmp_path, make_points):
    points = make_points([(0.1, 1 / 3), (2e-300, 1e300), (5, 6)], slices=1)
    path = str(tmp_path / "points")
    ts.write_lines(points.orderBy("point_id"), ts.encode_points("features"), path)
    assert sorted(map(tuple, ts.decode_points(spark, path).collect())) == sorted(
        map(tuple, points.collect())
    )


def test_point_lines(spark):
    def decode(values, **options):
        schema = "position bigint, value string"
        return ts.decode_points(spark.createDataFrame(list(enumerate(values)), schema), **options)

    assert [tuple(r) for r in decode(["1, 2.5,,", "-1e2,NaN"]).select("features").collect()][0] == (
        [1.0, 2.5],
    )
    for bad in ("", "1,,2", "a,1", ",1"):
        with pytest.raises(Exception, match="not a point line"):
            decode([bad]).collect()
    kept = decode(["1,x", "", "3,4"], mode="DROPMALFORMED").collect()
    assert [tuple(r) for r in kept] == [(2, [3.0, 4.0])]


def test_point_distances(make_points):
    points = make_points(RECT)
    for place in ((0,), (0, 0, 0)):
        with pytest.raises(Exception, match="different dimensions"):
            ts.point_distances(points, place).collect()
    origin = F.array(F.lit(0.0), F.lit(0.0))
    as_columns = points.select(
        "point_id",
        ts.squared_distance("features", origin).alias("d2"),
        ts.distance("features", origin).alias("d"),
    )
    for df in (ts.point_distances(points, (0, 0)), as_columns):
        assert [(r["d2"], r["d"]) for r in df.orderBy("point_id").collect()] == [
            (0.0, 0.0), (25.0, 5.0), (100.0, 10.0), (64.0, 8.0), (36.0, 6.0),
        ]


def test_checkpoint_folder_comes_from_the_session(spark):
    from tallyspan.session import checkpoint_folder, scratch_path

    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = checkpoint_folder(spark)
    assert spark.sparkContext.getCheckpointDir()
    assert named is None or folder == named
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
