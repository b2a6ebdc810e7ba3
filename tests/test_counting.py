import pytest
from pyspark.sql import functions as F

import tallyspan as ts


def rows(df, *columns):
    df = df.select(*columns) if columns else df
    return sorted(tuple(r) for r in df.collect())


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


@pytest.fixture(scope="module")
def pairs_small(spark):
    return ts.decode_pairs(lines(spark, ["0 a", "1 b", "2 a", "3 c", "4 b", "5 a"]))


@pytest.fixture(scope="module")
def docs_small(spark):
    texts = ["a b a ", "", "   ", " x  y"]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


def test_round_one_and_sizes(pairs_small):
    keyed = ts.with_partition_key(pairs_small, 2)
    assert rows(ts.count_per_part(keyed)) == [
        (0, "a", 2), (0, "b", 1), (1, "a", 1), (1, "b", 1), (1, "c", 1),
    ]
    assert rows(ts.partition_sizes(keyed, 2)) == [(0, 3), (1, 3)]
    assert rows(ts.max_partition_size(keyed)) == [(3,)]
    assert rows(ts.class_summary(keyed)) == [("a", 3, 3)]


@pytest.mark.parametrize("plan", ["single", "two_round", "physical"])
def test_class_count_plans(pairs_small, plan):
    counted = ts.class_count(pairs_small, plan, parts=2)
    assert [tuple(r) for r in counted.collect()] == [("a", 3), ("b", 2), ("c", 1)]


def test_class_count_unknown_plan(pairs_small):
    with pytest.raises(ValueError):
        ts.class_count(pairs_small, "other")


def test_physical_partition_sizes(pairs_small):
    keyed = ts.with_physical_part(pairs_small, 3)
    sizes = rows(ts.partition_sizes(keyed, 3))
    assert [part for part, _ in sizes] == [0, 1, 2]
    assert sum(size for _, size in sizes) == 6
    assert rows(ts.class_summary(keyed))[0][:2] == ("a", 3)


def test_empty_part_has_size_zero(spark):
    objects = ts.decode_pairs(lines(spark, ["0 a", "2 a"]))
    keyed = ts.with_partition_key(objects, 2)
    assert rows(ts.partition_sizes(keyed, 2)) == [(0, 2), (1, 0)]


def test_most_frequent_tie_goes_to_first_class(spark):
    objects = ts.decode_pairs(lines(spark, ["0 b", "1 a"]))
    assert rows(ts.most_frequent(ts.class_count(objects))) == [("a", 1)]
    assert rows(ts.class_summary(ts.with_partition_key(objects, 2))) == [("a", 1, 1)]


def test_edge_pairs(spark):
    objects = ts.decode_pairs(lines(spark, ["-7 a", "4 maxPartitionSize extra"]))
    keyed = objects.select(
        "i",
        ts.partition_key("i", 3).alias("part"),
        ts.partition_key("i", 3, signed=True).alias("signed"),
        "gamma",
    )
    assert rows(keyed) == [(-7, 2, -1, "a"), (4, 1, 1, "maxPartitionSize")]
    assert rows(ts.class_count(objects)) == [("a", 1), ("maxPartitionSize", 1)]
    assert rows(ts.class_summary(keyed)) == [("a", 1, 1)]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_pairs(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        for bad in ("x a", "5", "5 ", "", " 5 a"):
            with pytest.raises(Exception, match="not a pair line"):
                ts.decode_pairs(lines(spark, [bad])).collect()
        kept = ts.decode_pairs(lines(spark, ["x a", "5", "7 b"]), mode="DROPMALFORMED")
        assert rows(kept) == [(7, "b")]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    with pytest.raises(ValueError):
        ts.decode_pairs(lines(spark, []), mode="PERMISSIVE")


def test_no_objects(spark):
    objects = ts.decode_pairs(lines(spark, []))
    keyed = ts.with_partition_key(objects, 2)
    assert rows(ts.class_count(objects)) == []
    assert rows(ts.class_summary(keyed)) == [(None, None, None)]


def test_group_values_chunks_hold_everything(spark):
    objects = spark.range(10_000).select(
        F.col("id").alias("i"), F.when(F.col("id") % 3 == 0, "hot").otherwise("rest").alias("gamma")
    )
    grouped = ts.group_values(objects, chunk_rows=64).collect()
    assert max(len(r["values"]) for r in grouped) <= 64
    for gamma in ("hot", "rest"):
        chunks = sorted((r["chunk"], r["values"]) for r in grouped if r["gamma"] == gamma)
        values = [v for _, chunk in chunks for v in chunk]
        assert values == [i for i in range(10_000) if (i % 3 == 0) == (gamma == "hot")]


def test_group_values_of_large_and_negative_numbers(spark):
    top = 2**63 - 1
    values = [top, top - 1, top - 64, -1, 0, 2**53 + 1, -(2**62)]
    objects = spark.createDataFrame([(v, "a") for v in values], "i bigint, gamma string")
    grouped = ts.group_values(objects, chunk_rows=64).collect()
    assert [(r["chunk"], r["values"]) for r in grouped] == [(0, sorted(values))]


@pytest.mark.parametrize("value", ["7L", "xxhash64(id)", "IF(id % 5 = 0, NULL, id % 3)"])
def test_group_values_cuts_by_rows(spark, value):
    """Equal, sparse and missing values give full chunks of one size."""
    objects = spark.range(0, 20_000, 1, 7).selectExpr(f"{value} AS i", "IF(id % 4 = 0, 'a', NULL) AS gamma")
    expected = {}
    for i, gamma in sorted((tuple(r) for r in objects.where("i IS NOT NULL").collect()), key=lambda r: r[0]):
        expected.setdefault(gamma, []).append(i)
    found = {}
    for r in sorted(ts.group_values(objects, chunk_rows=4096).collect(), key=lambda r: r["chunk"]):
        assert r["chunk"] == len(found.setdefault(r["gamma"], []))
        found[r["gamma"]].append(r["values"])
    for gamma, values in expected.items():
        assert found[gamma] == [values[k : k + 4096] for k in range(0, len(values), 4096)]


@pytest.mark.parametrize("separator", list("|.$\\*[ E"))
def test_any_character_separates(spark, separator):
    text = separator.join(["a", "b", "", "c", "", ""])
    found = spark.range(1).select(ts.split_tokens(F.lit(text), separator)).first()[0]
    assert found == ["a", "b", "", "c"]
    with pytest.raises(ValueError):
        ts.split_tokens("text", separator * 2)


def test_text_roundtrip(spark, tmp_path, pairs_small):
    path = str(tmp_path / "pairs")
    ts.write_lines(pairs_small, ts.encode_pairs("i", "gamma"), path)
    assert rows(ts.decode_pairs(ts.read_lines(spark, path))) == rows(pairs_small)


def test_tokens(docs_small):
    assert rows(ts.doc_token_counts(docs_small)) == [
        (0, "a", 2), (0, "b", 1), (1, "", 1), (3, "", 2), (3, "x", 1), (3, "y", 1),
    ]


def test_only_the_space_splits(spark):
    docs = spark.createDataFrame([(0, "a\tb\nc d")], "doc_id bigint, text string")
    assert rows(ts.word_count(docs)) == [("a\tb\nc", 1), ("d", 1)]


@pytest.mark.parametrize("plan", ["single", "salted", "physical"])
def test_word_count_plans(docs_small, plan):
    expected = [("", 3), ("a", 2), ("b", 1), ("x", 1), ("y", 1)]
    assert rows(ts.word_count(docs_small, plan, salts=3, parts=2)) == expected


def test_word_statistics(docs_small):
    assert rows(ts.distinct_words(docs_small)) == [(5,)]
    assert rows(ts.avg_word_length(docs_small)) == [(0, 0.8)]
    assert rows(ts.word_summary(docs_small)) == [(4, 5, 0, 0.8)]
    assert rows(ts.row_counts({"docs": docs_small})) == [("docs", 4)]


def test_word_statistics_without_words(docs_small):
    none = docs_small.filter("doc_id > 10")
    assert rows(ts.avg_word_length(none)) == [(None, None)]
    assert rows(ts.word_summary(none)) == [(0, 0, None, None)]


def test_word_count_hot_word(spark):
    """One word makes up a third of all tokens."""
    docs = spark.range(300).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit("hot w"), F.col("id").cast("string"), F.lit(" v")).alias("text"),
    )
    counts = dict(rows(ts.word_count(docs, "salted", salts=7)))
    assert counts["hot"] == counts["v"] == 300 and len(counts) == 302
    assert counts == dict(rows(ts.word_count(docs)))


def test_spreading_moves_small_tables_only(spark):
    few = ts.spread_over_cores(spark.range(100, numPartitions=1))
    assert few.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(100, numPartitions=50)
    assert ts.spread_over_cores(many) is many
