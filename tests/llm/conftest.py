import random

import pytest

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def make_docs(spark):
    """(doc_id, text) rows as a table over several partitions, with columns whose names operators use inside."""

    def make(rows, slices=3):
        schema = "doc_id bigint, text string, row string, score string, n_words string, cls string, ranges string"
        data = [(i, t, "r", "s", "n", "c", "g") for i, t in rows]
        return spark.createDataFrame(spark.sparkContext.parallelize(data, slices), schema)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and blank texts, one very long text, ties and repeated rows."""
    rng = random.Random(5)
    long = " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "ñandú"]) for _ in range(60_000))
    return [
        (1, None),
        (2, ""),
        (3, " \t\n "),
        (4, long),
        (5, "one two three"),
        (5, "one two three"),
        (6, "one two three"),
        (None, "one two three"),
        (None, None),
        (7, "Ünïcödé Words, and MORE of Them!"),
        (-8, "x" * 5000),
    ]
