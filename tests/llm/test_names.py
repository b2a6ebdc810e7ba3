"""Columns beside the texts keep their values, whatever their names."""

import pytest
from pyspark.sql import functions as F

from tallyspan.llm import decontaminate, line_dedup, minhash_dedup, quality

INNER = ["_text", "_DOC", "_version", "_Runs", "_runs_", "_row", "_KEY", "_items", "_Places", "quality", "toxic", "label", "fold", "ORDER"]
TEXTS = [
    (1, "one two three four five six\nseven eight nine ten eleven\nonly here"),
    (2, "one two three four five six\nseven eight nine ten eleven\nand there"),
    (3, "one two three four five six\nseven eight nine ten eleven\nonly here"),
    (4, None),
    (5, ""),
    (None, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"),
]


@pytest.fixture
def docs(spark):
    plain = spark.createDataFrame(TEXTS, "doc_id bigint, text string")
    place = F.coalesce("doc_id", F.lit(0)).cast("string")
    return plain.select("doc_id", "text", *(F.concat(F.lit(f"{name}:"), place).alias(name) for name in INNER))


def clean(docs, change):
    """What a change gives for the texts alone, and with the other columns, which it must not touch."""
    alone = change(docs.select("doc_id", "text")).collect()
    found = change(docs).collect()
    for row in found:
        assert all(row[name] == f"{name}:{row['doc_id'] or 0}" for name in INNER)
    names = list(alone[0].asDict())
    key = lambda values: tuple((v is None, str(v)) for v in values)
    return sorted((tuple(r[n] for n in names) for r in alone), key=key) == sorted(
        (tuple(r[n] for n in names) for r in found), key=key
    )


def test_line_dedup(docs):
    assert clean(docs, line_dedup.remove_repeated_lines)


def test_near_duplicates(docs):
    assert clean(docs, minhash_dedup.deduplicate)


@pytest.mark.parametrize("limit", [0, 1_000_000])
def test_contamination(spark, docs, limit):
    items = spark.createDataFrame([(7, "gamma delta epsilon zeta eta"), (8, "only here")], "item_id bigint, text string")
    assert clean(docs, lambda some: decontaminate.find_contamination(some, items, 4, limit))


def test_quality(spark, docs):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 6)], "doc_id bigint, quality int, toxic int")
    assert clean(docs, lambda some: quality.with_quality(some, labels))
