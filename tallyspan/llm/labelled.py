"""Labelled documents for the operators that learn: folds, unique labels, joins by checked size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.functions.keys import SEED
from tallyspan.session import broadcast_if_small


def fold(column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id is in no fold."""
    return F.crc32(F.col(column).cast("string")) % folds


def unique_labels(labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, y) with one 0 or 1 per id; rows with nulls or other values are left out, 0 wins a conflict."""
    known = labels.select("doc_id", F.col(label).cast("int").alias("y")).where("doc_id IS NOT NULL AND y IN (0, 1)")
    return known.groupBy("doc_id").agg(F.min("y").alias("y"))


def sample_rows(labels: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` labels, the first by a hash of their id: the same ones in every run."""
    return labels.orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id").limit(rows)


def with_labels(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """doc_id, text and y of the labelled documents; the ``rows`` labels are broadcast if they are few."""
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).join(
        broadcast_if_small(labels, rows, 32), "doc_id"
    )
