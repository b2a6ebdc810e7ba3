"""A training corpus from raw documents, in five stages that each write a table for the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.llm.decontaminate import decontaminate
from tallyspan.llm.line_dedup import remove_repeated_lines
from tallyspan.llm.minhash_dedup import deduplicate
from tallyspan.llm.packing import pack
from tallyspan.llm.quality import THRESHOLD, with_quality
from tallyspan.session import discard, scratch_path

# No SQL expresses the classifier, the tokenizer, or the choices of the packing.
ORACLE_SQL = None

# Percent of common shingles from which two documents are near-duplicates.
SIMILARITY = 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return with_quality(docs, labels).where(F.col("score") >= THRESHOLD).select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of repeated line runs; those of which no words are left go."""
    left = remove_repeated_lines(docs).where("n_removed = 0 OR text RLIKE '[^\\\\x20\\\\x09-\\\\x0D]'")
    if "n_chars" in docs.columns:
        changed = F.length("text").cast(docs.schema["n_chars"].dataType)
        left = left.withColumn("n_chars", F.when(F.col("n_removed") > 0, changed).otherwise(F.col("n_chars")))
    return left.select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return deduplicate(docs, SIMILARITY).select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences."""
    return pack(docs)


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written to the shared folder and read again.

    A table goes once the next one is written.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            discard(spark, before)
        before = path
    return docs
