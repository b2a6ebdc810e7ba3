"""Word counts of documents ``(doc_id, text)``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.functions.keys import salt
from tallyspan.functions.text import split_tokens


def tokens(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """One ``word`` row per token, with the columns of ``docs`` named in ``keep``."""
    return docs.select(*(keep or []), F.explode(split_tokens(text_col)).alias("word"))


def doc_token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, word, n)``: occurrences of each word in each document."""
    return (
        tokens(docs, text_col, [id_col]).groupBy(id_col, "word").agg(F.count(F.lit(1)).alias("n"))
    )


def word_count(
    docs: DataFrame,
    plan: str = "single",
    salts: int = 8,
    parts: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(word, n)``: occurrences of each word in all documents.

    ``single`` combines in the map tasks and shuffles once. ``salted`` first
    counts by (salt, word), the salt coming from the document id, which bounds
    what one task receives for a frequent word. ``physical`` first counts
    within Spark partitions, after dealing the documents out evenly over
    ``parts`` of them if that is given.
    """
    if plan == "single":
        return tokens(docs, text_col).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    if plan == "salted":
        words = tokens(docs.withColumn("part", salt(id_col, salts)), text_col, ["part"])
    elif plan == "physical":
        dealt = docs.repartition(parts) if parts else docs
        words = tokens(dealt.withColumn("part", F.spark_partition_id()), text_col, ["part"])
    else:
        raise ValueError(f"unknown plan {plan!r}")
    partial = words.groupBy("part", "word").agg(F.count(F.lit(1)).alias("n"))
    return partial.groupBy("word").agg(F.sum("n").alias("n"))


def distinct_words(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """One row ``distinct_words``: the number of different words."""
    return tokens(docs, text_col).agg(F.countDistinct("word").alias("distinct_words"))


def avg_word_length(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Average length of the different words: truncated, and exact beside it."""
    different = tokens(docs, text_col).distinct()
    return different.agg(
        F.count(F.lit(1)).alias("distinct_words"),
        F.sum(F.length("word")).alias("total_length"),
    ).select(
        F.expr("total_length div nullif(distinct_words, 0)").alias("avg_length"),
        F.expr("total_length / nullif(distinct_words, 0)").alias("avg_length_exact"),
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``(name, n)``: the row count of each table."""
    counts = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        counts = one if counts is None else counts.unionByName(one)
    return counts
