"""One-row reports on classes and words."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.functions.text import split_tokens
from tallyspan.operators.classes import count_per_part


def class_summary(keyed: DataFrame, class_col: str = "gamma") -> DataFrame:
    """Most frequent class, its count and the largest part's size, in one row.

    ``keyed`` has a ``part`` column. The table is read and shuffled once, for
    the count per (part, class); class totals and part sizes are both grouping
    sets of those counts. Of equally frequent classes the first in order wins.
    No objects give NULLs.
    """
    counts = count_per_part(keyed, class_col)
    totals = counts.groupingSets([[class_col], ["part"]], class_col, "part").agg(
        F.sum("n").alias("n"), F.grouping(class_col).alias("is_part")
    )
    of_class = F.when(F.col("is_part") == 0, F.struct((-F.col("n")).alias("rank"), class_col))
    return totals.agg(
        F.min(of_class).alias("top"),
        F.max(F.when(F.col("is_part") == 1, F.col("n"))).alias("max_partition_size"),
    ).select(
        F.col(f"top.{class_col}").alias("most_frequent_class"),
        (-F.col("top.rank")).alias("class_size"),
        "max_partition_size",
    )


def word_summary(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Documents, different words and their average length, in one row.

    The table is read and shuffled once: each document adds one NULL word, and
    those are counted like any other word.
    """
    words = F.coalesce(split_tokens(text_col), F.array().cast("array<string>"))
    marked = F.concat(words, F.array(F.lit(None).cast("string")))
    counts = docs.select(F.explode(marked).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.agg(
        F.coalesce(F.sum(F.when(F.col("word").isNull(), F.col("n"))), F.lit(0)).alias("documents"),
        F.count("word").alias("distinct_words"),
        F.sum(F.length("word")).alias("total_length"),
    )
    return totals.select(
        "documents",
        "distinct_words",
        F.expr("total_length div nullif(distinct_words, 0)").alias("avg_length"),
        F.expr("total_length / nullif(distinct_words, 0)").alias("avg_length_exact"),
    )
