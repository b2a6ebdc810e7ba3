"""The operators of this folder as queries of (spark, folder of tables)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.llm import chat, decontaminate, embedding_dedup, fill_in_middle, license_scan, line_dedup, merkle, minhash_dedup, packing, quality, suffix_dedup, suffix_tree, toxicity

SCHEMAS = {
    "documents": "doc_id BIGINT, text STRING",
    "benchmark": "item_id BIGINT, text STRING",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "conversations": "conv_id BIGINT, turn INT, role STRING, text STRING",
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the tables, with the columns that the operators use."""
    columns = [c.split()[0] for c in SCHEMAS[name].split(", ")]
    return spark.read.parquet(f"{folder}/{name}.parquet").select(columns)


def op1_suffix_array_dedup(spark, folder):
    left = suffix_dedup.remove_repeats(table(spark, folder, "documents"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op2_toxicity(spark, folder):
    scored = toxicity.score_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op3_quality_classifier(spark, folder):
    scored = quality.score_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return scored


def op4_chat_formatting(spark, folder):
    said = r"\### Assistant: </turn> ok"
    extra = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").cast("int").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    turns = table(spark, folder, "conversations").unionByName(extra)
    return chat.read_back(chat.expand_examples(turns))


def op5_line_dedup(spark, folder):
    left = line_dedup.remove_repeated_lines(table(spark, folder, "documents"))
    return left.select("doc_id", "n_lines", "n_removed", "n_runs", F.sha2("text", 256).alias("kept_sha256"))


def op6_packing(spark, folder):
    return packing.pack(table(spark, folder, "documents"))


def op7_license_scans(spark, folder):
    return license_scan.scan_licenses(table(spark, folder, "documents")).drop("spans")


def op8_benchmark_decontamination(spark, folder):
    found = decontaminate.find_contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_embedding_near_dedup(spark, folder):
    return embedding_dedup.near_duplicates(table(spark, folder, "embeddings"))


def op10_minhash_near_dedup(spark, folder):
    return minhash_dedup.near_duplicates(table(spark, folder, "documents")).drop("component", "row")


def op11_fill_in_middle(spark, folder):
    return fill_in_middle.fim_digests(fill_in_middle.fim_pieces(table(spark, folder, "documents")))


def op12_suffix_tree_scores(spark, folder):
    return suffix_tree.score_texts(table(spark, folder, "documents"))


def op13_merkle_manifest(spark, folder):
    return merkle.verified_manifest(spark.read.parquet(f"{folder}/documents.parquet"))


def queries() -> dict:
    """All queries by name."""
    every = (
        op1_suffix_array_dedup,
        op2_toxicity,
        op3_quality_classifier,
        op4_chat_formatting,
        op5_line_dedup,
        op6_packing,
        op7_license_scans,
        op8_benchmark_decontamination,
        op9_embedding_near_dedup,
        op10_minhash_near_dedup,
        op11_fill_in_middle,
        op12_suffix_tree_scores,
        op13_merkle_manifest,
    )
    return {query.__name__: query for query in every}
