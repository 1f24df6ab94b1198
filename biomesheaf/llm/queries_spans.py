"""Queries of the operators that find passages and spans."""

from pyspark.sql import functions as F

from . import decontamination, embeddings, minhash, pii
from .registry import query, table


@query("op9_personal_data")
def op9_personal_data(spark, folder):
    found = pii.located(table(spark, folder, "documents"))
    number = lambda kind: F.size(F.filter("_base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "_row.doc_id",
        *[number(k) for k in pii.KINDS[:4]],
        F.sha2(pii.written(F.col("_base")).cast("binary"), 256).alias("base_sha256"),
        pii.written(F.col("_spans")).alias("spans"),
    )


@query("op1_benchmark_decontamination")
def op1_benchmark_decontamination(spark, folder):
    found = decontamination.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", F.round("score", 9).alias("score"), "seeds")


@query("op5_minhash_near_dedup")
def op5_minhash_near_dedup(spark, folder):
    found = minhash.near_duplicates(table(spark, folder, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


@query("op2_embedding_near_dedup")
def op2_embedding_near_dedup(spark, folder):
    found = embeddings.near_duplicates(table(spark, folder, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), "n_links", "component_id", "kept")
