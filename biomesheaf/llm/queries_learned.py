"""Queries of the operators that learn from the documents."""

from pyspark.sql import functions as F

from . import langid, lm, toxicity
from .registry import query, table
from .shared import fold


@query("op7_language_id")
def op7_language_id(spark, folder):
    docs = table(spark, folder, "documents")
    model = langid.fit(langid.learnable(docs))
    return langid.identified(docs, model).select(
        "_row.doc_id",
        (fold("_row.doc_id", 4) == 2).alias("held_out"),
        F.col("_lang").alias("lang_pred"),
        F.col("_score").alias("score"),
        F.col("_rejected").alias("rejected"),
    )


@query("op4_toxicity")
def op4_toxicity(spark, folder):
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = toxicity.fit(docs, labels.where(fold("doc_id", 5) != 0))
    scored = docs.select("doc_id", "text").withColumn("score", toxicity.toxicity(model))
    return scored.select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    )


@query("op3_lm_scores")
def op3_lm_scores(spark, folder):
    docs = table(spark, folder, "documents")
    found = lm.scores(docs, fold("doc_id", 7) != 2)
    return found.select("doc_id", (fold("doc_id", 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
