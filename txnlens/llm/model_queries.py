"""Queries of the learned text models."""

from __future__ import annotations

from pyspark.sql import functions as F

from txnlens.llm import language_crf, quality_model
from txnlens.llm.folds import held_out
from txnlens.llm.registry import query, table

#: Fixed value: from this score on a text is predicted to have label 1.
LEAST_SCORE = 0.3


@query("op3_language_id")
def op3(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = language_crf.fit(docs)
    return language_crf.identify(docs, model, "doc_id").select("doc_id", held_out("doc_id").alias("held_out"),
                                                               "lang_pred", "score")


@query("op6_quality_classifier")
def op6(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = quality_model.fit(docs, table(spark, sf_dir, "labels"))
    return quality_model.score(docs, model, "doc_id").select(
        "doc_id", held_out("doc_id").alias("held_out"), "score",
        F.when(F.col("score") >= LEAST_SCORE, 1).otherwise(0).cast("int").alias("predicted"))
