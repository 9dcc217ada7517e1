"""Queries of decontamination and mixing, and the pipeline."""

from __future__ import annotations

import corpus_pipeline
from txnlens.llm import decontaminate, mixing
from txnlens.llm.registry import ORACLES, query, table


@query("op4_benchmark_decontamination")
def op4(spark, sf_dir):
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op9_mixing")
def op9(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id")


@query("pipeline")
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)


if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
