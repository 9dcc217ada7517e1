"""From raw documents to a weighted training set: rules, near duplicates, benchmark leaks, secrets, mixing.

Each stage takes what its predecessor kept. Rows that the rules reject, all but the first of a group of near copies,
and documents that hold a benchmark item go; secrets are replaced in the text; the last stage adds a rate of repetition.
All stages but the last return the columns of ``documents``. Defined cases are those of the operators; the secret
stage updates ``n_chars`` where it changed the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlens.llm import decontaminate, mixing, near_dup, quality_rules, secrets
from txnlens.session import materialize

#: Near duplicates of the pipeline: shingles of five words, similarity of 0.8 or more.
SHINGLE, PERCENT = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.keep_one_of_each(docs, size=SHINGLE, percent=PERCENT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(docs: DataFrame, **more: Column) -> DataFrame:
    """Whole rows in one column ``row``, so that columns of any name can't clash with ours."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[c.alias(n) for n, c in more.items()])


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secrets.redact(packed(docs, text=F.col("text")))
    same = F.col("row.text").eqNullSafe(F.col("text"))
    new = {"text": F.col("text"), "n_chars": F.when(same, F.col("row.n_chars")).otherwise(F.length("text").cast("bigint"))}
    return clean.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def mixing_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows with ``n_tokens``, ``domain``, ``rate`` and ``targets_met``; columns of these names are replaced.

    The domains are learned from all labelled documents, also those that earlier stages left out.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    every = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    own = F.xxhash64(F.col("text").cast("string"))
    told = docs.select(F.col("doc_id").alias("k"), own.alias("h"), "text")
    added = ["n_tokens", "domain", "rate", "targets_met"]
    rates = mixing.mix(told, labels, "k", "h", learn_from=every).select("k", "h", *added).dropDuplicates(["k", "h"])
    rows = packed(docs, own_k=F.col("doc_id"), own_h=own)
    both = rows.join(rates, F.col("own_k").eqNullSafe(F.col("k")) & (F.col("own_h") == F.col("h")), "left")
    return both.select(*[F.col("row")[c].alias(c) for c in docs.columns if c not in added], *added)


STAGES = [
    ("quality_rules", quality),
    ("minhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("secret_scans", secret_scan),
    ("mixing", mixing_weights),
]

#: The learned stages have no SQL form. Tests hold rules, near duplicates and the choice of leaks against brute-force
#: versions, stage by stage; redaction and mixing inside the pipeline, and ``run`` as a whole, are compared with nothing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored before the next stage reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(docs, name)
    return docs
