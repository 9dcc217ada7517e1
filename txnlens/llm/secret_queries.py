"""Query of the secret scan."""

from __future__ import annotations

from pyspark.sql import functions as F

from txnlens.llm import secrets
from txnlens.llm.registry import query, table


@query("op2_secret_scans")
def op2(spark, sf_dir):
    found = secrets.secret_report(table(spark, sf_dir, "documents"), "doc_id")
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(secrets.named(F.col("base")), 256)
                        .alias("base_sha256"), secrets.named(F.col("spans")).alias("spans"), "n_markov")
