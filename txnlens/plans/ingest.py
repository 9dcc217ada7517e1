"""Raw transactions to the ingested table, its feature groups and its reference/analysis parts."""

from __future__ import annotations

from pyspark.sql import DataFrame

from txnlens import roles as R
from txnlens.operators import ingest as ops
from txnlens.operators.quality import Rule, expect_columns, ingested_suite, run_suite
from txnlens.operators.splitting import stratified_split
from txnlens.session import materialize


def ingest(raw: DataFrame) -> DataFrame:
    """Deduplicate, parse, hash and derive the age: 23 raw columns to 22 ingested ones."""
    return (
        raw.transform(ops.drop_exact_duplicates)
        .transform(ops.parse_timestamp)
        .transform(ops.ids_to_string)
        .transform(ops.hash_pii)
        .transform(ops.derive_age)
        .transform(ops.drop_redundant_columns)
    )


def checked_groups(ingested: DataFrame, target: str = R.TARGET) -> dict[str, DataFrame]:
    """The three feature groups, each with exactly its expected columns."""
    groups = ops.split_feature_groups(ingested, target)
    expected = {"numerical": R.NUMERICAL_GROUP, "categorical": R.CATEGORICAL_GROUP,
                "target": (R.KEY, R.EVENT_TIME, target)}
    return {name: expect_columns(df, expected[name]) for name, df in groups.items()}


def ingest_and_validate(raw: DataFrame, rules: list[Rule] | None = None):
    """(reference part, analysis part, report on the analysis part); the ingested table is stored once."""
    ingested = materialize(ingest(raw), "ingested")
    checked_groups(ingested)
    reference, analysis = stratified_split(ingested)
    return reference, analysis, run_suite(analysis, rules or ingested_suite())
