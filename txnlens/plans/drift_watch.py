"""The drift job: all numeric and categorical scores of an analysis sample and the retraining decision."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from txnlens.operators import drift
from txnlens.operators.distribution import split_by_distinct
from txnlens.operators.ingest import filter_by_value
from txnlens.operators.metrics import classification_metrics
from txnlens.operators.scoring import score
from txnlens.plans import preprocess
from txnlens.roles import DRIFT_CATEGORICAL, DRIFT_NUMERICAL
from txnlens.session import materialize


@dataclass
class DriftResult:
    psi: DataFrame
    decision: DataFrame
    pca: DataFrame
    chunks: DataFrame
    tests: DataFrame
    dataset: DataFrame


def watch(ref: DataFrame, ana: DataFrame, numerical=DRIFT_NUMERICAL, categorical=DRIFT_CATEGORICAL,
          chunk_size: int = 1000) -> DriftResult:
    """Every drift score; the value counts of both samples are taken once and shared, if no column has too many values."""
    both = ref.select(*numerical).unionByName(ana.select(*numerical))
    counts = None if split_by_distinct(both, numerical)[1] else drift.sample_counts(ref, ana, numerical)
    sweep = materialize(drift.psi_sweep(ref, ana, numerical, counts=counts), "sweep")
    scores = sweep.join(drift.knee_bins(sweep), ["feature", "bins"]).withColumnRenamed("psi", "psi_score")
    tests = materialize(drift.two_sample_tests(ref, ana, numerical) if counts is None else drift.drift_tests(counts), "tests")
    return DriftResult(scores, drift.drift_decision(scores), drift.pca_psi(ref, ana, numerical),
                       drift.js_categorical_chunks(ref, ana, categorical, chunk_size), tests,
                       drift.dataset_drift_share(tests))


def drift_on_slice(ana: DataFrame, fitted: preprocess.Fitted, model: PipelineModel, state: str = "NY") -> DataFrame:
    """Metrics of a model on the rows of one state."""
    rows = filter_by_value(ana, "state", state)
    return classification_metrics(score(preprocess.apply(rows, fitted), model))
