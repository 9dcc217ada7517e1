"""Model-ready rows to a champion: split, select, compare, tune, decide."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from txnlens.operators import modelling, selection
from txnlens.operators.splitting import train_test_xy
from txnlens.roles import TARGET


@dataclass
class TrainingResult:
    selected: DataFrame
    baselines: DataFrame
    final: modelling.Trial
    decision: DataFrame


def train(ready: DataFrame, champion_path: str, drifted=(), method: str = "weighted", n_trials: int = 30,
          models=modelling.MODELS, seed: int = 42, trees: int = 100) -> TrainingResult:
    """The selection's columns are the ones the model is trained on."""
    spark = ready.sparkSession
    train_rows, test_rows, columns = train_test_xy(ready)
    table = selection.select_features(train_rows, columns, drifted, method=method, trees=trees, seed=seed)
    chosen = {r["feature"] for r in table.where(F.col("selected")).select("feature").collect()}  # feature names
    columns = [c for c in columns if c in chosen]
    with modelling.cached_parts((train_rows, test_rows), (TARGET, *columns)):
        baselines = modelling.baseline_models(train_rows, test_rows, columns, models, seed=seed)
        # fitted on these rows and columns already, so a refit would give the same model
        final = modelling.tune_model(train_rows, test_rows, columns, baselines[0].name, n_trials, seed=seed, hold_best=True)[0]
    decision = modelling.champion_challenger(final.model, test_rows, champion_path)
    return TrainingResult(table, modelling.trial_table(spark, baselines), final, decision)
