import numpy as np
import pytest
from pyspark.sql import functions as F

from txnlens.operators import metrics, modelling as M, scoring, selection as S
from txnlens.operators.search import ParzenSearch
from txnlens.operators.splitting import train_test_xy
from txnlens.plans import training

NAMES = ["age", "balance", "calls", "delay", "echo"]


@pytest.fixture(scope="module")
def data(spark):
    """Uniform columns on a grid; echo repeats calls with the sign turned and a small wave; two columns decide."""
    i = np.arange(300)
    x = np.stack([(i * k % 359) / 359 for k in (7, 31, 89, 151, 1)], axis=1)
    x[:, 4] = 2 - x[:, 2] + 0.05 * np.sin(i)
    y = (2 * x[:, 0] - x[:, 2] > 0.5).astype(int)
    rows = [(f"k{n}", f"t{n}", int(t), *map(float, r)) for n, (r, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "trans_num string, datetime string, is_fraud int, " + ", ".join(f"{n} double" for n in NAMES))
    return x, y, df.repartition(2).cache()


def test_correlation(data, spark):
    x, _, df = data
    got = {(r["feature_a"], r["feature_b"]): r["abs_corr"] for r in S.correlation_matrix(df, NAMES).collect()}
    want = np.abs(np.corrcoef(x.T))
    assert len(got) == 25
    for i, a in enumerate(NAMES):
        for j, b in enumerate(NAMES):
            assert got[a, b] == pytest.approx(want[i, j], abs=1e-9)
    assert [(r["feature_a"], r["feature_b"]) for r in S.high_corr_pairs(S.correlation_matrix(df, NAMES)).collect()] == [("calls", "echo")]


def test_correlation_with_gaps_and_constants(spark):
    rows = [(1.0, 2.0, 5.0), (2.0, None, 5.0), (3.0, 1.0, 5.0), (4.0, 7.0, 5.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {(r["feature_a"], r["feature_b"]): r["abs_corr"] for r in S.correlation_matrix(df, ["a", "b", "c"]).collect()}
    want = abs(np.corrcoef([1, 3, 4], [2, 1, 7])[0, 1])
    assert got["a", "b"] == pytest.approx(want) and got["b", "a"] == pytest.approx(want)
    assert got["a", "a"] == 1 and got["b", "b"] == 1
    assert got["c", "c"] is None and got["a", "c"] is None and got["b", "c"] is None


def brute_f(x, y):
    groups = [x[y == c] for c in np.unique(y)]
    grand = x.mean()
    between = sum(len(g) * (g.mean() - grand) ** 2 for g in groups) / (len(groups) - 1)
    return between / (sum(((g - g.mean()) ** 2).sum() for g in groups) / (len(x) - len(groups)))


def test_anova_and_k_best(data):
    x, y, df = data
    got = {r["feature"]: r["f_score"] for r in S.anova_f(df, NAMES).collect()}
    for i, n in enumerate(NAMES):
        assert got[n] == pytest.approx(brute_f(x[:, i], y))
    best = [r["feature"] for r in S.select_k_best(S.anova_f(df, NAMES), 3).collect()]
    assert sorted(best) == ["age", "calls", "echo"]


def test_selection_rules(data):
    _, _, df = data
    importance = S.rf_importance(df, NAMES, trees=20)
    rows = importance.collect()
    assert [r["importance"] for r in rows] == sorted((r["importance"] for r in rows), reverse=True)
    assert rows[0]["feature"] == "age"
    left = S.rfe(df, NAMES, 2, trees=10)
    assert left.count() == 2
    best = S.select_k_best(S.anova_f(df, NAMES), 3)
    names = lambda method: {r["feature"] for r in S.combine_selections(importance, best, left, method, 3).where("selected").collect()}
    k, e = {r["feature"] for r in best.collect()}, {r["feature"] for r in left.collect()}
    assert names("union") == k | e and names("intersection") == k & e
    assert names("weighted") == k | e | {r["feature"] for r in rows[:3]}


def test_metrics_count_predicted_only_classes(spark):
    rows = [(0, 0), (0, 0), (0, 1), (1, 1), (1, 2)]
    row = metrics.classification_metrics(spark.createDataFrame(rows, "is_fraud int, y_pred int")).first()
    assert row["accuracy"] == pytest.approx(3 / 5)
    assert row["macro_precision"] == pytest.approx((1 + 1 / 2 + 0) / 3)
    assert row["macro_recall"] == pytest.approx((2 / 3 + 1 / 2 + 0) / 3)
    assert row["macro_f1"] == pytest.approx((4 / 5 + 1 / 2 + 0) / 3)


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 3 + [(1,)], "is_fraud int")
    assert {r["label"]: r["weight"] for r in M.class_weights(df).collect()} == {0: pytest.approx(4 / 6), 1: 2.0}
    assert M.with_class_weights(df).agg(F.sum(M.WEIGHT)).first()[0] == pytest.approx(4)


def test_draws_are_seeded_and_in_range():
    for space in M.SEARCH_SPACES.values():
        a, b = ParzenSearch(space, 3).ask(), ParzenSearch(space, 3).ask()
        assert a == b
        for name, (kind, low, high) in space.items():
            assert low <= a[name] <= high


def test_baselines_tuning_and_scoring(data):
    _, _, df = data
    trials = M.baseline_models(df, df, NAMES, ("LogisticRegression", "DecisionTreeClassifier"))
    assert trials[0].test["macro_f1"] >= trials[1].test["macro_f1"] > 0.9
    tuned = M.tune_model(df, df, NAMES, "DecisionTreeClassifier", 3)
    assert len(tuned) == 3 and tuned[0].train["macro_f1"] == tuned[0].test["macro_f1"]
    assert M.trial_table(df.sparkSession, tuned).count() == 3
    scored = scoring.score(df, trials[0].model)
    assert scored.columns == [*df.columns, "y_pred"] and scored.count() == 300
    assert scoring.score(df.limit(0), trials[0].model).count() == 0
    with pytest.raises(ValueError, match="calls"):
        scoring.score(df.drop("calls"), trials[0].model)


def test_boosted_model_takes_positive_weight(data):
    _, _, df = data
    model = M.fit_model(df, NAMES, "GradientBoostingClassifier", {"n_estimators": 3, "scale_pos_weight": 20.0})
    plain = M.fit_model(df, NAMES, "GradientBoostingClassifier", {"n_estimators": 3})
    ones = lambda m: scoring.score(df, m).where("y_pred = 1").count()
    assert ones(model) >= ones(plain)


def test_linear_attribution(data):
    x, _, df = data
    model = M.fit_model(df, NAMES, "LogisticRegression", {"C": 1.0})
    got = {r["feature"]: r["mean_abs"] for r in scoring.linear_attribution(df, model).collect()}
    w = model.stages[-1].coefficients.toArray()
    for i, n in enumerate(NAMES):
        assert got[n] == pytest.approx(np.abs(w[i] * (x[:, i] - x[:, i].mean())).mean())


def test_final_model_uses_selected_columns(data):
    _, _, df = data
    final = M.train_final(df, df, NAMES, "LogisticRegression", {}, ["calls", "age"])
    assert scoring.model_columns(final.model) == ["age", "calls"]
    every = M.train_final(df, df, NAMES, "LogisticRegression", {}, [])
    assert scoring.model_columns(every.model) == NAMES


def test_champion_is_replaced_only_by_a_better_model(data, tmp_path):
    _, _, df = data
    path = str(tmp_path / "champion")
    weak = M.fit_model(df, ["delay"], "LogisticRegression")
    strong = M.fit_model(df, NAMES, "LogisticRegression")
    assert M.champion_challenger(weak, df, path).first()["replace"]
    assert not M.champion_challenger(weak, df, path).first()["replace"]
    assert M.champion_challenger(strong, df, path).first()["replace"]
    assert scoring.model_columns(M.load_champion(path)) == NAMES
    assert not M.champion_challenger(weak, df, path).first()["replace"]


def test_training_plan(data, tmp_path):
    _, _, df = data
    result = training.train(df, str(tmp_path / "champion"), n_trials=2, trees=5, models=("LogisticRegression",))
    assert result.decision.first()["replace"] and result.final.test["macro_f1"] > 0.9
    chosen = {r["feature"] for r in result.selected.where("selected").collect()}
    assert set(scoring.model_columns(result.final.model)) == chosen


def test_trials_of_one_learner_are_fitted_once(data, monkeypatch):
    _, _, df = data
    fitted = []

    def fit(frame, columns, name, params, *rest):
        fitted.append((params["max_depth"], max(params["min_samples_leaf"], -(-params["min_samples_split"] // 2))))
        return fitted[-1]

    monkeypatch.setattr(M, "fit_model", fit)
    monkeypatch.setattr(M, "evaluate", lambda model, *rest: {"macro_f1": 1.0 / sum(model)})
    space = {"max_depth": ("int", 3, 4), "min_samples_split": ("int", 2, 4), "min_samples_leaf": ("int", 1, 2)}
    trials = M.tune_model(df, df, NAMES, "DecisionTreeClassifier", 12, space=space)
    assert len(trials) == 12 and len(fitted) - 1 == len(set(fitted)) <= 4  # and the best one again
    for t in trials:
        leaf = max(t.params["min_samples_leaf"], -(-t.params["min_samples_split"] // 2))
        assert t.test["macro_f1"] == 1.0 / (t.params["max_depth"] + leaf)


def test_training_plan_fits_and_caches_once(data, tmp_path, monkeypatch):
    _, _, df = data
    fitted, cached = [], []
    fit, persist = M.fit_model, type(df).persist

    def counted(frame, columns, name, params=None, *rest, **named):
        fitted.append((name, tuple(columns), str(params)))
        return fit(frame, columns, name, params, *rest, **named)

    def seen(frame, level):
        cached.append(frame.columns)
        return persist(frame, level)

    monkeypatch.setattr(M, "fit_model", counted)
    monkeypatch.setattr(type(df), "persist", seen)
    path = str(tmp_path / "champion")
    result = training.train(df, path, n_trials=3, trees=5, models=("LogisticRegression",))
    assert len(fitted) == len(set(fitted)) == 4  # a baseline and three trials, none of them twice
    columns = scoring.model_columns(result.final.model)
    # the selection's rows and vectors, then train and test rows for comparison and search together
    assert cached == [["is_fraud", *NAMES], ["is_fraud", "features"], *[["is_fraud", *columns]] * 2]
    monkeypatch.undo()
    train, test, _ = train_test_xy(df)
    again = M.tune_model(train, test, columns, "LogisticRegression", 3)[0]
    final = M.train_final(train, test, columns, again.name, again.params)
    for trial in (again, final):
        assert (trial.params, trial.test) == (result.final.params, result.final.test)
        assert trial.train == result.final.train
        assert trial.model.stages[-1].coefficients == result.final.model.stages[-1].coefficients
    assert [f.storageLevel.useMemory for f in (train.select("is_fraud", *columns), test.select("is_fraud", *columns))] == [False] * 2


def test_caller_keeps_its_cache(data):
    _, _, df = data
    with M.cached_parts((df,), NAMES) as (outer,):
        with M.cached_parts((df,), NAMES) as (inner,):
            assert inner.storageLevel.useMemory
        assert outer.storageLevel.useMemory
    assert not outer.storageLevel.useMemory


def test_the_registered_training_run_leaves_nothing_out(spark, monkeypatch):
    from inspect import signature

    from checks import models as registered
    from checks.registry import QUERIES

    asked = {}

    def train(*args, **named):
        bound = whole.bind(*args, **named)
        bound.apply_defaults()
        asked.update(bound.arguments)
        return training.TrainingResult(None, None, None, "decision")

    whole = signature(training.train)
    monkeypatch.setattr(registered, "ready", lambda *_: ("rows", None))
    monkeypatch.setattr(training, "train", train)
    assert QUERIES["training_run"](spark, "") == "decision"
    assert (asked["ready"], asked["n_trials"], asked["trees"], asked["models"]) == ("rows", 30, 100, M.MODELS)
    assert len(M.MODELS) == 6 and not asked["drifted"]
