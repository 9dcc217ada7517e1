"""Feature selection, models, scoring and evaluation."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from checks import views as V
from checks.encoding import preprocess_sql
from checks.registry import query
from txnlens.operators import attribution, metrics, modelling as M, profiling, scoring, selection
from txnlens.operators.features import add_log_features
from txnlens.operators.splitting import train_test_xy
from txnlens.plans import drift_watch, preprocess, training
from txnlens.roles import BASE_NUMERICAL
from txnlens.session import materialize, scratch_path

NUMERIC = [*BASE_NUMERICAL]
PAIRS = [(a, b) for a in NUMERIC for b in NUMERIC]
CORR = " union all ".join(
    f"select '{a}' as feature_a, '{b}' as feature_b, round(abs(corr({a}, {b})), 6) as abs_corr from txn" for a, b in PAIRS)


def ready(spark, sf):
    """Model-ready early rows as a stored table of as many files as there are cores, and the parameters."""
    rows, fitted = preprocess.fit(V.ref_txn(spark, sf), rare_share=0.04)
    return materialize(rows.repartition(spark.sparkContext.defaultParallelism), "ready"), fitted


def parts(spark, sf):
    rows, _fitted = ready(spark, sf)
    return train_test_xy(rows)


@query("correlation_matrix", V.sql(CORR, "txn"))
def _(spark, sf):
    return V.rounded(selection.correlation_matrix(V.txn(spark, sf), NUMERIC))


HIGH_CORR = " union all ".join(f"""
    select '{a}' as feature_a, '{b}' as feature_b, round(abs(corr({a}, {b})), 6) as abs_corr from logged"""
    for a in [*NUMERIC, "log_amt", "log_city_pop", "born"] for b in [*NUMERIC, "log_amt", "log_city_pop", "born"])


@query("high_corr_pairs", V.sql(f"""
    with logged as (select * exclude (age, datetime), age as age, ln(1 + amt) as log_amt,
                           ln(1 + city_pop) as log_city_pop, 2000 - age as born from ingested)
    select * from ({HIGH_CORR}) where abs_corr > 0.7 and feature_a < feature_b""", "ingested"))
def _(spark, sf):
    # age is missing where the date of birth does not parse, so its pairs are taken over fewer rows
    rows = add_log_features(V.ingested(spark, sf)).withColumn("born", 2000 - F.col("age"))
    matrix = selection.correlation_matrix(rows, [*NUMERIC, "log_amt", "log_city_pop", "born"])
    return V.rounded(selection.high_corr_pairs(matrix))


ANOVA = " union all ".join(f"""
    select '{c}' as feature, {i}::int as position,
           (sum(n * pow(m - g, 2)) / (count(*) - 1)) / (sum(n * v) / (sum(n) - count(*))) as f_score
    from (select is_fraud, count({c}) as n, avg({c}) as m, var_pop({c}) as v,
                 (select avg({c}) from txn) as g from txn group by is_fraud)""" for i, c in enumerate(NUMERIC))


@query("anova_f", V.sql(f"select feature, position, round(f_score, 6) as f_score from ({ANOVA})", "txn"))
def _(spark, sf):
    return V.rounded(selection.anova_f(V.txn(spark, sf), NUMERIC))


@query("select_k_best", V.sql(f"""
    select feature, position, round(f_score, 6) as f_score from ({ANOVA})
    order by f_score desc, position desc limit 4""", "txn"))
def _(spark, sf):
    return V.rounded(selection.select_k_best(selection.anova_f(V.txn(spark, sf), NUMERIC), 4))


@query("rf_importance")
def _(spark, sf):
    train, _test, columns = parts(spark, sf)
    return selection.rf_importance(train, columns)


@query("rfe")
def _(spark, sf):
    train, _test, columns = parts(spark, sf)
    return selection.rfe(train, columns, 10)


@query("select_features")
def _(spark, sf):
    train, _test, columns = parts(spark, sf)
    return selection.select_features(train, columns, ["amt"], method="weighted")


@query("baseline_models")
def _(spark, sf):
    train, test, columns = parts(spark, sf)
    return M.trial_table(spark, M.baseline_models(train, test, columns))


@query("tune_model")
def _(spark, sf):
    train, test, columns = parts(spark, sf)
    return M.trial_table(spark, M.tune_model(train, test, columns, "DecisionTreeClassifier"))


@query("class_weight_balanced", V.sql("""
    select is_fraud as label, count(*) as n,
           round((select count(*) from txn) / ((select count(distinct is_fraud) from txn) * count(*)::double), 6) as weight
    from txn group by is_fraud""", "txn"))
def _(spark, sf):
    return V.rounded(M.class_weights(V.txn(spark, sf)))


@query("train_final")
def _(spark, sf):
    train, test, columns = parts(spark, sf)
    best = [r["feature"] for r in selection.select_k_best(selection.anova_f(train, columns), 10).collect()]
    final = M.train_final(train, test, columns, "LogisticRegression", {"C": 1.0}, best)
    return M.trial_table(spark, [final], "test")


@query("champion_challenger", V.sql("""
    with champion as (select quality as y, case when n_chars % 5 < 4 then 1 else 0 end as p
                      from labels join documents using (doc_id)),
    challenger as (select quality as y, case when n_chars % 3 < 2 then 1 else 0 end as p
                   from labels join documents using (doc_id)),
    f1 as (select (select avg(f) from (
            select 2.0 * count(*) filter (y = c and p = c)
                   / nullif(count(*) filter (y = c) + count(*) filter (p = c), 0) as f
            from champion, (values (0), (1)) k(c) group by c)) as champion_f1,
        (select avg(f) from (
            select 2.0 * count(*) filter (y = c and p = c)
                   / nullif(count(*) filter (y = c) + count(*) filter (p = c), 0) as f
            from challenger, (values (0), (1)) k(c) group by c)) as challenger_f1)
    select round(champion_f1, 6) as champion_f1, round(challenger_f1, 6) as challenger_f1,
           challenger_f1 > champion_f1 as "replace" from f1""", "scored"))
def _(spark, sf):
    rows = V.table(spark, sf, "labels").join(V.table(spark, sf, "documents"), "doc_id")
    both = rows.select(
        F.col("quality").alias("y_true"),
        F.explode(F.array(
            F.struct(F.lit("champion").alias("model"), F.expr("if(n_chars % 5 < 4, 1, 0)").alias("y_pred")),
            F.struct(F.lit("challenger").alias("model"), F.expr("if(n_chars % 3 < 2, 1, 0)").alias("y_pred")))).alias("s"))
    scores = metrics.classification_metrics(both.select("y_true", "s.*"), "y_true", by=["model"])
    return V.rounded(M.decide_champion(scores))


@query("champion_store")
def _(spark, sf):
    train, test, columns = parts(spark, sf)
    path = scratch_path(spark, "champion")
    first = M.fit_model(train, columns, "LogisticRegression")
    second = M.fit_model(train, columns, "DecisionTreeClassifier")
    a = M.champion_challenger(first, test, path)
    b = M.champion_challenger(second, test, path)
    return a.withColumn("round", F.lit(1)).unionByName(b.withColumn("round", F.lit(2)))


@query("score")
def _(spark, sf):
    train, test, columns = parts(spark, sf)
    model = M.fit_model(train, columns, "LogisticRegression", {"C": 1.0})
    return scoring.score(test, model).select("trans_num", "is_fraud", "y_pred")


@query("describe_table", V.sql(" union all ".join(f"""
    select '{c}' as feature, count({c}) as n, round(avg({c}), 6) as mean, round(stddev_samp({c}), 6) as std,
           round(min({c})::double, 6) as min_value, round(quantile_cont({c}::double, 0.25), 6) as q1,
           round(quantile_cont({c}::double, 0.5), 6) as median, round(quantile_cont({c}::double, 0.75), 6) as q3,
           round(max({c})::double, 6) as max_value from txn""" for c in [*NUMERIC, "is_fraud"]), "txn"))
def _(spark, sf):
    return V.rounded(profiling.describe_table(V.txn(spark, sf)))


@query("classification_metrics", V.sql("""
    with c as (select unnest([0, 1]) as c),
    k as (select c, count(*) filter (y_true = c and y_pred = c) as hits, count(*) filter (y_true = c) as t,
                 count(*) filter (y_pred = c) as p from scored, c group by c)
    select round((select avg(case when y_true = y_pred then 1.0 else 0.0 end) from scored), 6) as accuracy,
           round(avg(case when p = 0 then 0 else hits / p::double end), 6) as macro_precision,
           round(avg(case when t = 0 then 0 else hits / t::double end), 6) as macro_recall,
           round(avg(case when p + t = 0 then 0 else 2 * hits / (p + t)::double end), 6) as macro_f1 from k""", "scored"))
def _(spark, sf):
    return V.rounded(metrics.classification_metrics(V.scored(spark, sf), "y_true"))


@query("linear_attribution")
def _(spark, sf):
    train, _test, columns = parts(spark, sf)
    model = M.fit_model(train, columns, "LogisticRegression", {"C": 1.0})
    return scoring.linear_attribution(train, model)


TREES = {"DecisionTreeClassifier": {"max_depth": 5}, "RandomForestClassifier": {"n_estimators": 10, "max_depth": 5},
         "GradientBoostingClassifier": {"n_estimators": 5, "max_depth": 3}}


@query("tree_attribution")
def _(spark, sf):
    train, _test, columns = parts(spark, sf)
    model = M.fit_model(train, columns, "RandomForestClassifier", {"n_estimators": 20, "max_depth": 5})
    return attribution.tree_attribution(train, model)


@query("tree_attribution_balance", V.sql(" union all ".join(
    f"select '{name}' as learner, count(*) as n_rows, 0::bigint as n_off from ref_txn" for name in TREES), "ref_txn"))
def _(spark, sf):
    """Each row's contributions and the base add up to its score."""
    rows, fitted = ready(spark, sf)
    columns = preprocess.model_columns(fitted)
    out = []
    for name, params in TREES.items():
        model = M.fit_model(rows, columns, name, params)
        column = "rawPrediction" if name == "GradientBoostingClassifier" else "probability"
        scored = model.transform(rows).select(vector_to_array(column)[1].alias("score"), *columns)
        told = attribution.explain_rows(scored, model, "score")  # the score travels with its row
        sums = F.col("base") + F.aggregate("contributions", F.lit(0.0), lambda a, x: a + x)
        both = told.select((F.abs(sums - F.col("score")) > 1e-9).alias("off"))
        out.append(both.agg(F.lit(name).alias("learner"), F.count("*").alias("n_rows"), F.count_if("off").alias("n_off")))
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("drift_on_slice")
def _(spark, sf):
    rows, fitted = ready(spark, sf)
    model = M.fit_model(rows, preprocess.model_columns(fitted), "LogisticRegression", {"C": 1.0})
    return drift_watch.drift_on_slice(V.late_txn(spark, sf), fitted, model, "NATION_3")


@query("training_run")
def _(spark, sf):
    rows, _fitted = ready(spark, sf)
    return training.train(rows, scratch_path(spark, "champion")).decision
