"""Drift scores."""

from pyspark.sql import functions as F

from checks import views as V
from checks.registry import query
from txnlens.operators import drift as D
from txnlens.operators.encoding import apply_standard, fit_standard
from txnlens.operators.gappy_pca import components, fit_covariance, pattern_moments, project_expected
from txnlens.operators.wide_tests import wide_two_sample
from txnlens.roles import DRIFT_CATEGORICAL, DRIFT_NUMERICAL

LONG = ", ".join(f"'{c}'" for c in DRIFT_NUMERICAL), ", ".join(f"{c}::double" for c in DRIFT_NUMERICAL)
SAMPLES = f"""
    r as (select unnest([{LONG[0]}]) as feature, unnest([{LONG[1]}]) as x from ref_txn),
    a as (select unnest([{LONG[0]}]) as feature, unnest([{LONG[1]}]) as x from ana_txn),
    sizes as (select feature, count(*) as n from r group by feature),
    sizes_a as (select feature, count(*) as n from a group by feature)"""

QUANTILE_EDGES = """
    sorted as (select feature, list(x order by x) as s, count(*) as n from r group by feature),
    grid as (select b, unnest(range(0, b + 1)) as i from (select unnest(range({low}, {high} + 1)) as b)),
    edges as (select feature, b, i, s[lo + 1] + (s[least(lo + 1, n - 1) + 1] - s[lo + 1]) * part as edge from (
        select feature, s, n, b, i, (i * (n - 1)) // b as lo, ((i * (n - 1)) % b) / b::double as part
        from sorted, grid))"""
WIDTH_EDGES = """
    grid as (select b, unnest(range(0, b + 1)) as i from (select unnest(range({low}, {high} + 1)) as b)),
    edges as (select feature, b, i, case when i = b then hi else lo + (hi - lo) * (i / b::double) end as edge
              from (select feature, min(x) as lo, max(x) as hi from r group by feature), grid)"""
SCORES = """
    points as (select distinct feature, edge from edges),
    below_r as (select p.feature, p.edge, count(*) filter (x < edge) as lt, count(*) filter (x <= edge) as le
                from points p join r on p.feature = r.feature group by 1, 2),
    below_a as (select p.feature, p.edge, count(*) filter (x < edge) as lt, count(*) filter (x <= edge) as le
                from points p join a on p.feature = a.feature group by 1, 2),
    bins as (
        select e.feature, e.b, e.i,
               ((case when e.i + 1 = e.b then r2.le else r2.lt end) - r1.lt) / sr.n::double as er,
               ((case when e.i + 1 = e.b then a2.le else a2.lt end) - a1.lt) / sa.n::double as ea
        from edges e join edges f on e.feature = f.feature and e.b = f.b and f.i = e.i + 1
        join below_r r1 on r1.feature = e.feature and r1.edge = e.edge
        join below_r r2 on r2.feature = f.feature and r2.edge = f.edge
        join below_a a1 on a1.feature = e.feature and a1.edge = e.edge
        join below_a a2 on a2.feature = f.feature and a2.edge = f.edge
        join sizes sr on sr.feature = e.feature join sizes_a sa on sa.feature = e.feature),
    scores as (select feature, b, sum((greatest(er, 1e-4::double) - greatest(ea, 1e-4::double))
                   * ln(greatest(er, 1e-4::double) / greatest(ea, 1e-4::double))) as psi
               from bins group by feature, b)"""


def psi_sql(low: int, high: int, select: str, edges: str = QUANTILE_EDGES, more: str = "") -> str:
    return V.sql(f"with {SAMPLES}, {edges.format(low=low, high=high)}, {SCORES} {more} {select}", "ref_txn", "ana_txn")


@query("psi", psi_sql(50, 50, "select feature, round(psi, 6) as psi_score from scores"))
def _(spark, sf):
    return V.rounded(D.psi(V.ref_txn(spark, sf), V.ana_txn(spark, sf)))


@query("psi_equal_width", psi_sql(50, 50, "select feature, round(psi, 6) as psi_score from scores", WIDTH_EDGES))
def _(spark, sf):
    return V.rounded(D.psi(V.ref_txn(spark, sf), V.ana_txn(spark, sf), edges="width"))


@query("psi_bin_sweep", psi_sql(5, 50, "select feature, b as bins, round(psi, 6) as psi from scores"))
def _(spark, sf):
    return V.rounded(D.psi_sweep(V.ref_txn(spark, sf), V.ana_txn(spark, sf)))


KNEE = """,
    unit as (select feature, b, (b - min(b) over w) / (max(b) over w - min(b) over w)::double as x,
                    (psi - min(psi) over w) / nullif(max(psi) over w - min(psi) over w, 0) as y,
                    row_number() over (partition by feature order by b) as k, count(*) over w as n
             from scores window w as (partition by feature)),
    curve as (select u.feature, u.k, u.n, m.b as mirror, m.y - u.x as d
              from unit u join unit m on u.feature = m.feature and m.k = u.n + 1 - u.k),
    neighbours as (select *, coalesce(lag(d) over w, d) as p, coalesce(lead(d) over w, d) as q, lead(d) over w as nxt
                   from curve window w as (partition by feature order by k)),
    marks as (select feature, k, nxt, case when d >= p and d >= q then mirror end as peak,
                     case when d <= p and d <= q then 0.0::double
                          when d >= p and d >= q then d - 1.0::double / (n - 1) end as t from neighbours),
    walk as (select feature, k, nxt, last_value(peak ignore nulls) over w as peak, last_value(t ignore nulls) over w as t
             from marks window w as (partition by feature order by k rows unbounded preceding)),
    knees as (select feature, arg_min(peak, k) as knee from walk where peak is not null and nxt < t group by feature),
    tops as (select feature, b as top from (
        select feature, b, row_number() over (partition by feature order by psi desc, b) as k from scores) where k = 1),
    chosen as (select t.feature, coalesce(k.knee, t.top) as bins from tops t left join knees k on t.feature = k.feature)"""


@query("psi_knee_bins", psi_sql(5, 50, "select feature, bins from chosen", more=KNEE))
def _(spark, sf):
    return D.knee_bins(D.psi_sweep(V.ref_txn(spark, sf), V.ana_txn(spark, sf)))


@query("psi_report", psi_sql(
    5, 50, """select s.feature, c.bins, round(s.psi, 6) as psi_score
              from scores s join chosen c on s.feature = c.feature and s.b = c.bins""", more=KNEE))
def _(spark, sf):
    return V.rounded(D.psi_report(V.ref_txn(spark, sf), V.ana_txn(spark, sf)))


@query("drift_decision", psi_sql(50, 50, """
    select feature, round(psi, 6) as psi_score, psi > 0.1 as drifted, max(psi) over () > 0.1 as trigger_retraining
    from scores"""))
def _(spark, sf):
    return V.rounded(D.drift_decision(D.psi(V.ref_txn(spark, sf), V.ana_txn(spark, sf))))


CHUNK_COLUMNS = (", ".join(f"'{c}'" for c in DRIFT_CATEGORICAL), ", ".join(DRIFT_CATEGORICAL))


@query("js_categorical_chunks", V.sql(f"""
    with numbered as (select *, row_number() over (order by datetime, trans_num) - 1 as k from ana_txn),
    ends as (select k // 1000 as c, min(k) as lo, max(k) as hi from numbered group by 1),
    al as (select k // 1000 as c, unnest([{CHUNK_COLUMNS[0]}]) as feature, unnest([{CHUNK_COLUMNS[1]}]) as v from numbered),
    rl as (select unnest([{CHUNK_COLUMNS[0]}]) as feature, unnest([{CHUNK_COLUMNS[1]}]) as v from ref_txn),
    q as (select feature, v, count(*) / sum(count(*)) over (partition by feature) as q from rl group by 1, 2),
    p as (select c, feature, v, count(*) / sum(count(*)) over (partition by c, feature) as p from al group by 1, 2, 3),
    every as (select c, feature, v from p union
              select c, q.feature, q.v from (select distinct c from al) cross join q),
    pq as (select e.c, e.feature, coalesce(p.p, 0) as p, coalesce(q.q, 0) as q from every e
           left join p on p.c = e.c and p.feature = e.feature and p.v = e.v
           left join q on q.feature = e.feature and q.v = e.v),
    js as (select c, feature, sqrt(greatest(0, sum((case when p > 0 then p * log2(2 * p / (p + q)) else 0 end
                + case when q > 0 then q * log2(2 * q / (p + q)) else 0 end) / 2))) as d from pq group by 1, 2)
    select feature, js.c as chunk_index, lo as start_index, hi as end_index, 'jensen_shannon' as method,
           round(d, 6) as distance, 0.25::double as upper_threshold, d > 0.25 as alert
    from js join ends on js.c = ends.c""", "ref_txn", "ana_txn"))
def _(spark, sf):
    return V.rounded(D.js_categorical_chunks(V.ref_txn(spark, sf), V.ana_txn(spark, sf)))


CUMULATIVE = f"""{SAMPLES},
    both_ as (select feature, x, 1 as ir, 0 as ia from r union all select feature, x, 0, 1 from a),
    cum as (select feature, x, sum(sum(ir)) over w / sum(sum(ir)) over (partition by feature)::double as fr,
                   sum(sum(ia)) over w / sum(sum(ia)) over (partition by feature)::double as fa,
                   lead(x) over w as nx
            from both_ group by feature, x window w as (partition by feature order by x))"""
KS = """ks as (select feature, max(abs(fr - fa)) as d from cum group by feature),
    lam as (select k.feature, d, sqrt(s.n * t.n / (s.n + t.n)::double) * d as l from ks k
            join sizes s on s.feature = k.feature join sizes_a t on t.feature = k.feature),
    kp as (select feature, d, case when l < 0.2 then 1.0 else least(greatest(2 * (
               select sum((case when k % 2 = 1 then 1.0 else -1.0 end) * exp(-2.0 * k * k * l * l))
               from range(1, 101) t(k)), 0.0), 1.0) end as p from lam)"""
WASSERSTEIN = """ws as (
        select c.feature, sum(abs(fr - fa) * (nx - x)) / greatest(max(s.sd), 0.001) as d
        from cum c join (select feature, stddev_pop(x) as sd from r group by feature) s on s.feature = c.feature
        group by c.feature)"""


@query("ks_two_sample", V.sql(f"""
    with {CUMULATIVE}, {KS}
    select feature, round(d, 6) as ks_stat, round(p, 6) as p_value, p < 0.05 as drifted from kp""", "ref_txn", "ana_txn"))
def _(spark, sf):
    return V.rounded(D.ks_two_sample(D.sample_counts(V.ref_txn(spark, sf), V.ana_txn(spark, sf))))


@query("wasserstein_normed", V.sql(f"""
    with {CUMULATIVE}, {WASSERSTEIN}
    select feature, round(d, 6) as distance, d >= 0.05 as drifted from ws""", "ref_txn", "ana_txn"))
def _(spark, sf):
    return V.rounded(D.wasserstein_normed(D.sample_counts(V.ref_txn(spark, sf), V.ana_txn(spark, sf))))


@query("two_sample_wide", V.sql(f"""
    with {CUMULATIVE}, {KS}, {WASSERSTEIN}
    select kp.feature, round(kp.d, 6) as ks_stat, round(ws.d, 6) as distance
    from kp join ws on ws.feature = kp.feature""", "ref_txn", "ana_txn"))
def _(spark, sf):
    # few points, so that many ranges must be looked into
    found = wide_two_sample(V.ref_txn(spark, sf), V.ana_txn(spark, sf), DRIFT_NUMERICAL, points=20)
    spread = F.when(F.col("std") < 0.001, F.lit(0.001)).otherwise(F.col("std"))
    return V.rounded(found.select("feature", "ks_stat", (F.col("area") / spread).alias("distance")))


@query("dataset_drift_share", V.sql(f"""
    with {CUMULATIVE}, {KS}, {WASSERSTEIN},
    verdict as (select s.feature, case when s.n <= 1000 then kp.p < 0.05 else ws.d >= 0.05 end as drifted
                from sizes s join kp on kp.feature = s.feature join ws on ws.feature = s.feature)
    select count(*) as n_columns, count(*) filter (drifted) as n_drifted,
           round(count(*) filter (drifted) / count(*)::double, 6) as drift_share,
           count(*) filter (drifted) / count(*)::double >= 0.5 as dataset_drift from verdict""", "ref_txn", "ana_txn"))
def _(spark, sf):
    tests = D.drift_tests(D.sample_counts(V.ref_txn(spark, sf), V.ana_txn(spark, sf)))
    return V.rounded(D.dataset_drift_share(tests))


@query("pca_gaps", """
    select 'PC1' as component, count(*) filter (o_orderkey % 7 = 0 or o_custkey % 5 = 0) as n_gaps, count(*) as n_rows
    from orders""")
def _(spark, sf):
    """No row is left out: every one has a score, those with gaps an expected one."""
    rows = V.table(spark, sf, "orders").select(
        F.expr("if(o_orderkey % 7 = 0, null, double(o_totalprice))").alias("price"),
        F.expr("if(o_custkey % 5 = 0, null, o_totalprice * 2 + double(o_orderkey % 11))").alias("twice"),
        F.expr("double(o_orderkey % 13)").alias("other"))
    columns = rows.columns
    stats = {r["feature"]: (r["mean"], r["std"]) for r in fit_standard(rows, columns).collect()}
    scaled = apply_standard(rows, stats, columns)
    seen = pattern_moments(scaled, columns)
    mean, cov = fit_covariance(seen)
    scores = project_expected(scaled, columns, components(cov, 1), mean, cov, seen.present)
    return scores.where("PC1 is not null and not isnan(PC1)").agg(
        F.lit("PC1").alias("component"), F.lit(seen.gaps).cast("bigint").alias("n_gaps"), F.count("*").alias("n_rows"))


@query("pca_psi")
def _(spark, sf):
    return V.rounded(D.pca_psi(V.ref_txn(spark, sf), V.ana_txn(spark, sf)))
