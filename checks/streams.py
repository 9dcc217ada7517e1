"""Streaming jobs over files, run until the input is used up."""

from pyspark.sql import functions as F

from checks import views as V
from checks.quality import not_null, report_sql, unique, where
from checks.registry import query
from txnlens.operators import encoding, modelling as M
from txnlens.operators.quality import BETWEEN, IN_SET, NOT_NULL, UNIQUE, Rule
from txnlens.plans import preprocess
from txnlens.session import materialize, scratch_path
from txnlens.streaming import jobs, uniqueness, windows


def file_stream(spark, folder, schema, name="*.parquet"):
    return spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(folder)


def events_stream(spark, sf):
    return file_stream(spark, sf, V.table(spark, sf, "events").schema, "events.parquet")


@query("stream_score")
def _(spark, sf):
    rows, fitted = preprocess.fit(V.ref_txn(spark, sf), rare_share=0.04)
    ready = materialize(rows, "ready")  # counted and fitted
    model = M.fit_model(ready, preprocess.model_columns(fitted), "LogisticRegression", {"C": 1.0})
    folder, out = scratch_path(spark, "arrivals"), scratch_path(spark, "scored")
    V.late_txn(spark, sf).write.parquet(folder)
    late = file_stream(spark, folder, V.late_txn(spark, sf).schema)
    jobs.stream_score(late, fitted, model, out, scratch_path(spark, "progress")).awaitTermination()
    return spark.read.parquet(out).select("trans_num", "is_fraud", "y_pred")


def arrivals(spark, rows, conditions):
    """A folder with one file for the rows of each condition, in this order of arrival, and its stream by single files."""
    folder = scratch_path(spark, "arrivals")
    for c in conditions:
        rows.where(c).coalesce(1).write.mode("append").parquet(folder)
    return folder, spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(folder)


# A tenth of the first five days comes after all others.
LATE = "event_id % 10 = 0 and ts < timestamp'2024-01-06'"
IN_TURN = [f"not ({LATE}) and {c}" for c in (
    "ts < timestamp'2024-01-11'", "ts >= timestamp'2024-01-11' and ts < timestamp'2024-01-21'",
    "ts >= timestamp'2024-01-21' and event_id % 7 > 0", "ts >= timestamp'2024-01-21' and event_id % 7 = 0")] + [LATE]


def watched_windows(spark, sf):
    events = V.table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    reference = materialize(encoding.shares_of(encoding.category_counts(events, ["event_type"])), "shares")
    _folder, rows = arrivals(spark, events, IN_TURN)
    return windows.drift_windows_to_end(rows, reference, ["event_type"], scratch_path(spark, "windows"),
                                        scratch_path(spark, "progress"), time="ts")


@query("stream_drift_windows", """
    with closed as (select event_type as v, time_bucket(interval 1 day, ts) as w from events
                    where not (event_id % 10 = 0 and ts < timestamp '2024-01-06')),
    p as (select w, v, count(*) / sum(count(*)) over (partition by w) as p from closed group by 1, 2),
    q as (select event_type as v, count(*) / sum(count(*)) over () as q from events group by 1),
    every as (select distinct c.w, q.v, q.q from closed c cross join q),
    pq as (select e.w, coalesce(p.p, 0) as p, e.q from every e left join p on p.w = e.w and p.v = e.v),
    js as (select w, sqrt(greatest(0, sum((case when p > 0 then p * log2(2 * p / (p + q)) else 0 end
                + q * log2(2 * q / (p + q))) / 2))) as d from pq group by w)
    select strftime(js.w, '%Y-%m-%d') as day, 'event_type' as feature, round(d, 6) as distance, d > 0.25 as alert,
           count(*) as n from js join closed on closed.w = js.w group by all""")
def _(spark, sf):
    found, _balance = watched_windows(spark, sf)
    return V.rounded(found.select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "feature", "distance",
                                  "alert", "n"))


@query("stream_late_rows", """
    select 'event_type' as feature, count(event_type) as arrived,
           count(event_type) filter (not (event_id % 10 = 0 and ts < timestamp '2024-01-06')) as counted, 0::bigint as waiting,
           count(event_type) filter (event_id % 10 = 0 and ts < timestamp '2024-01-06') as late from events""")
def _(spark, sf):
    return watched_windows(spark, sf)[1]


KINDS = ("click", "view", "purchase")


@query("stream_expectations", report_sql([
    not_null(0, "user_id"), where(1, "expect_column_values_to_be_between", "value", "(value < 0 or value > 20)"),
    where(2, "expect_column_values_to_be_in_set", "event_type", "event_type not in ('click', 'view', 'purchase')")],
    "events"))
def _(spark, sf):
    rules = [Rule(NOT_NULL, "user_id"), Rule(BETWEEN, "value", 0, 20), Rule(IN_SET, "event_type", values=KINDS)]
    out = scratch_path(spark, "reports")
    jobs.stream_expectations(events_stream(spark, sf), rules, out, scratch_path(spark, "progress")).awaitTermination()
    report = spark.read.parquet(out)
    return V.rounded(report.select("rule", "expectation", "column_name", "success", "element_count",
                                   "unexpected_count", "unexpected_percent"), "unexpected_percent")


@query("stream_uniqueness", report_sql([unique(0, "event_id", "events"), unique(1, "user_id", "events"),
                                         unique(2, "value", "events")], "events"))
def _(spark, sf):
    rules = [Rule(UNIQUE, "event_id"), Rule(UNIQUE, "user_id"), Rule(UNIQUE, "value")]
    events = V.table(spark, sf, "events")
    out, progress = scratch_path(spark, "unique"), scratch_path(spark, "progress")
    folder, rows = arrivals(spark, events, ["event_id % 3 = 0", "event_id % 3 = 1"])
    uniqueness.stream_uniqueness(rows, rules, out, progress).awaitTermination()
    # the rest arrives after a restart
    events.where("event_id % 3 = 2").coalesce(1).write.mode("append").parquet(folder)
    uniqueness.stream_uniqueness(rows, rules, out, progress).awaitTermination()
    return V.rounded(uniqueness.latest_report(spark, out).select(
        "rule", "expectation", "column_name", "success", "element_count", "unexpected_count", "unexpected_percent"),
        "unexpected_percent")
