"""State that outlives micro-batches: uniqueness over a stream, late rows and the last windows."""

from pyspark.sql import functions as F

from txnlens.operators.quality import NOT_NULL, UNIQUE, Rule
from txnlens.streaming import jobs
from txnlens.streaming.uniqueness import latest_report, stream_uniqueness

SCHEMA = "t string, k string"


def arrive(spark, folder, *batches):
    """One file a batch, in order."""
    for i, rows in enumerate(batches):
        spark.createDataFrame(list(rows), SCHEMA).selectExpr("cast(t as timestamp) t", "k").coalesce(1) \
            .write.mode("append").parquet(str(folder))


def stream(spark, folder):
    return spark.readStream.schema("t timestamp, k string").option("maxFilesPerTrigger", 1).parquet(str(folder))


def counts(report):
    r = report.collect()
    return [(x["rule"], x["success"], x["element_count"], x["unexpected_count"]) for x in sorted(r, key=lambda x: x["rule"])]


def test_a_key_repeated_in_two_micro_batches_fails(spark, tmp_path):
    day = "2024-01-01 00:00:00"
    arrive(spark, tmp_path / "in", [(day, "a"), (day, "b"), (day, None)], [(day, "c"), (day, None)])
    rules = [Rule(UNIQUE, "k"), Rule(UNIQUE, "k", mostly=0.5)]
    run = lambda: stream_uniqueness(stream(spark, tmp_path / "in"), rules, str(tmp_path / "out"), str(tmp_path / "p"))
    run().awaitTermination()
    assert counts(latest_report(spark, str(tmp_path / "out"))) == [(0, True, 5, 0), (1, True, 5, 0)]
    # after a restart the keys of earlier micro-batches are still known
    arrive(spark, tmp_path / "in", [(day, "b"), (day, "d")], [(day, "b")])
    run().awaitTermination()
    assert counts(latest_report(spark, str(tmp_path / "out"))) == [(0, False, 8, 3), (1, True, 8, 3)]
    # a restart without new rows changes nothing
    run().awaitTermination()
    assert counts(latest_report(spark, str(tmp_path / "out"))) == [(0, False, 8, 3), (1, True, 8, 3)]
    found = spark.read.parquet(str(tmp_path / "out" / "changes")).where("kind = 'value' and rule = 0")
    assert [tuple(r) for r in found.groupBy("value").agg(F.max("n")).collect()] == [("b", 3)]


def test_same_as_the_suite_of_the_whole_table(spark, sf_dir, tmp_path):
    from txnlens.operators.quality import run_suite
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("user_id", F.expr("if(event_id % 9 = 0, null, user_id)"))
    rows.repartition(3).write.parquet(str(tmp_path / "in"))
    rules = [Rule(UNIQUE, "user_id"), Rule(UNIQUE, "event_id"), Rule(UNIQUE, "value")]
    source = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    stream_uniqueness(source, rules, str(tmp_path / "out"), str(tmp_path / "p")).awaitTermination()
    got = latest_report(spark, str(tmp_path / "out"))
    assert counts(got) == counts(run_suite(rows, rules))
    assert got.columns == run_suite(rows, rules).columns


def test_keys_are_forgotten_after_a_while(spark, tmp_path):
    arrive(spark, tmp_path / "in", [("2024-01-01 00:00:00", "a"), ("2024-01-01 00:00:00", None)],
           [("2024-01-02 00:00:00", "a"), ("2024-01-02 00:00:00", "b")],  # within three days of the first
           [("2024-01-10 00:00:00", "c")], [("2024-01-11 00:00:00", "a"), ("2024-01-11 00:00:00", "c")])
    run = lambda: stream_uniqueness(stream(spark, tmp_path / "in"), [Rule(UNIQUE, "k")], str(tmp_path / "out"),
                                    str(tmp_path / "p"), time="t", keep="3 days")
    run().awaitTermination()
    # a counts twice in the first days, c twice in the last; a's third row comes when it is forgotten
    assert counts(latest_report(spark, str(tmp_path / "out"))) == [(0, False, 7, 4)]
    arrive(spark, tmp_path / "in", [("2024-01-12 00:00:00", "a")])
    run().awaitTermination()
    assert counts(latest_report(spark, str(tmp_path / "out"))) == [(0, False, 8, 6)]


def test_suite_with_uniqueness_over_the_stream(spark, tmp_path):
    day = "2024-01-01 00:00:00"
    arrive(spark, tmp_path / "in", [(day, "a")], [(day, "a"), (day, None)])
    jobs.stream_expectations(stream(spark, tmp_path / "in"), [Rule(NOT_NULL, "k"), Rule(UNIQUE, "k")],
                             str(tmp_path / "out"), str(tmp_path / "p")).awaitTermination()
    each = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r["batch"], r["success"]) for r in each.collect()) == [(0, True), (1, False)]
    assert counts(latest_report(spark, str(tmp_path / "out-unique"))) == [(0, False, 3, 2)]


def test_late_rows_are_counted_and_the_last_windows_closed(spark, tmp_path):
    from txnlens.operators import encoding
    from txnlens.streaming.windows import drift_windows_to_end

    ref = encoding.shares_of(encoding.category_counts(spark.createDataFrame([("a",), ("b",)], "k string"), ["k"]))
    arrive(spark, tmp_path / "in", [("2024-01-01 01:00:00", "a"), ("2024-01-01 05:00:00", "b"), ("2024-01-01 06:00:00", None)],
           [("2024-01-01 23:00:00", "a"), ("2024-01-02 01:00:00", "b")], [("2024-01-05 00:00:00", "a")],
           [("2024-01-05 01:00:00", None)],  # lateness is judged by what micro-batches before the last one brought
           [("2024-01-01 02:00:00", "a"), ("2024-01-02 02:00:00", "a"), ("2024-01-04 02:00:00", "b"), (None, "b")])

    def run(finished):
        return drift_windows_to_end(stream(spark, tmp_path / "in"), ref, ["k"], str(tmp_path / "out"), str(tmp_path / "p"),
                                    time="t", finished=finished)

    windows, balance = run(False)
    assert sorted((str(r["window_start"])[:10], r["n"]) for r in windows.collect()) == [("2024-01-01", 3), ("2024-01-02", 1)]
    assert [tuple(r) for r in balance.collect()] == [("k", 8, 4, 2, 2)]
    windows, balance = run(True)  # a restart that finds nothing new and closes what is open
    got = {str(r["window_start"])[:10]: (r["n"], r["batch"] == -1) for r in windows.collect()}
    assert got == {"2024-01-01": (3, False), "2024-01-02": (1, False), "2024-01-04": (1, True), "2024-01-05": (1, True)}
    assert [tuple(r) for r in balance.collect()] == [("k", 8, 6, 0, 2)]
    # more rows after all: the early closing is replaced, nothing counts twice
    arrive(spark, tmp_path / "in", [("2024-01-05 03:00:00", "b"), ("2024-01-02 02:00:00", "a")])
    windows, balance = run(True)
    assert {str(r["window_start"])[:10]: r["n"] for r in windows.collect()} == {
        "2024-01-01": 3, "2024-01-02": 1, "2024-01-04": 1, "2024-01-05": 2}
    assert [tuple(r) for r in balance.collect()] == [("k", 10, 7, 0, 3)]
