import pytest
from pyspark.sql import functions as F

from txnlens import session
from txnlens.operators import encoding, modelling as M
from txnlens.operators.quality import NOT_NULL, Rule
from txnlens.plans import preprocess as P
from txnlens.sources.feature_tables import FeatureTables
from txnlens.sources.tables import TableCatalog, TableSpec, write_report
from txnlens.streaming import jobs
from checks import io, views as V  # noqa: F401  (io fills the registry)
from checks.registry import QUERIES

SCHEMA = "trans_num string, datetime timestamp_ntz, amt double"


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), "trans_num string, day string, amt double").selectExpr(
        "trans_num", "cast(day as timestamp_ntz) datetime", "amt")


def test_latest_row_per_key(spark, tmp_path):
    store = FeatureTables(spark, str(tmp_path))
    assert store.write(batch(spark, ("a", "2024-01-01", 1.0), ("b", "2024-01-05", 2.0)), "numbers") == 2
    assert store.read("numbers").count() == 2
    store.write(batch(spark, ("a", "2024-01-02", 3.0), ("b", "2024-01-04", 9.0), ("c", "2024-01-01", 4.0)), "numbers")
    store.write(batch(spark, ("c", "2024-01-01", 5.0)), "numbers")
    assert {r["trans_num"]: r["amt"] for r in store.read("numbers").collect()} == {"a": 3.0, "b": 2.0, "c": 5.0}
    assert store.read("numbers").columns == ["trans_num", "datetime", "amt"]


def test_repeated_keys_are_refused(spark, tmp_path):
    store = FeatureTables(spark, str(tmp_path))
    with pytest.raises(ValueError, match="1 keys"):
        store.write(batch(spark, ("a", "2024-01-01", 1.0), ("a", "2024-01-02", 2.0)), "numbers")
    assert store.write_all({"x": batch(spark, ("a", "2024-01-01", 1.0))}, {}) == {}


def test_versions_are_separate_and_have_statistics(spark, tmp_path):
    store = FeatureTables(spark, str(tmp_path))
    store.write(batch(spark, ("a", "2024-01-01", 1.0)), "numbers", 1)
    store.write(batch(spark, ("a", "2024-01-01", 7.0), ("b", "2024-01-01", 9.0)), "numbers", 2)
    assert [r["amt"] for r in store.read("numbers", 1).collect()] == [1.0]
    stats = store.statistics("numbers", 2)
    assert stats["profile"].where("column_name = 'amt'").first()["mean"] == 8.0
    assert stats["histograms"].agg(F.sum("n")).first()[0] == 2


def test_catalog_and_reports(spark, tmp_path):
    tables = TableCatalog(spark, str(tmp_path), {"text": TableSpec("text", "csv", "a bigint, b string")})
    df = spark.createDataFrame([(1, "x")], "a bigint, b string")
    assert tables.write("text", df).collect() == df.collect()
    assert tables.write("ref_data", df).collect() == df.collect()
    with pytest.raises(KeyError):
        tables.read("nothing")
    write_report(df, str(tmp_path / "report"), "json")
    assert spark.read.json(str(tmp_path / "report")).first()["b"] == "x"


def test_scratch_folder_must_be_shared_on_a_cluster(spark, monkeypatch):
    class Conf:
        def get(self, *_):
            return None

    class Fake:
        conf = Conf()
        sparkContext = type("C", (), {"master": "spark://host:7077"})()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_dir(Fake())
    Conf.get = lambda self, *_: "/shared/folder/"
    assert session.scratch_dir(Fake()) == "/shared/folder"


def test_stream_scoring_equals_batch_scoring(spark, sf_dir, tmp_path):
    ready, fitted = P.fit(V.ref_txn(spark, sf_dir), rare_share=0.04)
    model = M.fit_model(ready, P.model_columns(fitted), "LogisticRegression", {"C": 1.0})
    late = V.late_txn(spark, sf_dir)
    late.repartition(3).write.parquet(str(tmp_path / "in"))
    rows = spark.readStream.schema(late.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    jobs.stream_score(rows, fitted, model, str(tmp_path / "out"), str(tmp_path / "progress")).awaitTermination()
    from txnlens.operators.scoring import score
    want = {(r["trans_num"], r["y_pred"]) for r in score(P.apply(late, fitted), model).collect()}
    assert {(r["trans_num"], r["y_pred"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()} == want


def test_windows_close_across_micro_batches(spark, tmp_path):
    ref = encoding.shares_of(encoding.category_counts(spark.createDataFrame([("a",), ("b",)], "kind string"), ["kind"]))
    for i, rows in enumerate([[("2024-01-01 01:00:00", "a"), ("2024-01-01 05:00:00", "b")],
                              [("2024-01-01 23:00:00", "a"), ("2024-01-02 01:00:00", "b")], [("2024-01-05 00:00:00", "a")]]):
        (spark.createDataFrame(rows, "t string, kind string").selectExpr("cast(t as timestamp) t", "kind").coalesce(1)
         .write.mode("append").parquet(str(tmp_path / "in" / f"part={i}")))
    rows = spark.readStream.schema("t timestamp, kind string, part int").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    jobs.stream_drift_windows(rows, ref, ["kind"], str(tmp_path / "out"), str(tmp_path / "progress"), time="t").awaitTermination()
    got = {str(r["window_start"])[:10]: r["distance"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert set(got) == {"2024-01-01", "2024-01-02"}
    assert got["2024-01-01"] < got["2024-01-02"]


def test_expectations_per_micro_batch(spark, tmp_path):
    for i in range(2):
        spark.createDataFrame([(i or None,)], "x int").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    rows = spark.readStream.schema("x int").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    jobs.stream_expectations(rows, [Rule(NOT_NULL, "x")], str(tmp_path / "out"), str(tmp_path / "progress")).awaitTermination()
    report = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r["batch"], r["element_count"]) for r in report.collect()) == [(0, 1), (1, 1)]
    assert report.where("not success").count() == 1


@pytest.mark.parametrize("name", ["feature_table_write", "feature_table_stats", "feature_table_read", "merge_feature_groups_keyed"])
def test_feature_groups_are_cut_from_a_stored_table(spark, tmp_path, monkeypatch, name):
    key = F.col("trans_num").cast("string")
    rows = spark.range(20).withColumnRenamed("id", "trans_num").select(
        key.alias("trans_num"), F.lit("2024-01-01 00:00:00").try_cast("timestamp_ntz").alias("datetime"),
        *[F.lit(30).cast("bigint").alias(c) for c in ("age", "city_pop")],
        *[F.rand(1).alias(c) for c in ("amt", "lat", "long", "merch_lat", "merch_long")],
        *[key.alias(c) for c in ("cc_num_hashed", "merchant", "category", "first_hashed", "last_hashed", "gender", "street", "city",
                                 "state", "zip", "job", "merch_zipcode")], (key.cast("int") % 2).alias("is_fraud"))
    rows.write.parquet(str(tmp_path / "source"))
    monkeypatch.setattr(V, "ingested", lambda spark, sf: spark.read.parquet(str(tmp_path / "source")))
    read, write = [], FeatureTables.write
    monkeypatch.setattr(FeatureTables, "write", lambda self, df, *a: read.extend(df.inputFiles()) or write(self, df, *a))
    assert QUERIES[name](spark, "").count() > 0
    assert read and not [f for f in read if str(tmp_path) in f]
