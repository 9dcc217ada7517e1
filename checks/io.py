"""Sources, sinks, feature tables and feature groups."""

from pyspark.sql import functions as F

from checks import views as V
from checks.ingest import text_time
from checks.registry import query
from txnlens.operators import ingest as ops
from txnlens.plans import ingest as ingest_plan
from txnlens.session import materialize, scratch_path
from txnlens.sources.bucketed_features import REFUSE, BucketedFeatures
from txnlens.sources.feature_tables import FeatureTables
from txnlens.sources.tables import TableCatalog, write_report
from txnlens.sources.transactions import read_transactions_csv

DT = "strftime(datetime, '%Y-%m-%d %H:%M:%S') as datetime"
NUMERIC = "age, amt, lat, long, city_pop, merch_lat, merch_long"
TEXT = ("cc_num_hashed, merchant, category, first_hashed, last_hashed, gender, street, city, state, zip, job, "
        "merch_zipcode")


@query("read_transactions_csv", V.sql("select * from raw_txn", "raw_txn"))
def _(spark, sf):
    path = scratch_path(spark, "csv")
    V.raw_txn(spark, sf).write.option("header", True).csv(path)
    return read_transactions_csv(spark, path)


@query("read_write_table", V.sql(f"select {DT}, * exclude (datetime) from ingested", "ingested"))
def _(spark, sf):
    tables = TableCatalog(spark, scratch_path(spark, "stages"))
    return text_time(tables.write("ingested_data", V.ingested(spark, sf)))


@query("write_report", V.sql("""
    select state, count(*) as n, round(avg(amt), 6) as mean_amt from txn group by state""", "txn"))
def _(spark, sf):
    path = scratch_path(spark, "report")
    report = V.txn(spark, sf).groupBy("state").agg(F.count(F.lit(1)).alias("n"), V.r6(F.avg("amt")).alias("mean_amt"))
    write_report(report, path)
    return spark.read.schema("state string, n bigint, mean_amt double").option("header", True).csv(path)


@query("feature_table_write", V.sql("""
    select 'numerical' as name, count(*) as n from ingested union all
    select 'categorical', count(*) from ingested union all select 'target', count(*) from ingested""", "ingested"))
def _(spark, sf):
    store = FeatureTables(spark, scratch_path(spark, "features"))
    groups = ingest_plan.checked_groups(materialize(V.ingested(spark, sf), "ingested"))
    config = {name: {"name": f"{name}_features", "version": 1} for name in groups}
    store.write_all(groups, config)
    parts = [store.read(c["name"]).agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n"))
             for name, c in config.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("feature_table_read", V.sql("""
    select trans_num, strftime(datetime + case when is_fraud = 1 then interval 1 day else interval 0 day end,
                               '%Y-%m-%d %H:%M:%S') as datetime,
           age, case when is_fraud = 1 then round(amt * 2, 6) else round(amt, 6) end as amt, lat, long, city_pop,
           merch_lat, merch_long
    from ingested""", "ingested"))
def _(spark, sf):
    # a second batch brings newer rows for all fraudulent transactions
    store = FeatureTables(spark, scratch_path(spark, "features"))
    full = materialize(V.ingested(spark, sf), "ingested")
    numeric = ops.split_feature_groups(full)["numerical"]
    newer = ops.split_feature_groups(full.where("is_fraud = 1").withColumns({
        "datetime": F.expr("datetime + interval 1 day"), "amt": F.col("amt") * 2}))["numerical"]
    store.write(numeric, "numerical_features")
    store.write(newer, "numerical_features")
    return V.rounded(text_time(store.read("numerical_features")), "amt")


@query("feature_table_stats", V.sql("""
    select c as column_name, count(*) as n_rows, count(*) - count(v) as n_null, round(min(v), 6) as min_value,
           round(max(v), 6) as max_value, round(avg(v), 6) as mean, round(quantile_cont(v, 0.5), 6) as median
    from (select unnest(['age', 'amt', 'lat', 'long', 'city_pop', 'merch_lat', 'merch_long']) as c,
                 unnest([age::double, amt, lat, long, city_pop::double, merch_lat, merch_long]) as v from ingested)
    group by c""", "ingested"))
def _(spark, sf):
    store = FeatureTables(spark, scratch_path(spark, "features"))
    store.write(ops.split_feature_groups(materialize(V.ingested(spark, sf), "ingested"))["numerical"], "numerical_features")
    profile = store.statistics("numerical_features")["profile"]
    kept = profile.where("column_name <> 'trans_num'").select(
        "column_name", "n_rows", "n_null", "min_value", "max_value", "mean", "median")
    return V.rounded(kept)


@query("split_feature_groups", V.sql(f"""
    select trans_num, {DT}, {NUMERIC} from ingested""", "ingested"))
def _(spark, sf):
    return text_time(ops.split_feature_groups(V.ingested(spark, sf))["numerical"]).select(
        "trans_num", "datetime", *NUMERIC.split(", "))


@query("merge_feature_groups", V.sql(f"""
    select trans_num, {DT}, {NUMERIC}, {TEXT}, is_fraud from ingested""", "ingested"))
def _(spark, sf):
    groups = ops.split_feature_groups(V.ingested(spark, sf))
    return text_time(ops.merge_feature_groups([groups["numerical"], groups["categorical"], groups["target"]]))


@query("merge_feature_groups_keyed", V.sql(f"""
    select trans_num, {DT}, {NUMERIC}, {TEXT} from ingested""", "ingested"))
def _(spark, sf):
    store = FeatureTables(spark, scratch_path(spark, "features"))
    groups = ops.split_feature_groups(materialize(V.ingested(spark, sf), "ingested"))
    config = {"upload_features": False,
              "numerical": {"name": "preprocessed_numerical_features", "version": 1},
              "categorical": {"name": "preprocessed_categorical_features", "version": 1}}
    store.write_all({k: g for k, g in groups.items() if k != "target"}, config)
    return text_time(ops.merge_configured_groups(config, store.read))


@query("profile_appended", """
    with top as (select o_orderpriority as v, count(*) as n from orders group by 1 order by n desc, v limit 1)
    select 'o_totalprice' as column_name, count(*) as n_rows, count(*) - count(o_totalprice) as n_null,
           round(min(o_totalprice)::double, 6) as min_value, round(max(o_totalprice)::double, 6) as max_value,
           round(avg(o_totalprice), 6) as mean, round(stddev_samp(o_totalprice), 6) as std, null::varchar as top_value,
           null::bigint as top_count from orders
    union all
    select 'o_orderpriority', count(*), count(*) - count(o_orderpriority), null, null, null, null, (select v from top),
           (select n from top) from orders""")
def _(spark, sf):
    """A profile merged from the states of three appended batches."""
    orders = V.table(spark, sf, "orders").select("o_orderkey", "o_orderdate", F.col("o_totalprice").cast("double")
                                                 .alias("o_totalprice"), "o_orderpriority")
    store = FeatureTables(spark, scratch_path(spark, "features"), key="o_orderkey", event_time="o_orderdate")
    for i in range(3):
        store.write(orders.where(F.col("o_orderkey") % 3 == i), "orders")
    found = store.profile("orders", verified=True).where("column_name in ('o_totalprice', 'o_orderpriority')")
    text = F.col("column_name") == "o_orderpriority"
    return V.rounded(found.select("column_name", "n_rows", "n_null", "min_value", "max_value", "mean", "std",
                                  F.when(text, F.col("top_value")).alias("top_value"),
                                  F.when(text, F.col("top_count")).alias("top_count")))


@query("merge_feature_groups_bucketed", V.sql(f"""
    select trans_num, strftime(datetime + case when is_fraud = 1 then interval 1 day else interval 0 day end,
                               '%Y-%m-%d %H:%M:%S') as datetime,
           age, case when is_fraud = 1 then round(amt * 2, 6) else round(amt, 6) end as amt, lat, long, city_pop,
           merch_lat, merch_long, {TEXT}, is_fraud from ingested""", "ingested"))
def _(spark, sf):
    """Groups in tables bucketed by key: a second batch replaces rows, another one brings new keys only."""
    store = BucketedFeatures(spark, scratch_path(spark, "bucketed"), buckets=16)
    full = materialize(V.ingested(spark, sf), "ingested")
    groups = ops.split_feature_groups(full)
    newer = ops.split_feature_groups(full.where("is_fraud = 1").withColumns({
        "datetime": F.expr("datetime + interval 1 day"), "amt": F.col("amt") * 2}))["numerical"]
    store.write(groups["numerical"], "numerical_features")
    store.write(newer, "numerical_features")
    even = F.col("trans_num").cast("bigint") % 2 == 0
    store.write(groups["categorical"].where(even), "categorical_features", repeats=REFUSE)
    store.write(groups["categorical"].where(~even), "categorical_features", repeats=REFUSE)
    store.write(groups["target"], "target_features")
    merged = store.merge(["numerical_features", "categorical_features", "target_features"])
    return V.rounded(text_time(merged), "amt")
