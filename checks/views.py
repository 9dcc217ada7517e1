"""The transaction tables that the queries read, derived from the test tables in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from txnlens.functions.dates import lenient_timestamp
from txnlens.plans import ingest as ingest_plan


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with customer and nation under the 23 raw transaction columns."""
    t = lambda name: table(spark, sf_dir, name)
    joined = (t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
              .join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")))
    return joined.selectExpr(
        "cast(o_orderdate as string) as trans_date_trans_time",
        "630000000000 + c_custkey as cc_num",
        "concat('merchant_', cast(o_orderkey % 97 as string)) as merchant",
        "c_mktsegment as category", "o_totalprice as amt",
        "concat('first_', cast(c_custkey % 211 as string)) as first",
        "concat('last_', cast(c_custkey % 307 as string)) as last",
        "case when o_orderkey % 2 = 0 then 'M' else 'F' end as gender",
        "concat(cast(c_custkey as string), ' Main St') as street",
        "concat('city_', cast(c_custkey % 40 as string)) as city",
        "n_name as state",
        "cast(case when c_custkey % 15 = 0 then 1000 + c_custkey else 10000 + c_custkey end as string) as zip",
        "cast(c_custkey % 24 + 25 as double) as lat", "cast(-(c_custkey % 57 + 67) as double) as long",
        "cast(10000 + c_custkey * 17 as bigint) as city_pop", "o_orderpriority as job",
        "case when c_custkey % 101 = 0 then 'not a date' else "
        "cast(date_add(date'1930-01-01', cast(c_custkey * 13 % 27000 as int)) as string) end as dob",
        "cast(o_orderkey as string) as trans_num", "cast(o_orderkey as bigint) as unix_time",
        "cast(o_orderkey % 24 + 25 as double) as merch_lat", "cast(-(o_orderkey % 57 + 67) as double) as merch_long",
        "cast(case when o_orderstatus = 'F' then 1 else 0 end as bigint) as is_fraud",
        "case when o_orderkey % 7 = 0 or c_custkey % 40 = 5 then null "
        "else cast(20000 + c_nationkey * 10 + o_orderkey % 3 as string) end as merch_zipcode")


def raw_txn_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_txn(spark, sf_dir)
    return raw.unionByName(raw)


def txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed transactions with an age column that reaches below 16."""
    return raw_txn(spark, sf_dir).select(
        "trans_num", lenient_timestamp("trans_date_trans_time").alias("datetime"),
        F.col("cc_num").cast("string").alias("cc_num"), "merchant", "category", "amt", "gender", "street", "city",
        "state", "zip", "lat", "long", "city_pop", "job",
        F.expr("10 + cast(trans_num as bigint) % 70").alias("age"), "merch_lat", "merch_long", "is_fraud",
        "merch_zipcode")


def early_txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return txn(spark, sf_dir).where("datetime < timestamp_ntz '1999-01-01'")


def late_txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return txn(spark, sf_dir).where("datetime >= timestamp_ntz '1999-01-01'")


ref_txn = early_txn


def ana_txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The late rows with larger amounts and a single city."""
    return late_txn(spark, sf_dir).select(
        "trans_num", "datetime", (F.col("amt") * 1.1).alias("amt"), "lat", "long", "city_pop", "merch_lat",
        "merch_long", "category", "gender", F.lit("city_1").alias("city"), "state", "zip", "age", "is_fraud")


def ingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest_plan.ingest(raw_txn(spark, sf_dir))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels, documents = table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents")
    return labels.join(documents, "doc_id").selectExpr(
        "doc_id", "quality as y_true", "case when n_chars % 5 < 4 then 1 else 0 end as y_pred")


def r6(col: Column | str) -> Column:
    return F.round(F.col(col) if isinstance(col, str) else col, 6)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Columns rounded to six decimals, all doubles if none are named."""
    names = columns or [f.name for f in df.schema.fields if f.dataType.simpleString() == "double"]
    return df.withColumns({c: r6(c) for c in names})


SQL_VIEWS = {
    "raw_txn": """
        select cast(o.o_orderdate as varchar) as trans_date_trans_time, 630000000000 + c.c_custkey as cc_num,
               concat('merchant_', cast(o.o_orderkey % 97 as varchar)) as merchant, c.c_mktsegment as category,
               o.o_totalprice as amt, concat('first_', cast(c.c_custkey % 211 as varchar)) as first,
               concat('last_', cast(c.c_custkey % 307 as varchar)) as last,
               case when o.o_orderkey % 2 = 0 then 'M' else 'F' end as gender,
               concat(cast(c.c_custkey as varchar), ' Main St') as street,
               concat('city_', cast(c.c_custkey % 40 as varchar)) as city, n.n_name as state,
               case when c.c_custkey % 15 = 0 then cast(1000 + c.c_custkey as varchar)
                    else cast(10000 + c.c_custkey as varchar) end as zip,
               cast(c.c_custkey % 24 + 25 as double) as lat, cast(-(c.c_custkey % 57 + 67) as double) as long,
               cast(10000 + c.c_custkey * 17 as bigint) as city_pop, o.o_orderpriority as job,
               case when c.c_custkey % 101 = 0 then 'not a date'
                    else cast(date '1930-01-01' + cast(c.c_custkey * 13 % 27000 as int) as varchar) end as dob,
               cast(o.o_orderkey as varchar) as trans_num, cast(o.o_orderkey as bigint) as unix_time,
               cast(o.o_orderkey % 24 + 25 as double) as merch_lat,
               cast(-(o.o_orderkey % 57 + 67) as double) as merch_long,
               cast(case when o.o_orderstatus = 'F' then 1 else 0 end as bigint) as is_fraud,
               case when o.o_orderkey % 7 = 0 or c.c_custkey % 40 = 5 then null
                    else cast(20000 + c.c_nationkey * 10 + o.o_orderkey % 3 as varchar) end as merch_zipcode
        from orders o join customer c on o.o_custkey = c.c_custkey
                      join nation n on c.c_nationkey = n.n_nationkey""",
    "raw_txn_dup": "select * from raw_txn union all select * from raw_txn",
    "txn": """
        select trans_num, try_cast(trans_date_trans_time as timestamp) as datetime, cast(cc_num as varchar) as cc_num,
               merchant, category, amt, gender, street, city, state, zip, lat, long, city_pop, job,
               cast(10 + cast(trans_num as bigint) % 70 as bigint) as age, merch_lat, merch_long, is_fraud,
               merch_zipcode
        from raw_txn""",
    "ref_txn": "select * from txn where datetime < timestamp '1999-01-01'",
    "ana_txn": """
        select trans_num, datetime, amt * 1.1::double as amt, lat, long, city_pop, merch_lat, merch_long, category,
               gender, 'city_1' as city, state, zip, age, is_fraud
        from txn where datetime >= timestamp '1999-01-01'""",
    "ingested": """
        select merchant, category, amt, gender, street, city, state, zip, lat, long, city_pop, job, trans_num,
               merch_lat, merch_long, is_fraud, merch_zipcode,
               try_cast(trans_date_trans_time as timestamp) as datetime,
               sha256(cast(cc_num as varchar)) as cc_num_hashed, sha256(first) as first_hashed,
               sha256(last) as last_hashed,
               cast(floor(floor((epoch_us(try_cast(trans_date_trans_time as timestamp))
                                 - epoch_us(try_cast(dob as timestamp))) / 86400000000.0) / 365) as bigint) as age
        from (select distinct * from raw_txn)""",
    "scored": """
        select l.doc_id, l.quality as y_true, case when d.n_chars % 5 < 4 then 1 else 0 end as y_pred
        from labels l join documents d on l.doc_id = d.doc_id""",
}
NEEDS = {"raw_txn": [], "raw_txn_dup": ["raw_txn"], "txn": ["raw_txn"], "ref_txn": ["raw_txn", "txn"],
         "ana_txn": ["raw_txn", "txn"], "ingested": ["raw_txn"], "scored": []}


def sql(body: str, *views: str) -> str:
    """The statement with the named views, and what they need, defined in front of it."""
    order = [v for v in SQL_VIEWS if v in {n for w in views for n in [*NEEDS[w], w]}]
    defined = ", ".join(f"{v} as ({SQL_VIEWS[v]})" for v in order)
    text = body.strip()
    if text.lower().startswith("with "):
        return f"with {defined}, {text[5:]}"
    return f"with {defined} {text}"
