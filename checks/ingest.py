"""Ingestion, projections and anonymisation."""

from pyspark.sql import functions as F

from checks import views as V
from checks.registry import query
from txnlens.operators import ingest as ops
from txnlens.roles import ZIP_PATTERN, Roles

TS = "strftime(try_cast(trans_date_trans_time as timestamp), '%Y-%m-%d %H:%M:%S')"


def text_time(df, *columns):
    """Timestamps as text, so that both sides compare the same type."""
    names = columns or ["datetime"]
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in names})


@query("drop_exact_duplicates", V.sql("select distinct * from raw_txn_dup", "raw_txn_dup"))
def _(spark, sf):
    return ops.drop_exact_duplicates(V.raw_txn_dup(spark, sf))


@query("parse_timestamp_lenient", V.sql(f"""
    select trans_num, {TS} as datetime, dob, strftime(try_cast(dob as timestamp), '%Y-%m-%d %H:%M:%S') as born
    from raw_txn""", "raw_txn"))
def _(spark, sf):
    out = V.raw_txn(spark, sf).transform(ops.parse_timestamp).transform(lambda d: ops.parse_timestamp(d, "dob", "born"))
    return text_time(out.select("trans_num", "datetime", "dob", "born"), "datetime", "born")


@query("drop_redundant_columns", V.sql("""
    select cc_num, merchant, category, amt, first, last, gender, street, city, state, zip, lat, long, city_pop, job,
           trans_num, merch_lat, merch_long, is_fraud, merch_zipcode from raw_txn""", "raw_txn"))
def _(spark, sf):
    return ops.drop_redundant_columns(V.raw_txn(spark, sf))


@query("ids_to_string", V.sql("""
    select trans_num, cast(cc_num as varchar) as cc_num, cast(cast(zip as bigint) as varchar) as zip, merch_zipcode
    from raw_txn""", "raw_txn"))
def _(spark, sf):
    # zips arrive as floating numbers here, as they do from untyped files
    raw = V.raw_txn(spark, sf).withColumns({"zip": F.col("zip").cast("double"),
                                            "merch_zipcode": F.col("merch_zipcode").cast("double")})
    return ops.ids_to_string(raw).select("trans_num", "cc_num", "zip", "merch_zipcode")


@query("hash_pii", V.sql("""
    select trans_num, sha256(cast(cc_num as varchar)) as cc_num_hashed, sha256(first) as first_hashed,
           sha256(last) as last_hashed from raw_txn""", "raw_txn"))
def _(spark, sf):
    return ops.hash_pii(V.raw_txn(spark, sf)).select("trans_num", "cc_num_hashed", "first_hashed", "last_hashed")


@query("derive_age", V.sql("""
    select trans_num, cast(floor(floor((epoch_us(try_cast(trans_date_trans_time as timestamp))
        - epoch_us(try_cast(dob as timestamp))) / 86400000000.0) / 365) as bigint) as age from raw_txn""", "raw_txn"))
def _(spark, sf):
    return V.raw_txn(spark, sf).transform(ops.parse_timestamp).transform(ops.derive_age).select("trans_num", "age")


@query("derive_age_by_year", V.sql("""
    select trans_num, cast(year(try_cast(trans_date_trans_time as timestamp)) - year(try_cast(dob as timestamp))
        as bigint) as age from raw_txn""", "raw_txn"))
def _(spark, sf):
    return (V.raw_txn(spark, sf).transform(ops.parse_timestamp).transform(ops.derive_age_by_year)
            .select("trans_num", "age"))


@query("filter_by_value", V.sql("select trans_num, state, amt from txn where state = 'NATION_3'", "txn"))
def _(spark, sf):
    return ops.filter_by_value(V.txn(spark, sf), "state", "NATION_3").select("trans_num", "state", "amt")


@query("filter_out_of_range", V.sql("select trans_num, age from txn where age < 16 or age > 120", "txn"))
def _(spark, sf):
    return ops.filter_out_of_range(V.txn(spark, sf), "age", 16, 120).select("trans_num", "age")


@query("filter_regex_mismatch", V.sql(
    r"select trans_num, zip from txn where not regexp_matches(zip, '^\d{5}(-\d{4})?$')", "txn"))
def _(spark, sf):
    return ops.filter_regex_mismatch(V.txn(spark, sf), "zip", ZIP_PATTERN).select("trans_num", "zip")


@query("drop_columns", V.sql("""
    select trans_num, strftime(datetime, '%Y-%m-%d %H:%M:%S') as datetime, cc_num, category, amt, gender, street, city,
           state, zip, lat, long, city_pop, job, age, merch_lat, merch_long, is_fraud, merch_zipcode from txn""", "txn"))
def _(spark, sf):
    return text_time(ops.drop_columns(V.txn(spark, sf), Roles())[0])


@query("drop_listed_features", V.sql("select trans_num, lat, long, merch_lat from txn", "txn"))
def _(spark, sf):
    frame = V.txn(spark, sf).select("trans_num", "amt", "lat", "long", "city_pop", "merch_lat")
    return ops.drop_listed_features(frame, ["amt", "city_pop"])
