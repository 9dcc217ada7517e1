"""Cleaning, imputation, derived features and binnings."""

from pyspark.sql import functions as F

from checks import views as V
from checks.registry import query
from txnlens.operators import cleaning as C, features as E
from txnlens.roles import Roles

MODES = """
    city_modes as (
        select city as key, merch_zipcode as mode, n from (
            select city, merch_zipcode, count(*) as n,
                   row_number() over (partition by city order by count(*) desc, merch_zipcode) as r
            from {source} where merch_zipcode is not null and city is not null group by city, merch_zipcode) where r = 1),
    state_modes as (
        select state as key, merch_zipcode as mode, n from (
            select state, merch_zipcode, count(*) as n,
                   row_number() over (partition by state order by count(*) desc, merch_zipcode) as r
            from {source} where merch_zipcode is not null and state is not null group by state, merch_zipcode) where r = 1)"""


@query("cap_min", V.sql("select trans_num, case when age < 16 then 16 else age end as age from txn", "txn"))
def _(spark, sf):
    return C.cap_min(V.txn(spark, sf)).select("trans_num", "age")


@query("fill_sentinel", V.sql("""
    select trans_num, coalesce(age, -9999) as age, coalesce(merch_zipcode, '-9999') as merch_zipcode, amt
    from ingested""", "ingested"))
def _(spark, sf):
    return C.fill_sentinel(V.ingested(spark, sf)).select("trans_num", "age", "merch_zipcode", "amt")


@query("fit_mode_lookup", V.sql(f"""
    with {MODES.format(source='txn')}
    select 'city' as level, key, mode, n from city_modes union all select 'state', key, mode, n from state_modes""",
    "txn"))
def _(spark, sf):
    return C.fit_mode_lookup(V.txn(spark, sf))


IMPUTED = """
    select trans_num, coalesce(t.merch_zipcode, c.mode, s.mode) as merch_zipcode
    from {rows} t left join city_modes c on t.city = c.key left join state_modes s on t.state = s.key"""


@query("impute_hierarchical", V.sql(
    f"with {MODES.format(source='txn')} {IMPUTED.format(rows='txn')}", "txn"))
def _(spark, sf):
    rows = V.txn(spark, sf)
    return C.impute_hierarchical(rows, C.fit_mode_lookup(rows)).select("trans_num", "merch_zipcode")


@query("missing_flag", V.sql(
    "select trans_num, case when merch_zipcode is null then 1 else 0 end as zip_missing from txn", "txn"))
def _(spark, sf):
    return C.missing_flag(V.txn(spark, sf)).select("trans_num", "zip_missing")


@query("impute_apply", V.sql(f"""
    with late as (select * from txn where datetime >= timestamp '1999-01-01'), {MODES.format(source='ref_txn')}
    {IMPUTED.format(rows='late')}""", "txn", "ref_txn"))
def _(spark, sf):
    lookup = C.fit_mode_lookup(V.ref_txn(spark, sf))
    return C.impute_hierarchical(V.late_txn(spark, sf), lookup).select("trans_num", "merch_zipcode")


@query("fit_quantile_cap", V.sql(
    "select 'amt' as feature, round(quantile_cont(amt, 0.99), 6) as cap from txn", "txn"))
def _(spark, sf):
    return V.rounded(C.fit_quantile_cap(V.txn(spark, sf)))


@query("apply_cap", V.sql("""
    select trans_num, round(least(amt, cap), 6) as amt, round(ln(1 + least(amt, cap)), 6) as log_amt
    from txn, (select quantile_cont(amt, 0.99) as cap from txn)""", "txn"))
def _(spark, sf):
    rows = V.txn(spark, sf)
    return V.rounded(C.apply_cap(rows, C.fit_quantile_cap(rows)).select("trans_num", "amt", "log_amt"))


DISTANCE = """2 * 6371 * asin(sqrt(least(1.0, pow(sin((radians(merch_lat) - radians(lat)) / 2), 2)
    + cos(radians(lat)) * cos(radians(merch_lat)) * pow(sin((radians(merch_long) - radians(long)) / 2), 2))))"""


@query("haversine_km", V.sql(f"select trans_num, round({DISTANCE}, 6) as distance from txn", "txn"))
def _(spark, sf):
    return V.rounded(E.add_distance(V.txn(spark, sf)).select("trans_num", "distance"))


PARTS = """cast(hour(datetime) as int) as hour, cast(day(datetime) as int) as day,
    cast(isodow(datetime) - 1 as int) as weekday, cast(month(datetime) as int) as month"""


@query("calendar_parts", V.sql(f"select trans_num, {PARTS} from txn", "txn"))
def _(spark, sf):
    return E.add_calendar_parts(V.txn(spark, sf)).select("trans_num", "hour", "day", "weekday", "month")


@query("is_weekend", V.sql("""
    select is_weekend, count(*) as n from (
        select case when isodow(datetime) - 1 in (5, 6) then 1 else 0 end as is_weekend from txn)
    group by is_weekend""", "txn"))
def _(spark, sf):
    marked = V.txn(spark, sf).transform(E.add_calendar_parts).transform(E.add_is_weekend)
    return marked.groupBy("is_weekend").agg(F.count(F.lit(1)).alias("n"))


@query("log1p_features", V.sql("""
    select trans_num, round(ln(1 + amt), 6) as log_amt, round(ln(1 + city_pop), 6) as log_city_pop from txn""", "txn"))
def _(spark, sf):
    return V.rounded(E.add_log_features(V.txn(spark, sf)).select("trans_num", "log_amt", "log_city_pop"))


@query("amt_per_km", V.sql(f"select trans_num, round(amt / ({DISTANCE} + 0.01), 6) as amt_per_km from txn", "txn"))
def _(spark, sf):
    return V.rounded(V.txn(spark, sf).transform(E.add_distance).transform(E.add_amt_per_km)
                     .select("trans_num", "amt_per_km"))


@query("rare_label_group", V.sql("""
    with rare as (select state from txn where state is not null group by state
                  having count(*) / (select count(state) from txn) < 0.04)
    select trans_num, state, case when state in (select state from rare) then 'Other' else state end as state_grouped
    from txn""", "txn"))
def _(spark, sf):
    return E.rare_label_group(V.txn(spark, sf), "state", 0.04).select("trans_num", "state", "state_grouped")


@query("invalid_format_flag", V.sql(r"""
    select trans_num, case when regexp_matches(zip, '^\d{5}(-\d{4})?$') then 0.0 else 1.0 end::double as invalid_zip
    from txn""", "txn"))
def _(spark, sf):
    return E.add_invalid_zip(V.txn(spark, sf)).select("trans_num", "invalid_zip")


@query("invalid_ccnum_flag", V.sql(r"""
    select trans_num, case when regexp_matches(cc_num, '^\d{13,19}$') then 0.0 else 1.0 end::double as invalid_cc_num
    from txn""", "txn"))
def _(spark, sf):
    return E.add_invalid_cc_num(V.txn(spark, sf)).select("trans_num", "invalid_cc_num")


@query("feature_engineering", V.sql(rf"""
    with rare as (select state from txn where state is not null group by state
                  having count(*) / (select count(state) from txn) < 0.04)
    select trans_num, round({DISTANCE}, 6) as distance, {PARTS},
           case when isodow(datetime) - 1 in (5, 6) then 1 else 0 end as is_weekend,
           round(ln(1 + amt), 6) as log_amt, round(ln(1 + city_pop), 6) as log_city_pop,
           round(amt / ({DISTANCE} + 0.01), 6) as amt_per_km,
           case when state in (select state from rare) then 'Other' else state end as state_grouped,
           case when regexp_matches(zip, '^\d{{5}}(-\d{{4}})?$') then 0.0 else 1.0 end::double as invalid_zip
    from txn""", "txn"))
def _(spark, sf):
    rows = V.txn(spark, sf)
    out, _roles = E.feature_engineering(rows, E.fit_rare_labels(rows, "state", 0.04), Roles())
    return V.rounded(out.select("trans_num", "distance", "hour", "day", "weekday", "month", "is_weekend", "log_amt",
                                "log_city_pop", "amt_per_km", "state_grouped", "invalid_zip"))


@query("bin_age", V.sql("""
    select trans_num, case when age between 18 and 35 then 1 when age between 36 and 60 then 2 when age >= 61 then 3
           else 0 end as bin_age from txn""", "txn"))
def _(spark, sf):
    return E.add_bin_age(V.txn(spark, sf)).select("trans_num", "bin_age")


# contact counts, call minutes, days since contact and balances come from the line items and customers
@query("bin_campaign", """
    select l_orderkey, l_linenumber, case when l_linenumber = 1 then 1 when l_linenumber between 2 and 3 then 2
           when l_linenumber >= 4 then 3 else l_linenumber end as campaign from lineitem""")
def _(spark, sf):
    rows = V.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_linenumber").alias("campaign"))
    return E.bin_campaign(rows)


@query("duration_flags", """
    select l_orderkey, l_linenumber, l_quantity as duration, case when l_quantity <= 5 then 1 else 0 end as t_min,
           case when l_quantity > 5 and l_quantity <= 10 then 1 else 0 end as t_e_min,
           case when l_quantity > 10 then 1 else 0 end as e_min from lineitem""")
def _(spark, sf):
    rows = V.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("duration"))
    return E.add_duration_flags(rows)


@query("pdays_bins", """
    select o_orderkey, pdays, case when pdays = -1 then 1 else 0 end as pdays_not_contacted,
           round(case when m >= 0 and m <= 2 then 1 when m > 2 and m <= 6 then 2 when m > 6 then 3 else m end, 6)
               as months_passed
    from (select *, pdays / 30.0::double as m from (select o_orderkey, o_custkey % 400 - 1 as pdays from orders))""")
def _(spark, sf):
    rows = V.table(spark, sf, "orders").select("o_orderkey", F.expr("o_custkey % 400 - 1").alias("pdays"))
    return V.rounded(E.add_pdays_bins(rows), "months_passed")


@query("balance_bins", """
    select c_custkey, c_acctbal as balance, case when c_acctbal < 0 then 1 else 0 end as "Neg_Balance",
           case when c_acctbal = 0 then 1 else 0 end as "No_Balance",
           case when c_acctbal > 0 then 1 else 0 end as "Pos_Balance",
           case when c_acctbal < 1 then 0 when c_acctbal < 100 then 1 when c_acctbal < 500 then 2
                when c_acctbal < 2000 then 3 when c_acctbal < 5000 then 4 else 5 end as "bin_Balance" from customer""")
def _(spark, sf):
    rows = V.table(spark, sf, "customer").select("c_custkey", F.col("c_acctbal").alias("balance"))
    return E.add_balance_bins(rows)
