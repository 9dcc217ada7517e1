"""Encoders, the scaler, the whole preprocessing chain, and splits."""

from pyspark.sql import functions as F

from checks import views as V
from checks.cleaning import DISTANCE, MODES, PARTS
from checks.ingest import text_time
from checks.registry import query
from txnlens.operators import encoding as E, features, splitting as S
from txnlens.plans import preprocess
from txnlens.roles import BASE_NUMERICAL

FREQ_COLUMNS = ["merchant", "street", "city", "state", "zip", "job", "merch_zipcode"]
SEGMENTS = ["BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
ONEHOT = ", ".join([f"case when category = '{s}' then 1.0 else 0.0 end::double as \"category_{s}\"" for s in SEGMENTS]
                   + ["case when gender = 'M' then 1.0 else 0.0 end::double as \"gender_M\""])


@query("fit_onehot", V.sql("""
    select 'category' as feature, category as value, cast(row_number() over (order by category) as int) as position
    from (select distinct category from txn) union all
    select 'gender', gender, cast(row_number() over (order by gender) as int) from (select distinct gender from txn)""",
    "txn"))
def _(spark, sf):
    return E.fit_onehot(V.txn(spark, sf), ["category", "gender"])


@query("apply_onehot", V.sql(f"""
    select trans_num, {ONEHOT} from txn""", "txn"))
def _(spark, sf):
    # categories learnt on the early rows, applied to all
    categories = E.fit_onehot(V.ref_txn(spark, sf), ["category", "gender"])
    rows = V.txn(spark, sf).select("trans_num", "category", "gender")
    return E.apply_onehot(rows, categories, ["category", "gender"])


@query("fit_freq", V.sql(" union all ".join(
    f"""select '{c}' as feature, {c} as value, count(*) as n, round(count(*) / (select count({c}) from txn), 6) as share
        from txn where {c} is not null group by {c}""" for c in FREQ_COLUMNS), "txn"))
def _(spark, sf):
    return V.rounded(E.fit_freq(V.txn(spark, sf), FREQ_COLUMNS))


@query("apply_freq", V.sql("select trans_num, " + ", ".join(
    f"""round(coalesce((select count(*) from ref_txn r where r.{c} = t.{c}) /
        (select count({c}) from ref_txn)::double, 0), 6) as {c}_freq""" for c in FREQ_COLUMNS) + " from txn t",
    "txn", "ref_txn"))
def _(spark, sf):
    # shares learnt on the early rows; customers seen only later get 0
    shares = E.fit_freq(V.ref_txn(spark, sf), FREQ_COLUMNS)
    rows = V.txn(spark, sf).select("trans_num", *FREQ_COLUMNS)
    return V.rounded(E.apply_freq(rows, shares, FREQ_COLUMNS))


CYCLES = {"hour": 24, "weekday": 7, "month": 12, "day": 31}
CYCLE_SQL = ", ".join(f"round({f}(2 * pi() * {c} / {p}), 6) as {c}_{f}" for c, p in CYCLES.items() for f in ("sin", "cos"))


@query("cyclic_encode", V.sql(f"select trans_num, {CYCLE_SQL} from (select trans_num, {PARTS} from txn)", "txn"))
def _(spark, sf):
    rows = features.add_calendar_parts(V.txn(spark, sf)).select("trans_num", *CYCLES)
    return V.rounded(E.cyclic_encode(rows))


@query("fit_standard", V.sql(" union all ".join(
    f"select '{c}' as feature, round(avg({c}), 6) as mean, round(stddev_pop({c}), 6) as std from txn"
    for c in BASE_NUMERICAL), "txn"))
def _(spark, sf):
    return V.rounded(E.fit_standard(V.txn(spark, sf), BASE_NUMERICAL))


@query("apply_standard", V.sql("select trans_num, " + ", ".join(
    f"round(({c} - (select avg({c}) from ref_txn)) / (select stddev_pop({c}) from ref_txn), 6) as {c}"
    for c in BASE_NUMERICAL) + " from txn", "txn", "ref_txn"))
def _(spark, sf):
    stats = E.fit_standard(V.ref_txn(spark, sf), BASE_NUMERICAL)
    rows = V.txn(spark, sf).select("trans_num", *BASE_NUMERICAL)
    return V.rounded(E.apply_standard(rows, stats))


SCALED = ["amt", "lat", "long", "city_pop", "age", "merch_lat", "merch_long", "distance", "log_amt", "log_city_pop",
          "amt_per_km"]
HIGH = ["street", "city", "state", "zip", "job", "merch_zipcode", "state_grouped"]


def preprocess_sql(rows: str) -> str:
    """The chain learnt on ref_txn and applied to ``rows``."""
    def derived(source):
        return rf"""
            select *, {DISTANCE} as distance, {PARTS}, ln(1 + city_pop) as log_city_pop,
                   amt / ({DISTANCE} + 0.01) as amt_per_km,
                   case when state in (select state from rare) then 'Other' else state end as state_grouped,
                   case when regexp_matches(zip, '^\d{{5}}(-\d{{4}})?$') then 0.0 else 1.0 end as invalid_zip,
                   case when isodow(datetime) - 1 in (5, 6) then 1 else 0 end as is_weekend
            from (select t.* exclude (age, merch_zipcode), greatest(age, 16) as age,
                         coalesce(t.merch_zipcode, c.mode, s.mode, '-9999') as merch_zipcode,
                         case when coalesce(t.merch_zipcode, c.mode, s.mode) is null then 1 else 0 end as zip_missing
                  from {source} t left join city_modes c on t.city = c.key left join state_modes s on t.state = s.key)"""

    def capped(source):
        return (f"select * replace (least(amt, (select quantile_cont(amt, 0.99) from ref_txn)) as amt), "
                f"ln(1 + least(amt, (select quantile_cont(amt, 0.99) from ref_txn))) as log_amt from {source}")

    scaled = ", ".join(f"round((x.{c} - m.{c}_m) / m.{c}_s, 6) as {c}" for c in SCALED)
    moments = ", ".join(f"avg({c}) as {c}_m, stddev_pop({c}) as {c}_s" for c in SCALED)
    freq_tables = ", ".join(
        f"f_{c} as (select {c} as v, count(*) / (select count(*) from fit_rows)::double as f from fit_rows group by {c})"
        for c in HIGH)
    freq_joins = " ".join(f"left join f_{c} on x.{c} = f_{c}.v" for c in HIGH)
    freqs = ", ".join(f"round(coalesce(f_{c}.f, 0), 6) as {c}_freq" for c in HIGH)
    return f"""
        with {MODES.format(source='ref_txn')},
        rare as (select state from ref_txn group by state having count(*) / (select count(*) from ref_txn) < 0.04),
        fit_derived as ({derived('ref_txn')}), fit_rows as ({capped('fit_derived')}),
        new_derived as ({derived(rows)}), new_rows as ({capped('new_derived')}),
        moments as (select {moments} from fit_rows), {freq_tables}
        select x.trans_num, strftime(x.datetime, '%Y-%m-%d %H:%M:%S') as datetime, x.is_fraud, {scaled}, x.zip_missing,
               {ONEHOT}, case when is_weekend = 1 then 1.0 else 0.0 end::double as is_weekend_1,
               x.invalid_zip::double as invalid_zip, {freqs}, {CYCLE_SQL}
        from new_rows x cross join moments m {freq_joins}"""


@query("preprocess_fit", V.sql(preprocess_sql("ref_txn"), "ref_txn"))
def _(spark, sf):
    ready, _fitted = preprocess.fit(V.ref_txn(spark, sf), rare_share=0.04)
    return V.rounded(text_time(ready))


@query("preprocess_apply", V.sql(
    preprocess_sql("(select * from txn where datetime >= timestamp '1999-01-01')"), "txn", "ref_txn"))
def _(spark, sf):
    _ready, fitted = preprocess.fit(V.ref_txn(spark, sf), rare_share=0.04)
    return V.rounded(text_time(preprocess.apply(V.late_txn(spark, sf), fitted)))


def split_sql(seed: int, cases: str, columns: str = "trans_num, is_fraud") -> str:
    return f"""select {columns}, {cases} as split from (
        select *, row_number() over (partition by is_fraud order by sha256(concat(trans_num, '{seed}'))) as r,
               count(*) over (partition by is_fraud) as n from txn)"""


@query("stratified_split", V.sql(split_sql(200, "case when r <= ceil(n / 5.0) then 'ana' else 'ref' end"), "txn"))
def _(spark, sf):
    ref, ana = S.stratified_split(V.txn(spark, sf))
    return (ref.select("trans_num", "is_fraud", F.lit("ref").alias("split"))
            .unionByName(ana.select("trans_num", "is_fraud", F.lit("ana").alias("split"))))


@query("train_test_xy", V.sql(split_sql(
    2021, "case when r <= ceil(n * 3 / 10.0) then 'test' else 'train' end", "trans_num, is_fraud, amt, lat, age"), "txn"))
def _(spark, sf):
    rows = V.txn(spark, sf).select("trans_num", "datetime", "is_fraud", "amt", "lat", "age")
    train, test, _columns = S.train_test_xy(rows)
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


@query("three_way_split", V.sql(split_sql(
    42, "case when r <= ceil(n / 5.0) then 'test' when r <= ceil(n * 2 / 5.0) then 'val' else 'train' end"), "txn"))
def _(spark, sf):
    return S.three_way_split(V.txn(spark, sf)).select("trans_num", "is_fraud", "split")
