"""Queries of phrases, periodic runs and shards."""

from __future__ import annotations

from pyspark.sql import functions as F

from txnlens.llm import periodic_runs, phrase_graph, sharding
from txnlens.llm.registry import query, table

OP11_SQL = """
with d as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\\x0A-\\x0D]')) as piece from documents),
w as (select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as ws from d),
g as (
  select lang, size, array_to_string(ws[i:i + size - 1], ' ') as phrase
  from (select lang, ws, size, unnest(range(1, len(ws) - size + 2)) as i from w, (values (1), (2), (3)) s(size))),
f as (select lang, size, phrase, count(*) as a from g group by all),
n as (select lang, sum(a) as n from f where size = 1 group by lang),
c as (select * from f where size > 1 and a >= 10),
t as (select lang, a, string_split(phrase, ' ') as p from c where size = 3),
i as (select lang, unnest([p[1] || ' ' || p[2], p[2] || ' ' || p[3]]) as phrase, a from t),
o as (select lang, phrase, max(a) as b from i group by all),
k as (select c.* from c left join o on o.lang = c.lang and o.phrase = c.phrase and c.size = 2
      where o.b is null or 100 * o.b < 50 * c.a),
u as (select lang, phrase, a, cut, array_to_string(string_split(phrase, ' ')[:cut], ' ') as x,
             array_to_string(string_split(phrase, ' ')[cut + 1:], ' ') as y
      from (select *, unnest(range(1, size)) as cut from k)),
s as (
  select u.lang, u.phrase, u.a, l.a as l, r.a as r, cut,
         (1000000 * u.a::hugeint * u.a) // (l.a::hugeint * r.a) as score
  from u join f l on l.lang = u.lang and l.phrase = u.x join f r on r.lang = u.lang and r.phrase = u.y),
b as (select * from s qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
r as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from b)
select r.lang, cast(rank as bigint) as rank, phrase, cast(a as bigint) as a, cast(l as bigint) as l,
       cast(r as bigint) as r, cast(n as bigint) as n, cast(score as bigint) as score
from r join n using (lang) where rank <= 2000
"""


@query("op11_phrase_collocations", OP11_SQL)
def op11(spark, sf_dir):
    return phrase_graph.collocations(table(spark, sf_dir, "documents"))


@query("op12_periodic_runs")
def op12(spark, sf_dir):
    return periodic_runs.find_runs(table(spark, sf_dir, "documents"), repeated_tails=True).drop("n_words", "runs", "collapsed")


@query("op13_sharding")
def op13(spark, sf_dir):
    found = sharding.assign(table(spark, sf_dir, "documents"))
    return found.withColumn("law", F.lit("bytes")).withColumn("grown_shard", F.lit(None).cast("int")) \
        .select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
