"""Queries of the deduplication operators."""

from __future__ import annotations

from txnlens.llm import near_dup, suffix_array, suffix_trees
from txnlens.llm.registry import query, table

OP10_SQL = """
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as ws
  from documents),
s as (
  select doc_id, unnest(case when len(ws) = 0 then [] when len(ws) < 3 then [array_to_string(ws, ' ')]
    else list_distinct(list_transform(range(1, len(ws) - 1),
                                      lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) end) as g
  from w),
n as (select doc_id, count(*) as n from s group by doc_id),
f as (
  select doc_id, g, row_number() over (partition by doc_id order by df, g) as r
  from s join (select g, count(*) as df from s group by g) using (g)),
p as (select f.* from f join n using (doc_id) where r <= n - (85 * n + 99) // 100 + 1),
c as (select distinct a.doc_id as a, b.doc_id as b from p a join p b on a.g = b.g and a.doc_id < b.doc_id),
i as (select c.a, c.b, count(*) as k from c join s x on x.doc_id = c.a join s y on y.doc_id = c.b and y.g = x.g
      group by 1, 2),
e as (select i.a, i.b from i join n x on x.doc_id = i.a join n y on y.doc_id = i.b
      where 100 * k >= 85 * (x.n + y.n - k)),
l as (select a, b from e union all select b, a from e),
t as (select doc_id, doc_id as root from w union select l.b, t.root from t join l on l.a = t.doc_id),
m as (select doc_id, min(root) as component_id from t group by doc_id)
select m.doc_id, cast(coalesce(n.n, 0) as bigint) as n_shingles, component_id, m.doc_id = component_id as kept
from m left join n on n.doc_id = m.doc_id
"""


@query("op10_minhash_near_dedup", OP10_SQL)
def op10(spark, sf_dir):
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


@query("op1_suffix_array_dedup")
def op1(spark, sf_dir):
    return suffix_array.remove_repeated_bytes(table(spark, sf_dir, "documents")).drop("kept")


OP5_SQL = """
with w as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as ws from documents),
s as (
  select doc_id, i, array_to_string(ws[i:i + 49], ' ') as g
  from (select doc_id, ws, unnest(range(1, len(ws) - 48)) as i from w)),
f as (select g, min(doc_id) as d from s group by g having min(doc_id) < max(doc_id)),
r as (select distinct doc_id, i + k as p from s join f using (g), (select unnest(range(0, 50)) as k)
      where doc_id > d),
x as (select doc_id, ws, unnest(range(1, len(ws) + 1)) as p from w),
k as (select x.doc_id, string_agg(ws[p], ' ' order by p) as t from x anti join r using (doc_id, p) group by x.doc_id)
select w.doc_id, cast(len(ws) as bigint) as n_words, cast(coalesce(n, 0) as bigint) as n_removed,
       sha256(coalesce(t, '')) as kept_sha256
from w left join (select doc_id, count(*) as n from r group by doc_id) r on r.doc_id = w.doc_id
       left join k on k.doc_id = w.doc_id
"""


@query("op5_substring_dedup", OP5_SQL)
def op5(spark, sf_dir):
    return suffix_trees.remove_earlier_windows(table(spark, sf_dir, "documents")).drop("kept")
