"""Queries of the quality rules and the token counts."""

from __future__ import annotations

from txnlens.llm import quality_rules, token_counts
from txnlens.llm.registry import query, table

_STOPS = ", ".join(f"'{w}'" for w in quality_rules.STOP_WORDS)
_RULES = " and ".join(f"({r.sql()})" for r in quality_rules.RULES)

#: Measures of each document, for op8's SQL and the pipeline's first stage.
MEASURES_SQL = f"""
w as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as ls,
         coalesce(text, '') as t
  from documents),
g as (
  select doc_id, i, ws[i] as a, ws[i + 1] as b, ws[i + 2] as c
  from (select doc_id, ws, unnest(range(1, len(ws) - 1)) as i from w)),
r as (select doc_id, i, count(*) over (partition by doc_id, a, b, c) as n from g),
p as (select doc_id, count(distinct i + k) as n_repeat_words
      from r, (select unnest([0, 1, 2]) as k) where n > 1 group by doc_id),
m as (
  select w.doc_id, cast(len(ws) as bigint) as n_words,
         cast(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) as bigint) as word_chars,
         cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
         cast(len(ls) - len(list_distinct(ls)) as bigint) as n_dup_lines,
         cast(coalesce(p.n_repeat_words, 0) as bigint) as n_repeat_words, cast(len(ls) as bigint) as n_lines,
         cast(len(list_filter(ws, lambda x: lower(x) in ({_STOPS}))) as bigint) as n_stop_words
  from w left join p on w.doc_id = p.doc_id),
j as (select *, n_words < {quality_rules.MIN_WORDS}
             or 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PERCENT} * n_words as base_failed from m)
"""

OP8_SQL = f"""
with {MEASURES_SQL}
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and {_RULES} as kept
from j
"""


@query("op8_quality_rules", OP8_SQL)
def op8(spark, sf_dir):
    return quality_rules.judge(table(spark, sf_dir, "documents"), "doc_id").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op7_token_counts")
def op7(spark, sf_dir):
    return token_counts.context_table(token_counts.length_histogram(table(spark, sf_dir, "documents")))
