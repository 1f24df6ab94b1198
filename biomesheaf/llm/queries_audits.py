"""Queries of the operators that audit: conversations, filters, exact copies."""

from pyspark.sql import functions as F

from . import exact, filters, turns
from .registry import query, table

_WORDS = r"regexp_extract_all(t, '[^\x20\x09-\x0D]+')"

FILTERS_SQL = rf"""
with texts as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as t from documents),
marks as (select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by doc_id),
failing as materialized (
  select part, coalesce(good, false) as good, coalesce(toxic, false) as toxic, list_filter(['A', 'B', 'C', 'D', 'E'], lambda f: case f
    when 'A' then len(w) < 50 when 'B' then 100 * len(list_distinct(w)) < 65 * len(w)
    when 'C' then 100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * len(t) when 'D' then regexp_matches(t, '[#$%&*|]') else copy end) as f
  from (select *, {_WORDS} as w, coalesce(doc_id > min(doc_id) over (partition by t), false) as copy from texts) left join marks using (doc_id)),
sets as materialized (select part, f, count(*) as n, count_if(good) as good, count_if(toxic) as toxic from failing group by part, f),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
orders as materialized (select a.x || b.x || c.x || d.x || e.x as o from letters a, letters b, letters c, letters d, letters e
  where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps as materialized (select o, step, o[step] as x, string_split(o[1:step - 1], '') as before from orders, (select unnest(range(1, 6)) as step)),
told as materialized (
  select part, o, step, x, sum(n) as total, sum(if(list_has_any(f, before || [x]), n, 0)) as gone,
    sum(if(list_has(f, x) and not list_has_any(f, before), n, 0)) as removed, sum(if(list_has(f, x) and list_has_any(f, before), n, 0)) as redundant,
    sum(if(f = [x], n, 0)) as unique_fails, sum(if(list_has(f, x) and not list_has_any(f, before), good, 0)) as good_lost,
    sum(if(list_has(f, x) and not list_has_any(f, before), toxic, 0)) as toxic_lost
  from sets, steps group by part, o, step, x)
select part, o as filter_order, step::int as step, (total - gone)::bigint as kept, removed::bigint as removed, redundant::bigint as redundant,
  unique_fails::bigint as unique_fails, good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost,
  sum(removed) over (partition by part, x)::bigint as shapley
from told"""


@query("op12_filter_audit", FILTERS_SQL)
def op12_filter_audit(spark, folder):
    return filters.audit(filters.failure_counts(table(spark, folder, "documents"), table(spark, folder, "labels")))


EXACT_SQL = r"""
select doc_id, first_value(doc_id) over best as keep_id, count(*) over (partition by bare) as group_size,
  row_number() over best = 1 as kept, sha256(bare) as text_sha256
from (select doc_id, coalesce(text, '') as t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as bare from documents)
window best as (partition by bare order by length(t) desc, doc_id asc nulls last)"""


@query("op13_exact_dedup", EXACT_SQL)
def op13_exact_dedup(spark, folder):
    found = exact.exact_copies(table(spark, folder, "documents"))
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


@query("op11_conversation_repair")
def op11_conversation_repair(spark, folder):
    return turns.audits(turns.damaged(table(spark, folder, "conversations")))
