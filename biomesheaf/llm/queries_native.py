"""Queries of the operators that SQL can express, with that SQL."""

from pyspark.sql import functions as F

from . import licenses, mixing, warc
from .registry import query, table

_TRANSLATE = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _normal(text):
    return f"regexp_replace({_TRANSLATE.format(f"coalesce({text}, '')")}, '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g')"


def _bigrams(words):
    return f"list_distinct(list_transform(list_zip({words}[1:len({words}) - 1], {words}[2:]), lambda x: x[1] || ' ' || x[2]))"


_WORDS = "list_filter(string_split_regex({}, '[ \\n]+'), lambda w: w <> '')"
_TEMPLATES = ", ".join(f"({i}, '{k}', '{t.replace("'", "''")}')" for i, (k, t) in enumerate(licenses.TEMPLATES))

LICENSE_SQL = f"""
with templates as (
  select template, license, {_bigrams("w")} as bigrams
  from (select template, license, {_WORDS.format(_normal("t"))} as w from (values {_TEMPLATES}) v(template, license, t))),
words_in_template as (select template, license, len(bigrams) as b, unnest(bigrams) as bigram from templates),
normal as (select distinct doc_id, md5(t) as key, t from (select doc_id, {_normal("text")} as t from documents)),
segments as (
  select doc_id, key, 'l' || generate_subscripts(string_split(t, chr(10)), 1) as place, unnest(string_split(t, chr(10))) as s from normal
  union all
  select doc_id, key, 'p' || generate_subscripts(p, 1), unnest(p)
  from (select doc_id, key, string_split_regex(t, '\\n *\\n[ \\n]*') as p from normal where regexp_matches(t, '\\n *\\n'))
  union all
  select doc_id, key, 'w', t from normal where contains(t, chr(10))),
grams as (
  select doc_id, key, place, len(g) as a, unnest(g) as bigram
  from (select doc_id, key, place, {_bigrams("w")} as g from (select doc_id, key, place, {_WORDS.format("s")} as w from segments))),
scored as (
  select doc_id, key, place, template, license, 2.0 * count(*)::double / (a + b) as dice
  from grams join words_in_template using (bigram) group by doc_id, key, place, a, template, license, b),
best as (select * from scored where dice >= 0.8 qualify row_number() over (partition by doc_id, key, place order by dice desc, license) = 1)
select doc_id, license, max(dice) as dice, count(*) as n_segments from best group by doc_id, if(doc_id is null, key, null), license"""


@query("op10_license_scan", LICENSE_SQL)
def op10_license_scan(spark, folder):
    return licenses.license_matches(table(spark, folder, "documents"))


MIX = {
    "lang_targets": {"en": 0.4, "de": 0.2, "es": 0.2, "fr": 0.2},
    "topic_targets": {"prose": 0.7, "table": 0.1, "shouting": 0.1, "notice": 0.1},
    "source_power": 0.5,
    "keep": 0.5,
    "iterations": 12,
    "cap_rounds": 6,
}


def _values(shares, name):
    return f"{name}(k, v) as (values {', '.join(f"('{k}', {v}::double)" for k, v in shares.items())})"


def mixing_sql(iterations, cap_rounds, source_power, keep, lang_targets, topic_targets):
    """Raking with its steps written out one after the other."""
    steps = []
    for i in range(iterations + 1):
        b, c = (f"b{i}", f"c{i}") if i else ("ones", "ones")
        steps.append(
            f"""a{i} as materialized (select source, max(pow(total, {source_power})) / max(powers) / sum(n * b.w * c.w) as w
  from cells join {b} b on b.k = lang join {c} c on c.k = topic join totals using (source) cross join everything group by source)"""
        )
        if i < iterations:
            steps.append(f"m{i} as materialized (select lang, topic, sum(w * n) as n from cells join a{i} using (source) group by all)")
            steps.append(
                f"b{i + 1} as materialized (select lang as k, max(v) / sum(n * c.w) as w from m{i} join {c} c on c.k = topic join lang_share s on s.k = lang group by lang)"
            )
            steps.append(
                f"c{i + 1} as materialized (select topic as k, max(v) / sum(n * b.w) as w from m{i} join b{i + 1} b on b.k = lang join topic_share s on s.k = topic group by topic)"
            )
    b, c = f"b{iterations}", f"c{iterations}"
    steps.append(
        f"weights as materialized (select source, lang, topic, n, a.w * b.w * c.w as w from cells join a{iterations} a using (source) join {b} b on b.k = lang join {c} c on c.k = topic)"
    )
    steps.append("scale0 as (select 0.0::double as s)")
    for i in range(cap_rounds):
        steps.append(
            f"""scale{i + 1} as materialized (select greatest(max(s), ({keep} * max(all_n) - sum(if(w * s >= 1, weights.n, 0)))
  / sum(if(w * s >= 1, 0, weights.n * w))) as s from weights cross join scale{i} cross join everything)"""
        )
    topic = """case when contains(coalesce(text, ''), ' | ') then 'table' when contains(coalesce(text, ''), '!!') then 'shouting'
    when contains(coalesce(text, ''), 'License') or contains(coalesce(text, ''), 'Licensed under') then 'notice' else 'prose' end"""
    return f"""
with {_values(lang_targets, "lang_given")}, {_values(topic_targets, "topic_given")},
keyed as materialized (
  select doc_id, coalesce(source, 'none') as source, coalesce(lang, 'none') as lang, {topic} as topic,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::double as tokens from documents),
cells as materialized (select source, lang, topic, sum(tokens) as n from keyed group by all having sum(tokens) > 0),
totals as (select source, sum(n) as total from cells group by source),
everything as (select sum(total) as all_n, sum(pow(total, {source_power})) as powers from totals),
ones as (select distinct lang as k, 1.0::double as w from cells union select distinct topic, 1.0 from cells),
lang_raw as (select k, coalesce(v, (select min(v) from lang_given)) as v from (select distinct lang as k from cells) left join lang_given using (k)),
lang_share as (select k, v / (select sum(v) from lang_raw) as v from lang_raw),
topic_raw as (select k, coalesce(v, (select min(v) from topic_given)) as v from (select distinct topic as k from cells) left join topic_given using (k)),
topic_share as (select k, v / (select sum(v) from topic_raw) as v from topic_raw),
{", ".join(steps)}
select doc_id, source, lang, topic, tokens::bigint as n_tokens, round(coalesce(w, 0) * (select all_n from everything), 6) as weight,
  round(least(1.0, coalesce(w, 0) * s), 9) as probability,
  ('0x' || substr(md5('mix:' || doc_id), 1, 13))::bigint / pow(2, 52) < coalesce(least(1.0, coalesce(w, 0) * s), 0) as kept
from keyed left join (select source, lang, topic, w from weights) using (source, lang, topic) cross join scale{cap_rounds}"""


@query("op6_mixing_weights", mixing_sql(**MIX))
def op6_mixing_weights(spark, folder):
    return mixing.raked(table(spark, folder, "documents"), **MIX).select(
        "_row.doc_id",
        F.col("_source").alias("source"),
        F.col("_lang").alias("lang"),
        F.col("_topic").alias("topic"),
        F.col("_tokens").cast("long").alias("n_tokens"),
        F.round("_weight", 6).alias("weight"),
        F.round("_probability", 9).alias("probability"),
        F.col("_kept").alias("kept"),
    )


WARC_SQL = """
with plain as (select page_id, strlen(coalesce(html, '')) as n, sha1(coalesce(html, '')) as h from pages),
first as (select h, n, max(page_id) as keeper from plain where page_id is not null group by h, n)
select page_id, n::bigint as payload_bytes,
  array_to_string(list_transform(range(0, 8), lambda i: list_reduce(list_transform([15, 10, 5, 0],
    lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, 5 * i + 1, 5))::bigint >> s) & 31)::int + 1, 1)),
    lambda a, b: a || b)), '') as payload_digest,
  if(keeper is null or page_id is null or page_id = keeper, 'response', 'revisit') as record_type,
  if(page_id <> keeper, keeper, null) as refers_to
from plain left join first using (h, n)"""


@query("op8_warc_archive", WARC_SQL)
def op8_warc_archive(spark, folder):
    manifest = warc.write_archives(table(spark, folder, "pages"))
    return warc.read_pages(warc.read_chunks(manifest, with_data=False))
