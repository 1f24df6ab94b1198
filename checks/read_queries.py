"""Read processing."""

from pyspark.sql import functions as F

from biomesheaf.functions import sequences as sq
from biomesheaf.functions.joins import settled
from biomesheaf.operators import reads as rd
from biomesheaf.plans import clean_reads

from .registry import SQL_VIEWS, check, rounded

KEY = "sample, pair_id, mate"


# ---- SQL spellings of the trimming steps, as views over any reads view


def qtrim_sql(src, cutoff=10):
    return f"""
select r.sample, r.pair_id, r.mate, substr(r.seq, 1, length(r.seq) - coalesce(d.cut, 0)) as seq,
  substr(r.qual, 1, length(r.qual) - coalesce(d.cut, 0)) as qual
from {src} r left join (
  select {KEY}, min(j) as cut from (
    select *, max(tot) over (partition by {KEY}) as best from (
      select *, sum(case when tot < 0 then 1 else 0 end) over (partition by {KEY} order by j) as neg from (
        select *, sum({cutoff} - (ascii(substr(qual, length(qual) - j + 1, 1)) - 33)) over (partition by {KEY} order by j) as tot
        from (select {KEY}, qual, cast(unnest(range(1, length(qual) + 1)) as int) as j from {src})))
    where neg = 0 and tot > 0)
  where tot = best group by {KEY}) d using ({KEY})"""


def atrim_sql(src):
    return f"""
select r.sample, r.pair_id, r.mate, substr(r.seq, 1, coalesce(h.cut, length(r.seq))) as seq,
  substr(r.qual, 1, coalesce(h.cut, length(r.qual))) as qual
from {src} r left join (
  select {KEY}, min(s) as cut from (
    select c.*, least(length(a.seq), length(c.seq) - s) as ov, a.seq as aseq
    from (select {KEY}, seq, cast(unnest(range(0, length(seq) - 2)) as int) as s from {src}) c, adapters_v a)
  where hamming(substr(seq, s + 1, ov), substr(aseq, 1, ov)) <= floor(ov / 10.0)
  group by {KEY}) h using ({KEY})"""


def screen_hits_sql(src, k=31):
    return f"""
select distinct r.sample, r.pair_id, r.mate, a.ref_id
from (select {KEY}, substr(seq, cast(unnest(range(1, length(seq) - {k} + 2)) as int), {k}) as kmer from {src}) r
join (
  select distinct ref_id, substr(s, cast(unnest(range(1, length(s) - {k} + 2)) as int), {k}) as kmer
  from (select ref_id, seq as s from artifacts_v union all
        select ref_id, translate(reverse(seq), 'ACGT', 'TGCA') from artifacts_v)) a
on hamming(r.kmer, a.kmer) <= 1 and r.kmer not like '%N%'"""


def pair_filter_sql(src, min_len=50):
    return f"""
select * from {src} where (sample, pair_id) not in (
  select (sample, pair_id) from {src} where length(seq) < {min_len})"""


SQL_VIEWS.update(
    {
        "qtrimmed_v": qtrim_sql("reads_v"),
        "atrimmed_v": atrim_sql("reads_v"),
        "qa_trimmed_v": atrim_sql("qtrimmed_v"),
        "screen_hits_v": screen_hits_sql("reads_v"),
        "chain_hits_v": screen_hits_sql("atrimmed_v"),
        "chain_filtered_v": """
select r.* from atrimmed_v r
where not exists (select 1 from chain_hits_v h where h.sample = r.sample and h.pair_id = r.pair_id)""",
        "chain_q_v": qtrim_sql("chain_filtered_v"),
        "chain_qtrimmed_v": pair_filter_sql("chain_q_v"),
        "pairs_v": """
select a.sample, a.pair_id, a.seq as seq1, a.qual as qual1, b.seq as seq2, b.qual as qual2
from reads_v a join reads_v b on a.sample = b.sample and a.pair_id = b.pair_id and a.mate = 1 and b.mate = 2""",
        "overlap_v": """
select sample, pair_id, seq1, qual1, rc2, rq2, max(ov) as ov from (
  select *, cast(unnest(range(12, least(length(seq1), length(rc2)) + 1)) as int) as ov
  from (select *, translate(reverse(seq2), 'ACGT', 'TGCA') as rc2, reverse(qual2) as rq2 from pairs_v))
where hamming(substr(seq1, length(seq1) - ov + 1, ov), substr(rc2, 1, ov)) <= floor(ov * 5 / 100.0)
group by sample, pair_id, seq1, qual1, rc2, rq2""",
        "merged_v": """
select sample, pair_id, ov as overlap,
  concat(any_value(before_s), string_agg(case when q1 >= q2 then b1 else b2 end, '' order by i), any_value(after_s)) as seq,
  concat(any_value(before_q), string_agg(case when q1 >= q2 then q1 else q2 end, '' order by i), any_value(after_q)) as qual
from (
  select *, substr(seq1, 1, length(seq1) - ov) as before_s, substr(qual1, 1, length(qual1) - ov) as before_q,
    substr(rc2, ov + 1) as after_s, substr(rq2, ov + 1) as after_q,
    substr(seq1, length(seq1) - ov + i, 1) as b1, substr(rc2, i, 1) as b2,
    substr(qual1, length(qual1) - ov + i, 1) as q1, substr(rq2, i, 1) as q2
  from (select *, cast(unnest(range(1, ov + 1)) as int) as i from overlap_v))
group by sample, pair_id, ov""",
    }
)

CANON = "least(kmer, translate(reverse(kmer), 'ACGT', 'TGCA'))"


@check(
    "verify_pairs",
    """
select sample, pair_id, count(*) as reads, cast(sum(case when mate = 1 then 1 else 0 end) as bigint) as mate1,
  cast(sum(case when mate = 2 then 1 else 0 end) as bigint) as mate2
from reads_v where seq not like '%AGATCGGAAGAGCACACGTC' group by sample, pair_id
having count(*) <> 2 or sum(case when mate = 1 then 1 else 0 end) <> 1 or sum(case when mate = 2 then 1 else 0 end) <> 1""",
)
def _(v):
    return rd.verify_pairs(v.reads_v.filter(~F.col("seq").endswith("AGATCGGAAGAGCACACGTC")))


@check("interleave", "select sample, pair_id, mate, seq, qual from reads_v")
def _(v):
    reads = v.reads_v
    return rd.interleave(reads.filter("mate = 1"), reads.filter("mate = 2"))


@check("deinterleave", "select * from pairs_v")
def _(v):
    return rd.deinterleave(v.reads_v)


@check("trim_adapters", f"select {KEY}, seq, qual from atrimmed_v")
def _(v):
    return rd.trim_adapters(v.reads_v, v.adapters_v)


@check("quality_trim", f"select {KEY}, seq, qual from qtrimmed_v")
def _(v):
    return rd.quality_trim(v.reads_v)


@check("filter_pairs_by_length", f"select {KEY}, seq, qual from ({pair_filter_sql('qtrimmed_v', 62)})")
def _(v):
    return rd.filter_pairs_by_length(rd.quality_trim(v.reads_v), 62)


@check("trim_and_filter", f"select {KEY}, seq, qual from ({pair_filter_sql('qa_trimmed_v')})")
def _(v):
    return rd.trim_and_filter(v.reads_v, v.adapters_v)


@check(
    "kmer_screen",
    """
select r.sample, r.pair_id, r.mate, r.seq,
  exists (select 1 from screen_hits_v h where h.sample = r.sample and h.pair_id = r.pair_id) as removed
from reads_v r""",
)
def _(v):
    kept, removed = rd.kmer_screen(v.reads_v, v.artifacts_v)
    tagged = kept.withColumn("removed", F.lit(False)).unionByName(removed.withColumn("removed", F.lit(True)))
    return tagged.drop("qual")


@check(
    "kmer_screen_stats",
    """
select h.sample, h.ref_id, h.reads, round(100.0 * h.reads / t.total, 6) as percent
from (select sample, ref_id, count(*) as reads from screen_hits_v group by sample, ref_id) h
join (select sample, count(*) as total from reads_v group by sample) t on t.sample = h.sample""",
)
def _(v):
    return rounded(rd.kmer_screen_stats(v.reads_v, v.artifacts_v), "percent")


@check(
    "kmer_cardinality",
    f"""
select sample, count(distinct {CANON}) as kmers, true as within_bound from (
  select sample, substr(seq, cast(unnest(range(1, length(seq) - 29)) as int), 31) as kmer from reads_v)
where kmer not like '%N%' group by sample""",
)
def _(v):
    """The estimate against the exact count; three times its standard error is allowed."""
    rsd = 0.05
    exact = sq.explode_kmers(v.reads_v, 31, "sample", canonical=True, as_numbers=True).groupBy("sample").agg(F.count_distinct("kmer").alias("exact"))
    both = rd.kmer_cardinality(v.reads_v, rsd=rsd).join(exact, "sample")
    within = F.abs(F.col("kmers") - F.col("exact")) <= 3 * rsd * F.col("exact")
    return both.select("sample", F.col("exact").alias("kmers"), within.alias("within_bound"))


@check(
    "cohort_cardinality",
    f"""
with w as (select sample, {CANON} as kmer from (
    select sample, substr(seq, cast(unnest(range(1, length(seq) - 29)) as int), 31) as kmer from reads_v) where kmer not like '%N%')
select cohort, count(distinct sample) as samples, count(distinct kmer) as kmers, true as within_bound
from (select case when sample < 'p' then 'early' else 'late' end as cohort, * from w) group by cohort""",
)
def _(v):
    """Stored sketches united by cohort, against the exact count; three standard errors are allowed."""
    cohort = F.when(F.col("sample") < "p", "early").otherwise("late").alias("cohort")
    exact = sq.explode_kmers(v.reads_v.select("*", cohort), 31, "cohort", canonical=True, as_numbers=True).groupBy("cohort").agg(F.count_distinct("kmer").alias("exact"))
    kept = settled(rd.cardinality_sketches(v.reads_v), "sketches")
    both = rd.cohort_cardinality(kept.select("*", cohort), "cohort").join(exact, "cohort")
    within = F.abs(F.col("kmers") - F.col("exact")) <= 3 * 0.8 / 64 * F.col("exact")
    return both.select("cohort", "samples", F.col("exact").alias("kmers"), within.alias("within_bound"))


@check(
    "toss_low_depth_reads",
    f"""
with w as (select sample, pair_id, {CANON} as kmer from (
    select sample, pair_id, substr(seq, cast(unnest(range(1, length(seq) - 30)) as int), 32) as kmer from reads_v)
  where kmer not like '%N%'),
low as (select sample, kmer from w group by sample, kmer having count(*) <= 4),
bad as (select distinct w.sample, w.pair_id from w join low on low.sample = w.sample and low.kmer = w.kmer)
select r.sample, r.pair_id, r.mate, r.seq from reads_v r
where not exists (select 1 from bad b where b.sample = r.sample and b.pair_id = r.pair_id)""",
)
def _(v):
    return rd.toss_low_depth_reads(v.reads_v).drop("qual")


@check(
    "unaligned_pairs",
    """
select sample, qname as pair_id, case when flag & 128 = 128 then 2 when flag & 64 = 64 then 1 end as mate, seq
from hits_v where flag & 12 = 12 and flag & 2304 = 0""",
)
def _(v):
    return rd.unaligned_pairs(v.hits_v)


@check(
    "drop_sequences_by_id",
    "select ref_id, seq from host_v where ref_id not in ('chrEBV', 'chrM')",
)
def _(v):
    return rd.drop_sequences_by_id(v.host_v)


@check(
    "subsample",
    f"""
select {KEY}, seq from reads_v
where cast('0x' || substr(md5('1:' || cast(pair_id as varchar)), 1, 8) as bigint) < 0.05 * 4294967296""",
)
def _(v):
    return rd.subsample(v.reads_v, 0.05, how="md5").drop("qual")


@check(
    "track_reads",
    """
select a.sample, a.n as input, b.n as no_adapter, coalesce(c.n, 0) as filtered, coalesce(c.n, 0) as decontaminated, coalesce(d.n, 0) as qtrimmed
from (select sample, count(*) as n from reads_v group by sample) a
join (select sample, count(*) as n from atrimmed_v group by sample) b on b.sample = a.sample
left join (select sample, count(*) as n from chain_filtered_v group by sample) c on c.sample = a.sample
left join (select sample, count(*) as n from chain_qtrimmed_v group by sample) d on d.sample = a.sample""",
)
def _(v):
    return rd.track_reads(clean_reads(v.reads_v, v.adapters_v, v.artifacts_v))


@check(
    "clean_reads",
    f"select {KEY}, seq, qual from chain_qtrimmed_v",
)
def _(v):
    return clean_reads(v.reads_v, v.adapters_v, v.artifacts_v)["qtrimmed"]


@check("merge_overlapping_pairs", "select * from merged_v")
def _(v):
    return rd.merge_overlapping_pairs(v.reads_v)[0]


@check(
    "unmerged_pairs",
    """
select r.sample, r.pair_id, r.mate, r.seq, r.qual from reads_v r
where not exists (select 1 from merged_v m where m.sample = r.sample and m.pair_id = r.pair_id)""",
)
def _(v):
    return rd.merge_overlapping_pairs(v.reads_v)[1]


@check(
    "insert_size_histogram",
    "select sample, cast(length(seq) as int) as insert_size, count(*) as pairs from merged_v group by 1, 2",
)
def _(v):
    return rd.insert_size_histogram(rd.merge_overlapping_pairs(v.reads_v)[0])


@check(
    "read_qc_summary",
    """
select sample, count(*) as reads, cast(sum(length(seq)) as bigint) as bases,
  round(100.0 * sum(length(seq) - length(replace(replace(seq, 'G', ''), 'C', ''))) / sum(length(seq)), 6) as gc_percent,
  round(100.0 * sum(length(seq) - length(replace(seq, 'N', ''))) / sum(length(seq)), 6) as n_percent,
  round(1.0 - cast(count(distinct seq) as double) / count(*), 6) as duplicate_fraction
from reads_v group by sample""",
)
def _(v):
    return rounded(rd.qc_summary(v.reads_v), "gc_percent", "n_percent", "duplicate_fraction")


@check(
    "read_qc_length",
    "select sample, cast(length(seq) as int) as length, count(*) as reads from qtrimmed_v group by 1, 2",
)
def _(v):
    return rd.qc_length_distribution(rd.quality_trim(v.reads_v))


@check(
    "read_qc_position_quality",
    """
with q as (select sample, mate, cast(unnest(range(1, length(qual) + 1)) as int) as position, qual from reads_v),
c as (select sample, mate, position, ascii(substr(qual, position, 1)) - 33 as q, count(*) as n from q group by all),
s as (select *, sum(n) over (partition by sample, mate, position order by q) as cum, sum(n) over (partition by sample, mate, position) as total from c)
select sample, mate, position, round(cast(sum(q * n) as double) / sum(n), 6) as mean_quality,
  min(case when cum >= total * 0.25 then q end) as q1, min(case when cum >= total * 0.5 then q end) as median,
  min(case when cum >= total * 0.75 then q end) as q3
from s group by sample, mate, position""",
)
def _(v):
    return rounded(rd.qc_position_quality(v.reads_v), "mean_quality")


@check(
    "read_qc_mean_quality",
    f"""
with q as (select {KEY}, qual, cast(unnest(range(1, length(qual) + 1)) as int) as i from reads_v),
m as (select {KEY}, cast(floor(cast(sum(ascii(substr(qual, i, 1)) - 33) as double) / count(*)) as int) as mean_quality from q group by {KEY})
select sample, mean_quality, count(*) as reads from m group by 1, 2""",
)
def _(v):
    return rd.qc_mean_quality_histogram(v.reads_v)


@check(
    "read_qc_overrepresented",
    """
select c.sample, c.seq, c.reads, round(100.0 * c.reads / t.total, 6) as percent
from (select sample, seq, count(*) as reads from reads_v group by 1, 2) c
join (select sample, count(*) as total from reads_v group by 1) t on t.sample = c.sample
where c.reads > t.total * 0.001""",
)
def _(v):
    return rounded(rd.qc_overrepresented(v.reads_v), "percent")
