"""Alignments, coverage, abundance, assemblies."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from biomesheaf.operators import alignments as al
from biomesheaf.plans import gene_abundance
from biomesheaf.session import scratch_path

from .registry import SQL_VIEWS, check, rounded

CANON = "least(kmer, translate(reverse(kmer), 'ACGT', 'TGCA'))"
MAPPED = "flag & 4 = 0"

SQL_VIEWS.update(
    {
        "samples_aln_v": "select distinct sample from aln_v",
        "bases_v": "select sample, rname, cast(unnest(range(start0, end0)) as bigint) as p from aln_v",
        "depths_v": "select sample, rname, p, count(*) as depth from bases_v group by 1, 2, 3",
        "hist_ref_v": """
select sample, rname as cds, depth, count(*) as num_bases, 400 as cds_size from depths_v group by 1, 2, 3
union all
select s.sample, c.rname, 0, c.length - coalesce(d.n, 0), c.length
from samples_aln_v s cross join cds_v c
left join (select sample, rname, count(*) as n from depths_v group by 1, 2) d on d.sample = s.sample and d.rname = c.rname
where c.length - coalesce(d.n, 0) > 0""",
        "hist_v": """
select * from hist_ref_v union all
select sample, 'genome', depth, cast(sum(num_bases) as bigint), cast((select sum(length) from cds_v) as bigint)
from hist_ref_v group by sample, depth""",
        "hit_spans_v": f"""
select sample, rname, qname, flag, pos - 1 as start0, pos + 63 as end0, base_quality_sum, cigar, pos, seq from hits_v where {MAPPED}""",
        "dedup_v": """
select * from hits_v where flag & 4 = 4 or flag & 2304 > 0
union all
select * exclude (rk) from (
  select *, row_number() over (
    partition by sample, rname, case when flag & 16 = 16 then pos + 63 else pos end, flag & 16
    order by base_quality_sum desc, qname) as rk
  from hits_v where flag & 4 = 0 and flag & 2304 = 0) where rk = 1""",
        "counts_v": """
select s.sample, g.gene as gene_id, count(h.qname) as count
from (select distinct sample from hits_v) s cross join genes_v g
left join hit_spans_v h on h.sample = s.sample and h.rname = g.gene and h.start0 < g.gene_length and h.end0 > 0
group by 1, 2""",
        "dedup_counts_v": """
select s.sample, g.gene as gene_id, count(h.qname) as count
from (select distinct sample from hits_v) s cross join genes_v g
left join dedup_v h on h.sample = s.sample and h.rname = g.gene and h.flag & 4 = 0
group by 1, 2""",
    }
)


def tpm_sql(counts):
    return f"""
select c.sample, c.gene_id, round(1e6 * (100.0 * c.count / g.gene_length) / t.total, 6) as tpm
from {counts} c join genes_v g on g.gene = c.gene_id
join (select sample, sum(100.0 * count / gene_length) as total from {counts} join genes_v on gene = gene_id group by 1) t on t.sample = c.sample"""


def intervals(v):
    return v.genes_v.select(
        F.col("gene").alias("rname"), F.lit(0).cast("bigint").alias("start"), F.col("gene_length").cast("bigint").alias("end")
    )


def lengths(v):
    return v.genes_v.select(F.col("gene").alias("gene_id"), "gene_length")


def header(v, alignments):
    return al.cohort_ref_lengths(
        v.genes_v.select(F.col("gene").alias("rname"), F.col("gene_length").alias("length")), alignments
    )


@check("sort_by_coordinate", "select sample, rname, pos, qname, flag from hits_v")
def _(v):
    return al.sort_by_coordinate(v.hits_v.select("sample", "rname", "pos", "qname", "flag"))


@check(
    "sort_by_coordinate_order",
    """
select sample, rname, pos, qname, flag,
  row_number() over (partition by sample, rname order by pos, qname) as order_no
from hits_v""",
)
def _(v):
    """The number each row has within its reference, in the order in which the rows come."""
    ordered = al.sort_by_coordinate(v.hits_v.select("sample", "rname", "pos", "qname", "flag"), 16)
    as_they_come = Window.partitionBy("sample", "rname").orderBy("at")
    return ordered.withColumn("at", F.monotonically_increasing_id()).withColumn("order_no", F.row_number().over(as_they_come)).drop("at")


@check("remove_duplicates", "select sample, qname, flag, rname, pos from dedup_v")
def _(v):
    kept = al.remove_duplicates(v.hits_v, F.col("base_quality_sum"))
    return kept.select("sample", "qname", "flag", "rname", "pos")


@check(
    "duplicate_metrics",
    """
select e.sample, e.n as examined, e.n - k.n as duplicates, round(1.0 * (e.n - k.n) / e.n, 6) as duplicate_fraction
from (select sample, count(*) as n from hits_v where flag & 4 = 0 and flag & 2304 = 0 group by 1) e
join (select sample, count(*) as n from dedup_v where flag & 4 = 0 and flag & 2304 = 0 group by 1) k on k.sample = e.sample""",
)
def _(v):
    return rounded(al.duplicate_metrics(v.hits_v, F.col("base_quality_sum")), "duplicate_fraction")


@check(
    "coverage_histogram",
    "select sample, cds, depth, num_bases, cast(cds_size as bigint) as cds_size, round(1.0 * num_bases / cds_size, 6) as frac from hist_v",
)
def _(v):
    aln = v.aln_v
    return rounded(al.coverage_histogram(aln, al.cohort_ref_lengths(v.cds_v, aln)), "frac")


@check(
    "coverage_depth_distribution",
    "select sample, depth, cast(sum(num_bases) as bigint) as num_bases from hist_ref_v group by 1, 2",
)
def _(v):
    aln = v.aln_v
    return al.coverage_depth_distribution(al.coverage_histogram(aln, al.cohort_ref_lengths(v.cds_v, aln)))


@check("count_reads_per_interval", "select * from counts_v")
def _(v):
    return al.count_reads_per_interval(v.hits_v, intervals(v))


@check(
    "count_reads_in_windows",
    """
with w as (select gene as rname, concat(gene, ':', cast(s as varchar)) as gene_id, s as w_start, least(s + 50, gene_length) as w_end
  from (select gene, gene_length, cast(unnest(range(0, gene_length, 50)) as bigint) as s from genes_v))
select s.sample, w.gene_id, count(h.qname) as count
from (select distinct sample from hits_v) s cross join w
left join hit_spans_v h on h.sample = s.sample and h.rname = w.rname and h.start0 < w.w_end and h.end0 > w.w_start
group by 1, 2""",
)
def _(v):
    windows = v.genes_v.select(
        F.col("gene").alias("rname"),
        F.col("gene_length").cast("bigint").alias("len"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("gene_length") - 1, F.lit(50).cast("bigint"))).alias("start"),
    ).select(
        "rname",
        F.concat("rname", F.lit(":"), F.col("start").cast("string")).alias("gene_id"),
        "start",
        F.least(F.col("start") + 50, F.col("len")).alias("end"),
    )
    # A bin narrower than a read makes spans cross bins.
    return al.count_reads_per_interval(v.hits_v, windows, bin_width=32)


@check("tpm", tpm_sql("counts_v"))
def _(v):
    return rounded(al.tpm(al.count_reads_per_interval(v.hits_v, intervals(v)), lengths(v)), "tpm")


@check(
    "tpm_wide",
    f"""
select gene_id, max(tpm) filter (sample = 'click') as click, max(tpm) filter (sample = 'error') as error,
  max(tpm) filter (sample = 'purchase') as purchase, max(tpm) filter (sample = 'signup') as signup,
  max(tpm) filter (sample = 'view') as "view"
from ({tpm_sql("counts_v")}) group by gene_id""",
)
def _(v):
    long = rounded(al.tpm(al.count_reads_per_interval(v.hits_v, intervals(v)), lengths(v)), "tpm")
    return al.tpm_wide(long, ["click", "error", "purchase", "signup", "view"])


@check("gene_abundance", tpm_sql("dedup_counts_v"))
def _(v):
    return rounded(gene_abundance(v.hits_v, intervals(v), lengths(v), F.col("base_quality_sum")), "tpm")


@check(
    "contig_coverage_stats",
    """
with s as (select distinct sample from hits_v),
b as (select sample, rname, count(*) as bases, count(distinct p) as covered from (
  select sample, rname, cast(unnest(range(start0, end0)) as bigint) as p from hit_spans_v) group by 1, 2),
r as (select sample, rname, count(*) as reads, cast(sum(case when flag & 16 = 0 then 1 else 0 end) as bigint) as plus_reads,
  cast(sum(case when flag & 16 = 16 then 1 else 0 end) as bigint) as minus_reads from hit_spans_v group by 1, 2)
select s.sample, g.gene as contig, cast(g.gene_length as bigint) as length, round(1.0 * coalesce(b.bases, 0) / g.gene_length, 6) as avg_depth,
  coalesce(b.covered, 0) as covered_bases, round(100.0 * coalesce(b.covered, 0) / g.gene_length, 6) as covered_percent,
  coalesce(r.reads, 0) as reads, coalesce(r.plus_reads, 0) as plus_reads, coalesce(r.minus_reads, 0) as minus_reads
from s cross join genes_v g
left join b on b.sample = s.sample and b.rname = g.gene
left join r on r.sample = s.sample and r.rname = g.gene""",
)
def _(v):
    hits = v.hits_v
    return rounded(al.contig_coverage_stats(hits, header(v, hits)), "avg_depth", "covered_percent")


@check(
    "split_by_alignment",
    """
with m as (select distinct sample, qname from hits_v where flag & 4 = 0 and 1.0 - nm / 64.0 >= 0.98)
select r.sample, r.pair_id, r.mate, m.qname is not null as mapped
from reads_v r left join m on m.sample = r.sample and m.qname = r.pair_id""",
)
def _(v):
    mapped, unmapped = al.split_by_alignment(v.reads_v, v.hits_v, 0.98)
    both = mapped.withColumn("mapped", F.lit(True)).unionByName(unmapped.withColumn("mapped", F.lit(False)))
    return both.drop("seq", "qual")


@check(
    "assembly_stats",
    """
with l as (select sample, assembler, ref_id, length(seq) as len, seq from contigs_v),
c as (select *, sum(len) over (partition by sample, assembler order by len desc, ref_id) as cum,
  row_number() over (partition by sample, assembler order by len desc, ref_id) as rk,
  sum(len) over (partition by sample, assembler) as total from l)
select sample, assembler, count(*) as contigs, count(*) as contigs_0,
  cast(sum(case when len >= 200 then 1 else 0 end) as bigint) as contigs_200,
  cast(max(total) as bigint) as total_length, max(len) as largest,
  round(100.0 * sum(length(seq) - length(replace(replace(seq, 'G', ''), 'C', ''))) / (max(total) - sum(length(seq) - length(replace(seq, 'N', '')))), 6) as gc_percent,
  max(case when cum >= total * 0.5 then len end) as n50, min(case when cum >= total * 0.5 then rk end) as l50,
  max(case when cum >= total * 0.75 then len end) as n75, min(case when cum >= total * 0.75 then rk end) as l75,
  round(100000.0 * sum(length(seq) - length(replace(seq, 'N', ''))) / max(total), 6) as n_per_100kbp
from c group by sample, assembler""",
)
def _(v):
    return rounded(al.assembly_stats(v.contigs_v, (0, 200)), "gc_percent", "n_per_100kbp")


@check("count_sequences", "select sample, assembler, count(*) as sequences from contigs_v group by 1, 2")
def _(v):
    return al.count_sequences(v.contigs_v, ("sample", "assembler"))


@check(
    "sketch_top_hits",
    f"""
with qk as (select distinct sample, md5({CANON}) as hash from (
    select sample, substr(seq, cast(unnest(range(1, length(seq) - 29)) as int), 31) as kmer from contigs_v) where kmer not like '%N%'),
q as (select * from (select *, row_number() over (partition by sample order by hash) as rk from qk) where rk <= 1000),
tk as (select distinct ref_id, md5({CANON}) as hash from (
    select gene as ref_id, substr(gene_seq, cast(unnest(range(1, length(gene_seq) - 29)) as int), 31) as kmer from genes_v)),
t as (select * from (select *, row_number() over (partition by ref_id order by hash) as rk from tk) where rk <= 1000),
s as (select q.sample, t.ref_id, count(*) as shared from q join t on q.hash = t.hash group by 1, 2),
r as (select *, row_number() over (partition by sample order by shared desc, ref_id) as rank from s)
select sample, ref_id, shared, rank, round(shared / 1000.0, 6) as similarity from r where rank <= 50""",
)
def _(v):
    return rounded(al.sketch_top_hits(v.contigs_v, kept_references(v), hash_of=F.md5), "similarity")


def kept_references(v):
    """The references' sketches as a stored table that is filled in two goes."""
    path = scratch_path(v.spark, "sketches")
    refs = v.genes_v.select(F.col("gene").alias("ref_id"), F.col("gene_seq").alias("seq"))
    al.keep_sketches(refs.filter(F.substring("ref_id", -1, 1) == "7"), path, "ref_id", hash_of=F.md5)
    return al.keep_sketches(refs, path, "ref_id", hash_of=F.md5)


@check(
    "sketch_similarity",
    f"""
with qk as (select distinct sample, md5({CANON}) as hash from (
    select sample, substr(seq, cast(unnest(range(1, length(seq) - 29)) as int), 31) as kmer from contigs_v) where kmer not like '%N%'),
q as (select * from (select *, row_number() over (partition by sample order by hash) as rk from qk) where rk <= 1000),
tk as (select distinct ref_id, md5({CANON}) as hash from (
    select gene as ref_id, substr(gene_seq, cast(unnest(range(1, length(gene_seq) - 29)) as int), 31) as kmer from genes_v)),
t as (select * from (select *, row_number() over (partition by ref_id order by hash) as rk from tk) where rk <= 1000),
p as (select q.sample, t.ref_id, count(*) as shared from q join t on q.hash = t.hash group by 1, 2),
u as (select sample, ref_id, hash, count(*) as n from (
    select p.sample, p.ref_id, q.hash from p join q on q.sample = p.sample union all
    select p.sample, p.ref_id, t.hash from p join t on t.ref_id = p.ref_id) group by 1, 2, 3),
b as (select *, row_number() over (partition by sample, ref_id order by hash) as rk from u)
select sample, ref_id, any_value(shared) as shared, round(1.0 * count(*) filter (n = 2) / count(*), 6) as similarity
from b join p using (sample, ref_id) where rk <= 1000 group by 1, 2""",
)
def _(v):
    found = al.sketch_similarity(al.sketches(v.contigs_v, "sample", hash_of=F.md5), kept_references(v), "sample", "ref_id")
    return rounded(found, "similarity")
