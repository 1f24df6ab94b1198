"""Classification, reports, richness; resistome; cohort summaries."""

from pyspark.sql import functions as F

from biomesheaf import plans
from biomesheaf.operators import cohort as co
from biomesheaf.operators import resistome as rs
from biomesheaf.operators import taxonomy as tx
from biomesheaf.session import scratch_path
from biomesheaf.sources.sinks import materialize_if_absent

from .alignment_queries import CANON
from .registry import SQL_VIEWS, check, rounded

K = 21

SQL_VIEWS.update(
    {
        # every taxon with itself and its ancestors; pos counts from the root
        "clo_v": """
select tax_id, 1 as anc, 0 as pos from tax_v
union all select tax_id, d_id, 1 from lin_v
union all select tax_id, g_id, 2 from lin_v where g_id is not null
union all select tax_id, s_id, 3 from lin_v where s_id is not null""",
        "path_v": "select tax_id, list(anc order by pos) as path from clo_v group by 1",
        "ckdb_v": f"select {CANON} as kmer, min(tax_id) as tax_id from kdb_v group by 1",
        "words_v": f"""
select sample, pair_id, mate, pos, kmer not like '%N%' as plain, {CANON} as kmer from (
  select sample, pair_id, mate, pos, substr(seq, pos + 1, {K}) as kmer from (
    select *, cast(unnest(range(0, length(seq) - {K} + 1)) as int) as pos from reads_v))""",
        "tax_hits_v": """
select w.sample, w.pair_id, k.tax_id, count(*) as n from words_v w join ckdb_v k on k.kmer = w.kmer where w.plain group by 1, 2, 3""",
        "scores_v": """
select h.sample, h.pair_id, h.tax_id, sum(u.n) as score from tax_hits_v h join clo_v c on c.tax_id = h.tax_id
join tax_hits_v u on u.sample = h.sample and u.pair_id = h.pair_id and u.tax_id = c.anc group by 1, 2, 3""",
        "best_v": "select * from (select *, max(score) over (partition by sample, pair_id) as top from scores_v) where score = top",
        "lca_v": """
select sample, pair_id, arg_max(anc, pos) as tax_id from (
  select b.sample, b.pair_id, c.anc, c.pos, count(*) as n from best_v b join clo_v c on c.tax_id = b.tax_id group by all) x
join (select sample, pair_id, count(*) as leaves from best_v group by 1, 2) l using (sample, pair_id)
where n = leaves group by 1, 2""",
        "called_v": """
select r.sample, case when l.tax_id is null then 'U' else 'C' end as status, r.pair_id as read_id, coalesce(l.tax_id, 0) as tax_id, r.length
from (select sample, pair_id, cast(sum(length(seq)) as bigint) as length from reads_v group by 1, 2) r
left join lca_v l on l.sample = r.sample and l.pair_id = r.pair_id""",
        # gene coverage of the resistance hits
        "gene_hits_v": """
select h.sample, h.rname as gene, h.hits, c.covered, g.gene_length from (
  select sample, rname, count(*) as hits from hits_v where flag & 4 = 0 group by 1, 2) h
join (select sample, rname, count(distinct p) as covered from (
  select sample, rname, cast(unnest(range(pos - 1, pos + 63)) as bigint) as p from hits_v where flag & 4 = 0) group by 1, 2) c
  on c.sample = h.sample and c.rname = h.rname
join genes_v g on g.gene = h.rname""",
        "passing_v": "select * from gene_hits_v where covered * 100 >= gene_length * 70",
        "levels_v": """
select sample, level, name, cast(sum(hits) as bigint) as hits from (
  select p.sample, p.hits, unnest(['gene', 'group', 'mechanism', 'class']) as level, unnest([g.gene, g.grp, g.mechanism, g.class]) as name
  from passing_v p join genes_v g on g.gene = p.gene) group by 1, 2, 3""",
    }
)


def report_sql(cls):
    return f"""
with d as (select sample, tax_id, count(*) as n from {cls} group by 1, 2),
c as (select d.sample, o.anc as tax_id, cast(sum(d.n) as bigint) as clade_reads,
    cast(sum(case when o.anc = d.tax_id then d.n else 0 end) as bigint) as direct_reads
  from d join clo_v o on o.tax_id = d.tax_id group by 1, 2),
a as (select c.sample, p.path, c.clade_reads, c.direct_reads, t.rank, c.tax_id, t.name
  from c join tax_v t on t.tax_id = c.tax_id join path_v p on p.tax_id = c.tax_id
  union all select sample, [0], n, n, 'U', 0, 'unclassified' from d where tax_id = 0),
s as (select sample, sum(n) as total from d group by 1)
select a.sample, row_number() over (partition by a.sample order by a.path) as line_no, round(100.0 * a.clade_reads / s.total, 6) as pct,
  a.clade_reads, a.direct_reads, a.rank, a.tax_id, a.name
from a join s on s.sample = a.sample"""


def summary_sql(rep, track="track_v"):
    return f"""
with dom as (select sample, min(clade_reads) filter (rank = 'D' and name = 'Bacteria') as bacteria_reads,
  min(clade_reads) filter (rank = 'D' and name = 'Eukaryota') as eukaryota_reads,
  min(clade_reads) filter (rank = 'D' and name = 'Archaea') as archaea_reads,
  min(clade_reads) filter (rank = 'D' and name = 'Viruses') as virus_reads from {rep} group by 1),
rich as (select sample, count(distinct case when dn = 'Bacteria' and rank = 'S' then tax_id end) as bacterial_species from (
  select *, last_value(case when rank = 'D' then name end ignore nulls) over (partition by sample order by line_no) as dn from {rep}) group by 1)
select d.sample, bacteria_reads, eukaryota_reads, archaea_reads, virus_reads, bacterial_species, t.input / 2.0 as input_pairs,
  t.qtrimmed / 2.0 as qtrimmed_pairs, round(100.0 * bacteria_reads / (t.qtrimmed / 2.0), 6) as percent_bacteria
from dom d join rich r on r.sample = d.sample left join {track} t on t.sample = d.sample"""


SQL_VIEWS["report_v"] = report_sql("called_v").replace("with d as", "with d as", 1)


def kmer_db(v):
    """The stored tree, and the k-mer table as a stored database, which is what a classifier is given."""
    path, tree = scratch_path(v.spark, "kmer_db"), tx.lineages(v.tax_v)
    return tree, materialize_if_absent(v.spark, lambda: tx.packed_kmer_db(v.kdb_v, tree, K), path)


def genes(v):
    return v.genes_v.withColumnRenamed("grp", "group")


@check("lineages", "select t.tax_id, array_to_string(p.path, '|') as path, t.name from tax_v t join path_v p on p.tax_id = t.tax_id")
def _(v):
    return tx.lineages(v.tax_v).select("tax_id", F.array_join(F.col("path").cast("array<string>"), "|").alias("path"), "name")


@check("classify_reads", "select * from called_v")
def _(v):
    tree, db = kmer_db(v)
    return tx.classify_reads(v.reads_v, db, tree, K)


@check(
    "kmer_hit_string",
    """
with l as (select w.sample, w.pair_id, w.mate, w.pos, case when not w.plain then 'A' else coalesce(cast(k.tax_id as varchar), '0') end as label
  from words_v w left join ckdb_v k on w.plain and k.kmer = w.kmer),
g as (select *, row_number() over (partition by sample, pair_id, mate order by pos)
    - row_number() over (partition by sample, pair_id, mate, label order by pos) as island from l),
r as (select sample, pair_id, mate, label, island, min(pos) as p0, count(*) as n from g group by 1, 2, 3, 4, 5)
select sample, pair_id, mate, string_agg(label || ':' || cast(n as varchar), ' ' order by p0) as kmer_hits from r group by 1, 2, 3""",
)
def _(v):
    return tx.kmer_hit_string(v.reads_v, kmer_db(v)[1], K)


@check("taxonomy_report", report_sql("cls_v"))
def _(v):
    return rounded(tx.taxonomy_report(v.cls_v, v.tax_v), "pct")


@check("classified_labels", "select sample, read_id, tax_id from cls_v where status = 'C'")
def _(v):
    return tx.classified_labels(v.cls_v)


LABELS = """
select c.sample, c.read_id, concat_ws('|', 'root', d.name, g.name, s.name) as taxonomy
from cls_v c join lin_v l on l.tax_id = c.tax_id left join tax_v d on d.tax_id = l.d_id
left join tax_v g on g.tax_id = l.g_id left join tax_v s on s.tax_id = l.s_id where c.status = 'C'"""


@check("translate_lineage", LABELS)
def _(v):
    return tx.translate_lineage(v.cls_v, v.tax_v)


@check(
    "domain_read_counts",
    """
select sample, min(clade_reads) filter (rank = 'D' and name = 'Bacteria') as bacteria_reads,
  min(clade_reads) filter (rank = 'D' and name = 'Eukaryota') as eukaryota_reads,
  min(clade_reads) filter (rank = 'D' and name = 'Archaea') as archaea_reads,
  min(clade_reads) filter (rank = 'D' and name = 'Viruses') as virus_reads from rep_v group by 1""",
)
def _(v):
    return tx.domain_read_counts(v.rep_v)


@check(
    "bacterial_species_richness",
    """
select sample, count(distinct case when dn = 'Bacteria' and rank = 'S' then tax_id end) as bacterial_species from (
  select *, last_value(case when rank = 'D' then name end ignore nulls) over (partition by sample order by line_no) as dn from rep_v)
group by 1""",
)
def _(v):
    return tx.bacterial_species_richness(v.rep_v)


@check("classification_summary", summary_sql("rep_v"))
def _(v):
    return rounded(tx.classification_summary(v.rep_v, v.track_v), "percent_bacteria")


@check("taxonomy_summary", summary_sql("report_v"))
def _(v):
    tree, db = kmer_db(v)
    return rounded(plans.taxonomy_summary(v.reads_v, db, tree, v.track_v, K), "percent_bacteria")


@check(
    "label_richness",
    f"""
with l as (select sample, count(*) as n, count(distinct taxonomy) as kinds from ({LABELS}) group by 1)
select t.sample, case when t.qtrimmed > 0 then coalesce(l.n, 0) else 0 end as labelled_reads,
  case when t.qtrimmed > 0 then coalesce(l.kinds, 0) else 0 end as richness, t.input as input_reads, t.qtrimmed as qtrimmed_reads,
  round(100.0 * coalesce(l.n, 0) / t.input, 6) as percent_labelled
from track_v t left join l on l.sample = t.sample""",
)
def _(v):
    return rounded(tx.label_richness(tx.translate_lineage(v.cls_v, v.tax_v), v.track_v), "percent_labelled")


@check(
    "classified_read_counts",
    "select sample, count(*) as reads_classified from cls_v where status = 'C' group by 1",
)
def _(v):
    return tx.classified_read_counts(tx.classified_labels(v.cls_v))


# ---------------------------------------------------------------- resistome


@check(
    "gene_fraction_hits",
    """
select sample, gene, hits, covered, cast(gene_length as bigint) as gene_length, round(100.0 * covered / gene_length, 6) as gene_fraction from passing_v""",
)
def _(v):
    return rounded(rs.gene_fraction_hits(v.hits_v, genes(v), 70), "gene_fraction")


@check("resistome_levels", "select * from levels_v")
def _(v):
    return rs.resistome_levels(rs.gene_fraction_hits(v.hits_v, genes(v), 70), genes(v))


@check("resistome_class_table", "select sample, name as class, hits from levels_v where level = 'class'")
def _(v):
    return plans.resistome(v.hits_v, genes(v), genes(v), 70)["class"]


@check(
    "resistome_rarefaction",
    """
with fr as (select cast(unnest(range(5, 101, 5)) as int) as percent), it as (select cast(unnest(range(1, 3)) as int) as iteration),
h as (select h.*, it.iteration, cast('0x' || substr(md5(cast(it.iteration as varchar) || ':' || cast(qname as varchar)), 1, 8) as bigint) as bucket
  from hits_v h, it where flag & 4 = 0),
b as (select sample, iteration, percent, rname, cast(unnest(range(pos - 1, pos + 63)) as bigint) as p from h join fr on bucket < percent * 42949672.96),
g as (select b.sample, b.iteration, b.percent, b.rname from b join genes_v on gene = rname group by 1, 2, 3, 4, gene_length
  having count(distinct p) * 100 >= gene_length * 70),
n as (select sample, iteration, percent, unnest(['gene', 'group', 'mechanism', 'class']) as level, unnest([x.gene, x.grp, x.mechanism, x.class]) as name
  from g join genes_v x on x.gene = g.rname),
lv as (select unnest(['gene', 'group', 'mechanism', 'class']) as level)
select s.sample, it.iteration, fr.percent, lv.level, count(distinct n.name) as names
from (select distinct sample from hits_v) s cross join it cross join fr cross join lv
left join n on n.sample = s.sample and n.iteration = it.iteration and n.percent = fr.percent and n.level = lv.level
group by 1, 2, 3, 4""",
)
def _(v):
    return rs.resistome_rarefaction(v.hits_v, genes(v), genes(v), 70, iterations=2, how="md5")


@check(
    "snp_haplotypes",
    """
with b as (select h.sample, h.rname as gene, h.qname, h.pos + i - 1 as p0, substr(h.seq, i, 1) as alt, substr(g.gene_seq, cast(h.pos + i - 1 as int), 1) as ref
  from (select *, cast(unnest(range(1, 65)) as int) as i from hits_v where flag & 2308 = 0) h join genes_v g on g.gene = h.rname),
p as (select sample, gene, qname, string_agg(cast(p0 as varchar) || ':' || ref || '>' || alt, ';' order by p0) as pattern
  from b where ref <> alt group by 1, 2, 3)
select sample, gene, pattern, count(*) as occurrence from p group by 1, 2, 3""",
)
def _(v):
    return rs.snp_haplotypes(v.hits_v, v.genes_v)


# ---------------------------------------------------------------- cohort


@check("low_yield_samples", "select sample, input from track_v where input < 1000000")
def _(v):
    return co.low_yield_samples(v.track_v)


@check("low_yield_against_average", "select sample, input from track_v where input < (select avg(input) from track_v)")
def _(v):
    return co.low_yield_samples(v.track_v, v.track_v.agg(F.avg("input")).scalar())


@check(
    "stage_completion",
    """
select 'samples' as stage, count(distinct c_name) as samples from customer
union all select 'assembled', count(distinct c_name) from customer where c_custkey in (select o_custkey from orders)
union all select 'genes predicted', count(distinct c_name) from customer where c_custkey in (select o_custkey from orders where o_orderstatus = 'F')
union all select 'annotated', 0""",
)
def _(v):
    customers = v.customer.select("c_custkey", F.col("c_name").alias("sample"))
    ordered = v.orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return co.stage_completion(
        customers,
        {
            "assembled": ordered,
            "genes predicted": ordered.filter("o_orderstatus = 'F'"),
            "annotated": ordered.filter("o_orderstatus = 'none'"),
        },
    )
