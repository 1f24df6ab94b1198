"""Functional annotation, pathway targets and feature tables."""

from pyspark.sql import functions as F

from biomesheaf import plans
from biomesheaf.functions.joins import settled
from biomesheaf.operators import alignments as al
from biomesheaf.operators import annotation as an

from .registry import SQL_VIEWS, check, joined, rounded

KIND_LISTS = """
select pathway, 'ec' as kind, unnest(string_split(trim(ec), ',')) as id from {t} where ec is not null
union select pathway, 'ko', unnest(string_split(trim(ko), ',')) from {t} where ko is not null
union select pathway, 'gene', unnest(string_split(lower(trim(short_name)), ',')) from {t} where short_name is not null
union select pathway, 'pwy', unnest(string_split(replace(trim(pwy), 'ec', 'map'), ',')) from {t} where pwy is not null
union select pathway, 'pwy', unnest(string_split(replace(replace(trim(pwy), 'ec', 'map'), 'map', 'ko'), ',')) from {t} where pwy is not null"""

SQL_VIEWS.update(
    {
        "but_v": "select * from tgt_v where pathway <> 'All'",
        "tl_v": KIND_LISTS.format(t="tgt_v"),
        "bl_v": KIND_LISTS.format(t="but_v"),
        "bx_v": """
select pathway, kind, id from bl_v where not (kind = 'ec' and id = '2.8.3._')
union select pathway, kind, '2.8.3.' || cast(i as varchar) from (select *, unnest(range(1, 51)) as i from bl_v where kind = 'ec' and id = '2.8.3._')""",
        "cov_annot_v": """
select h.sample, h.cds, h.depth, h.num_bases, h.cds_size, 1.0 * h.num_bases / h.cds_size as frac,
  a.seed_orth, a.ec, a.kegg_ko, a.kegg_pwy, a.protein_name
from hist_v h left join ann_v a on a.cds = h.cds""",
        "maxd_v": """
select * exclude (rk) from (select *, row_number() over (partition by sample, cds order by depth desc) as rk from cov_annot_v) where rk = 1""",
        "coll_v": """
select h.sample, h.cds, h.depth, h.num_bases, h.cds_size, 1.0 * h.num_bases / h.cds_size as frac,
  a.seed_orth, a.ec, a.kegg_ko, a.kegg_pwy, a.protein_name
from (select sample, cds, cast(sum(depth) as bigint) as depth, cast(sum(num_bases) as bigint) as num_bases, max(cds_size) as cds_size
  from hist_v where cds <> 'genome' and depth > 0 group by 1, 2) h
left join ann_v a on a.cds = h.cds""",
        # ids of a row by kind
        "coll_ids_v": "{ids:coll_v}",
        "maxd_ids_v": "{ids:maxd_v}",
        # hits of a row, all targets (bile acid form) and targets without 'All' (butyrate form)
        "coll_hits_v": "select distinct i.* from coll_ids_v i join tl_v t on t.kind = i.kind and t.id = i.id",
        "coll_but_hits_v": "select distinct i.* from coll_ids_v i join bl_v t on t.kind = i.kind and t.id = i.id",
        "maxd_hits_v": "select distinct i.* from maxd_ids_v i join tl_v t on t.kind = i.kind and t.id = i.id",
        "maxd_butx_hits_v": "select distinct i.* from maxd_ids_v i join bx_v t on t.kind = i.kind and t.id = i.id",
        # wide form, one list per kind
        "coll_wide_v": "{wide:coll_v:coll_hits_v}",
        "coll_but_wide_v": "{wide:coll_v:coll_but_hits_v}",
        "maxd_wide_v": "{wide:maxd_v:maxd_hits_v}",
        "maxd_butx_wide_v": "{wide:maxd_v:maxd_butx_hits_v}",
        # rows kept by the two analyses
        "bile_rows_v": """
select * from maxd_wide_v where coalesce(ec_hit, ko_hit, gene_hit, pwy_hit) is not null and not (frac < 0.01 and depth < 5)""",
        "but_rows_v": """
select * from maxd_butx_wide_v where ec_hit is not null and pwy_hit is not null and not (frac < 0.01 and depth < 5)""",
        "bile_pathway_v": """
select distinct h.sample, h.cds, t.pathway, h.kind, h.id from maxd_hits_v h
join bile_rows_v r on r.sample = h.sample and r.cds = h.cds join tl_v t on t.kind = h.kind and t.id = h.id""",
        "but_pathway_v": """
select distinct h.sample, h.cds, t.pathway, h.kind, h.id from maxd_butx_hits_v h
join but_rows_v r on r.sample = h.sample and r.cds = h.cds join bx_v t on t.kind = h.kind and t.id = h.id
where h.kind in ('ec', 'pwy')""",
        "missing_v": """
select s.sample, p.pathway, coalesce(string_agg(m.id, ',' order by m.id), '') as missing, count(m.id) as n
from (select distinct sample from aln_v) s cross join (select distinct pathway from but_v) p
left join (
  select s.sample, b.pathway, b.id from (select distinct sample from aln_v) s cross join bx_v b
  where b.kind = 'ec' and not regexp_matches(b.id, '^2\\.8\\.3\\.([0-9]|[1-4][0-9]|50)$')
    and not exists (select 1 from but_pathway_v f where f.sample = s.sample and f.pathway = b.pathway and f.kind = 'ec' and f.id = b.id)) m
  on m.sample = s.sample and m.pathway = p.pathway
group by 1, 2""",
        # feature tables
        "kw_v": """
select sample, cds, depth, frac, seed_orth, coalesce(ec_hit, ko_hit, gene_hit) as keywords from coll_wide_v
where coalesce(ec_hit, ko_hit, gene_hit) is not null and frac > 0.75""",
        "kw_long_v": """
select sample, cds, seed_orth, depth, 1.0 * depth / len(keywords) as split_depth, unnest(keywords) as kwd from kw_v""",
        "gene_ec_v": """
select distinct trim(g) as gene, trim(e) as ec from (
  select g, unnest(string_split(ec, ',')) as e from (select ec, unnest(string_split(lower(short_name), ',')) as g from but_v where ec is not null))""",
        "pw_rows_v": """
select w.sample, w.cds, w.depth, w.frac, coalesce(w.ec_hit, t.ecs) as ec_hit from coll_but_wide_v w
left join (
  select h.sample, h.cds, list_sort(list(distinct g.ec)) as ecs from coll_but_hits_v h
  join gene_ec_v g on g.gene = h.id where h.kind = 'gene' group by 1, 2) t on t.sample = w.sample and t.cds = w.cds
where coalesce(w.ec_hit, w.gene_hit) is not null and not (w.frac < 0.01 and w.depth < 5)""",
        "pw_long_v": "select sample, cds, frac, 1.0 * depth / len(ec_hit) as split_depth, unnest(ec_hit) as ec from pw_rows_v",
        "ec_depth_v": "select sample, ec, sum(split_depth) as depth from pw_long_v where frac > 0.75 group by 1, 2",
        "pw_feat_v": """
select d.sample, d.ec, d.depth / m.n as depth, b.pathway from ec_depth_v d
join (select distinct pathway, id as ec from bl_v where kind = 'ec') b on b.ec = d.ec
join (select id as ec, count(distinct pathway) as n from bl_v where kind = 'ec' group by 1) m on m.ec = d.ec""",
    }
)

IDS = """
select sample, cds, 'ec' as kind, unnest(string_split(trim(ec), ',')) as id from {0} where ec is not null
union all select sample, cds, 'ko', unnest(string_split(trim(replace(kegg_ko, 'ko:', '')), ',')) from {0} where kegg_ko is not null
union all select sample, cds, 'pwy', unnest(string_split(trim(kegg_pwy), ',')) from {0} where kegg_pwy is not null
union all select sample, cds, 'gene', unnest(string_split(trim(lower(replace(protein_name, 'ko:', ''))), ',')) from {0} where protein_name is not null"""
WIDE = """
select r.*, h.ec_hit, h.ko_hit, h.gene_hit, h.pwy_hit from {0} r left join (
  select sample, cds, list_sort(list(id) filter (kind = 'ec')) as ec_hit, list_sort(list(id) filter (kind = 'ko')) as ko_hit,
    list_sort(list(id) filter (kind = 'gene')) as gene_hit, list_sort(list(id) filter (kind = 'pwy')) as pwy_hit
  from {1} group by 1, 2) h on h.sample = r.sample and h.cds = r.cds"""
for _name, _text in list(SQL_VIEWS.items()):
    if _text.startswith("{ids:"):
        SQL_VIEWS[_name] = IDS.format(*_text[5:-1].split(":"))
    elif _text.startswith("{wide:"):
        SQL_VIEWS[_name] = WIDE.format(*_text[6:-1].split(":"))

HITS = ("ec_hit", "ko_hit", "gene_hit", "pwy_hit")
HIT_TEXT = ", ".join(f"array_to_string({h}, ',') as {h}" for h in HITS)
ROW = "sample, cds, depth, num_bases, cast(cds_size as bigint) as cds_size, round(frac, 6) as frac"


def targets(v, drop_all=False):
    t = v.tgt_v
    return t.filter("pathway <> 'All'") if drop_all else t


def hist(v):
    aln = v.aln_v
    return al.coverage_histogram(aln, al.cohort_ref_lengths(v.cds_v, aln))


def cov_annot(v):
    return an.annotate_coverage(hist(v), v.ann_v)


def collapsed(v):
    aln = v.aln_v
    return an.annotate_collapsed(an.collapse_runs(al.coverage_runs(aln), v.cds_v), v.ann_v)


def with_hits(rows, targets_long, kinds=("ec", "ko", "gene", "pwy")):
    return an.intersect_targets(an.parse_annotation_lists(rows), targets_long, kinds)


def bile_hits(v):
    """Rows of the bile acid analysis by pathway."""
    long = an.normalize_targets(targets(v))
    rows = an.drop_poor_evidence(an.keep_any_hit(with_hits(an.max_depth_row(cov_annot(v)), long)))
    return an.intersect_by_pathway(rows, long), long


def butyrate_hits(v):
    """Rows of the butyrate analysis by pathway, the wildcard enzyme expanded."""
    long = an.expand_ec_wildcard(an.normalize_targets(targets(v, True)))
    rows = an.keep_all_hits(with_hits(an.max_depth_row(cov_annot(v)), long, ("ec", "pwy")))
    return an.intersect_by_pathway(an.drop_poor_evidence(rows), long, ("ec", "pwy")), long


@check("annotate_coverage", f"select {ROW}, seed_orth, ec, kegg_ko, kegg_pwy, protein_name from cov_annot_v")
def _(v):
    return rounded(cov_annot(v), "frac")


@check("normalize_targets", "select pathway, kind, id from tl_v")
def _(v):
    return an.normalize_targets(targets(v))


@check("expand_ec_wildcard", "select pathway, kind, id from bx_v")
def _(v):
    return an.expand_ec_wildcard(an.normalize_targets(targets(v, True)))


@check("max_depth_row", f"select {ROW}, ec from maxd_v")
def _(v):
    return rounded(an.max_depth_row(cov_annot(v)), "frac").drop("seed_orth", "kegg_ko", "kegg_pwy", "protein_name")


@check("collapse_covered", f"select {ROW}, seed_orth, ec, kegg_ko, kegg_pwy, protein_name from coll_v")
def _(v):
    return rounded(an.collapse_covered(cov_annot(v)), "frac")


@check("collapse_early", f"select {ROW}, seed_orth, ec, kegg_ko, kegg_pwy, protein_name from coll_v")
def _(v):
    return rounded(collapsed(v), "frac")


@check(
    "parse_annotation_lists",
    """
select sample, cds, string_agg(id, '/') filter (kind = 'x') as none, count(*) filter (kind = 'ec') as ecs, count(*) filter (kind = 'ko') as kos,
  min(id) filter (kind = 'ko') as first_ko, min(id) filter (kind = 'gene') as first_gene from coll_ids_v group by 1, 2""",
)
def _(v):
    rows = an.parse_annotation_lists(collapsed(v))
    size = lambda c: F.when(F.col(c).isNull(), 0).otherwise(F.size(c)).cast("bigint")
    return rows.filter("coalesce(ec, kegg_ko, kegg_pwy, protein_name) is not null").select(
        "sample",
        "cds",
        F.lit(None).cast("string").alias("none"),
        size("ec").alias("ecs"),
        size("kegg_ko").alias("kos"),
        F.array_min("kegg_ko").alias("first_ko"),
        F.array_min("protein_name").alias("first_gene"),
    )


@check("intersect_targets", f"select sample, cds, {HIT_TEXT} from coll_wide_v")
def _(v):
    rows = with_hits(collapsed(v), an.normalize_targets(targets(v)))
    return joined(rows.select("sample", "cds", *HITS), *HITS)


@check("intersect_targets_join", f"select sample, cds, {HIT_TEXT} from coll_wide_v")
def _(v):
    rows = an.intersect_targets(
        an.parse_annotation_lists(collapsed(v)), an.normalize_targets(targets(v))
    )
    return joined(rows.select("sample", "cds", *HITS), *HITS)


@check(
    "keep_any_hit",
    "select sample, cds from coll_wide_v where coalesce(ec_hit, ko_hit, gene_hit, pwy_hit) is not null",
)
def _(v):
    return an.keep_any_hit(with_hits(collapsed(v), an.normalize_targets(targets(v)))).select("sample", "cds")


@check("keep_all_hits", "select sample, cds from maxd_butx_wide_v where ec_hit is not null and pwy_hit is not null")
def _(v):
    long = an.expand_ec_wildcard(an.normalize_targets(targets(v, True)))
    rows = with_hits(an.max_depth_row(cov_annot(v)), long, ("ec", "pwy"))
    return an.keep_all_hits(rows).select("sample", "cds")


@check(
    "drop_pathway_only",
    "select sample, cds from coll_wide_v where coalesce(ec_hit, ko_hit, gene_hit) is not null",
)
def _(v):
    rows = an.keep_any_hit(with_hits(collapsed(v), an.normalize_targets(targets(v))))
    return an.drop_pathway_only(rows).select("sample", "cds")


@check(
    "drop_poor_evidence",
    "select sample, cds, depth, round(frac, 6) as frac from coll_v where not coalesce(frac < 0.3 and depth < 5, false)",
)
def _(v):
    rows = an.drop_poor_evidence(collapsed(v), min_frac=0.3)
    return rounded(rows.select("sample", "cds", "depth", "frac"), "frac")


@check("filter_cds_coverage", "select sample, cds, num_bases from coll_v where frac > 0.75")
def _(v):
    return an.filter_cds_coverage(collapsed(v), an.percent_threshold(75)).select("sample", "cds", "num_bases")


@check(
    "intersect_by_pathway",
    "select sample, cds, pathway, kind, string_agg(id, ',' order by id) as ids from bile_pathway_v group by 1, 2, 3, 4",
)
def _(v):
    return joined(bile_hits(v)[0], "ids")


@check("missing_enzymes", "select sample, pathway, missing from missing_v")
def _(v):
    hits, long = butyrate_hits(v)
    return joined(an.missing_enzymes(hits, long, v.aln_v), "missing")


@check(
    "missing_enzymes_wide",
    """
select sample, max(missing) filter (pathway = 'AMERICA') as "AMERICA", max(missing) filter (pathway = 'ASIA') as "ASIA",
  max(missing) filter (pathway = 'EUROPE') as "EUROPE", max(missing) filter (pathway = 'MIDDLE EAST') as "MIDDLE EAST"
from missing_v group by 1""",
)
def _(v):
    hits, long = butyrate_hits(v)
    missing = an.missing_enzymes(hits, long, v.aln_v)
    return an.pathway_columns(missing, "missing", ["AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"])


@check("pathway_present", "select sample, pathway, n <= 1 as present from missing_v")
def _(v):
    hits, long = butyrate_hits(v)
    return an.pathway_present(an.missing_enzymes(hits, long, v.aln_v))


FOUND = """
select s.sample, p.pathway, coalesce(f.found, '') as found from (select distinct sample from aln_v) s cross join (select distinct pathway from tgt_v) p
left join (select sample, pathway, string_agg(distinct label, ',' order by label) as found from ({0}) group by 1, 2) f
  on f.sample = s.sample and f.pathway = p.pathway"""
FOUND_ONE = FOUND.format(
    "select sample, pathway, kind || ':' || min(id) as label from bile_pathway_v where kind <> 'pwy' group by sample, pathway, cds, kind"
)
FOUND_ALL = FOUND.format("select sample, pathway, kind || ':' || id as label from bile_pathway_v where kind <> 'pwy'")


@check("found_ids", FOUND_ONE)
def _(v):
    hits, long = bile_hits(v)
    return joined(an.found_ids(hits, long, v.aln_v), "found")


@check("found_ids_all", FOUND_ALL)
def _(v):
    hits, long = bile_hits(v)
    return joined(an.found_ids(hits, long, v.aln_v, one_per_cds=False), "found")


@check(
    "choose_keywords",
    "select sample, cds, array_to_string(coalesce(ec_hit, ko_hit, gene_hit), ',') as keywords from coll_wide_v",
)
def _(v):
    rows = an.choose_keywords(with_hits(collapsed(v), an.normalize_targets(targets(v))))
    return joined(rows.select("sample", "cds", "keywords"), "keywords")


@check("gene_to_ec", "select sample, cds, array_to_string(ec_hit, ',') as ec_hit from pw_rows_v")
def _(v):
    rows = an.drop_poor_evidence(an.pathway_candidates(collapsed(v), targets(v, True)))
    return joined(an.gene_to_ec(rows, targets(v, True)).select("sample", "cds", "ec_hit"), "ec_hit")


@check("split_depth", "select sample, cds, kwd, round(split_depth, 6) as split_depth from kw_long_v")
def _(v):
    rows = an.keyword_rows(collapsed(v), targets(v))
    return rounded(rows.select("sample", "cds", "kwd", "split_depth"), "split_depth")


@check(
    "depth_conserved",
    """
select b.sample, round(b.d, 4) as depth_before, round(a.d, 4) as depth_after, abs(a.d - b.d) <= 1e-8 + 1e-5 * abs(b.d) as conserved
from (select sample, cast(sum(depth) as double) as d from kw_v group by 1) b
join (select sample, sum(split_depth) as d from kw_long_v group by 1) a on a.sample = b.sample""",
)
def _(v):
    rows = an.choose_keywords(an.filter_cds_coverage(an.keyword_candidates(collapsed(v), targets(v))))
    report = an.depth_conservation(rows, an.split_depth(rows, "keywords"))
    return rounded(report, "depth_before", "depth_after", places=4)


@check(
    "keyword_feature_table",
    """
select sample, kwd, round(sum(split_depth), 6) as split_depth, string_agg(seed_orth, '|' order by seed_orth) as seed_orth
from kw_long_v group by 1, 2""",
)
def _(v):
    return rounded(an.keyword_feature_table(cov_annot(v), targets(v)), "split_depth")


@check(
    "keyword_features_from_alignments",
    """
select sample, kwd, round(sum(split_depth), 6) as split_depth, string_agg(seed_orth, '|' order by seed_orth) as seed_orth
from kw_long_v group by 1, 2""",
)
def _(v):
    return rounded(plans.keyword_features(v.aln_v, v.cds_v, v.ann_v, targets(v)), "split_depth")


@check("split_depth_by_pathway", "select sample, ec, round(depth, 6) as depth, pathway from pw_feat_v")
def _(v):
    t = targets(v, True)
    ec_depth = an.pathway_rows(collapsed(v), t).groupBy("sample", "ec").agg(F.sum("split_depth").alias("depth"))
    return rounded(an.split_depth_by_pathway(ec_depth, an.normalize_targets(t)), "depth")


@check("pathway_feature_table", "select sample, ec, round(depth, 6) as depth, pathway from pw_feat_v")
def _(v):
    return rounded(an.pathway_feature_table(cov_annot(v), targets(v, True)), "depth")


@check("pathway_features_from_alignments", "select sample, ec, round(depth, 6) as depth, pathway from pw_feat_v")
def _(v):
    return rounded(plans.pathway_features(v.aln_v, v.cds_v, v.ann_v, targets(v, True)), "depth")


@check(
    "placeholder_for_empty",
    """
select sample, ec, round(depth, 6) as depth, pathway from pw_feat_v
union all select distinct event_type, null, null, null from events""",
)
def _(v):
    t, rows = targets(v, True), settled(collapsed(v), "collapsed")
    features = rounded(an.pathway_features(rows, t), "depth")
    # The samples of the events table have no coverage at all: each is empty.
    samples = v.aln_v.select("sample").unionByName(v.events.select(F.col("event_type").alias("sample")))
    return an.placeholder_for_empty(features, an.pathway_candidates(rows, t), samples)


def rarefied_sql():
    return """
with fr as (select cast(unnest(range(5, 100, 5)) as int) as percent),
al as (select *, cast('0x' || substr(md5('1:' || qname), 1, 8) as bigint) as bucket from aln_v),
b as (select sample, percent, rname, cast(unnest(range(start0, end0)) as bigint) as p from al join fr on bucket < percent * 42949672.96),
d as (select sample, percent, rname, p, count(*) as depth from b group by 1, 2, 3, 4),
h as (select sample, percent, rname, depth, count(*) as n from d group by 1, 2, 3, 4),
c as (select sample, percent, rname as cds, sum(depth) as depth, sum(n) / 400.0 as frac from h group by 1, 2, 3),
i as (select distinct a.cds, k.kind, k.id from ann_v a join coll_but_hits_v k on k.cds = a.cds),
e as (select cds, id as ec from i where kind = 'ec'),
g as (select i.cds, g.ec from i join gene_ec_v g on g.gene = i.id where i.kind = 'gene' and i.cds not in (select cds from e)),
x as (select distinct cds, ec from (select * from e union all select * from g)),
f as (select distinct c.sample, c.percent, x.ec, b.pathway from c join x on x.cds = c.cds
  join bl_v b on b.kind = 'ec' and b.id = x.ec where c.frac > 0.75 and not (c.frac < 0.01 and c.depth < 5))
select s.sample, fr.percent, count(f.ec) as features
from (select distinct sample from aln_v) s cross join fr left join f on f.sample = s.sample and f.percent = fr.percent
group by 1, 2"""


@check("feature_rarefaction", rarefied_sql())
def _(v):
    return an.feature_rarefaction(v.aln_v, v.cds_v, v.ann_v, targets(v, True), how="md5")
