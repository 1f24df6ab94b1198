"""Functional annotation: coverage joined to orthology, pathway targets, feature tables.

Column names: a coverage row is (sample, cds, depth, num_bases, cds_size, frac); an annotation
row has ``ec``, ``kegg_ko``, ``kegg_pwy`` and ``protein_name`` as comma lists until
``parse_annotation_lists`` turns them into arrays. A target table row is (pathway, ec, ko,
short_name, pwy) with comma lists; ``normalize_targets`` makes it long: (pathway, kind, id).
"""

import math

from pyspark.sql import Observation, Window
from pyspark.sql import functions as F

from ..functions.cohort import sample_list
from ..functions.joins import settled
from ..functions.sampling import bucket, fraction_limit
from .alignments import GENOME, coverage_runs

# Kind of identifier -> annotation column that holds it.
KIND_COLUMN = {"ec": "ec", "ko": "kegg_ko", "gene": "protein_name", "pwy": "kegg_pwy"}
COVERAGE_COLUMNS = ("depth", "num_bases", "cds_size", "frac")

# Fixed value: how target tables write the enzyme family whose members are numbered.
EC_WILDCARD = "2.8.3._"


def annotate_coverage(coverage_hist, annotations):
    """Every histogram row with the annotation of its CDS; unannotated rows stay."""
    keys = ["sample", "cds"] if "sample" in annotations.columns else ["cds"]
    return coverage_hist.join(annotations, keys, "left")


# ---------------------------------------------------------------- targets


def _ids(text):
    return F.split(F.trim(text), ",")


def normalize_targets(targets):
    """Target table -> distinct (pathway, kind, id); null lists are skipped."""
    columns = targets.columns
    null = F.lit(None).cast("array<string>")
    maps = _ids(F.replace("pwy", F.lit("ec"), F.lit("map"))) if "pwy" in columns else null
    lists = {
        "ec": _ids(F.col("ec")) if "ec" in columns else null,
        "ko": _ids(F.col("ko")) if "ko" in columns else null,
        "gene": _ids(F.lower("short_name")) if "short_name" in columns else null,
        "pwy": F.concat(
            maps, F.transform(maps, lambda m: F.replace(m, F.lit("map"), F.lit("ko")))
        ),
    }
    return (
        targets.select(
            "pathway",
            F.inline(
                F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("ids")) for k, v in lists.items()])
            ),
        )
        .select("pathway", "kind", F.explode("ids").alias("id"))
        .distinct()
    )


def expand_ec_wildcard(targets_long, wildcard=EC_WILDCARD, first=1, last=50):
    """Replace the wildcard enzyme by its numbered members."""
    stem = wildcard.rstrip("_")
    members = F.transform(
        F.sequence(F.lit(first), F.lit(last)), lambda i: F.concat(F.lit(stem), i.cast("string"))
    )
    is_wildcard = (F.col("kind") == "ec") & (F.col("id") == wildcard)
    return targets_long.select(
        "pathway",
        "kind",
        F.explode(F.when(is_wildcard, members).otherwise(F.array("id"))).alias("id"),
    ).distinct()


# ---------------------------------------------------------------- one row per CDS


def max_depth_row(cov_annot):
    """The histogram row of largest depth per (sample, cds); ties go to the smallest other values.

    The rank is cut to 1, which Spark applies to the rows of a task before it shuffles them.
    """
    rest = [F.col(c) for c in cov_annot.columns if c not in ("sample", "cds", "depth")]
    deepest = Window.partitionBy("sample", "cds").orderBy(F.col("depth").desc(), *rest)
    return cov_annot.withColumn("_rank", F.row_number().over(deepest)).filter(F.col("_rank") == 1).drop("_rank")


def _covered(rows):
    return rows.filter((F.col("cds") != GENOME) & (F.col("depth") > 0))


def collapse_coverage(coverage_hist):
    """One row per covered CDS: summed depth levels, covered bases, size, covered fraction.

    The fraction is taken from the integers, so a CDS exactly at a threshold stays exact.
    """
    return (
        _covered(coverage_hist)
        .groupBy("sample", "cds")
        .agg(
            F.sum("depth").alias("depth"),
            F.sum("num_bases").alias("num_bases"),
            F.max("cds_size").alias("cds_size"),
        )
        .withColumn("frac", F.col("num_bases") / F.col("cds_size"))
    )


def collapse_covered(cov_annot):
    """Annotated histogram -> one row per covered CDS and distinct annotation row.

    Sums run over all rows of a CDS, as in the join of the summed coverage to the distinct
    annotation rows; here the sums are made per annotation row and then added up over the few
    annotation rows of a CDS, which needs no join.
    """
    annotation = [c for c in cov_annot.columns if c not in ("sample", "cds", *COVERAGE_COLUMNS)]
    of_cds = Window.partitionBy("sample", "cds")
    return (
        _covered(cov_annot)
        .groupBy("sample", "cds", *annotation)
        .agg(
            F.sum("depth").alias("depth"),
            F.sum("num_bases").alias("num_bases"),
            F.max("cds_size").alias("cds_size"),
        )
        .select(
            "sample",
            "cds",
            F.sum("depth").over(of_cds).alias("depth"),
            F.sum("num_bases").over(of_cds).alias("num_bases"),
            "cds_size",
            *annotation,
        )
        .withColumn("frac", F.col("num_bases") / F.col("cds_size"))
    )


def _annotation_keys(annotations):
    return ["sample", "cds"] if "sample" in annotations.columns else ["cds"]


def _with_row_count(annotations):
    """Distinct annotation rows with the number of rows their CDS had.

    Copies of a row are counted before the shuffle, so the window sees distinct rows only.
    """
    of_cds = Window.partitionBy(*_annotation_keys(annotations))
    return (
        annotations.groupBy(*annotations.columns)
        .agg(F.count(F.lit(1)).alias("_copies"))
        .withColumn("n_rows", F.sum("_copies").over(of_cds))
        .drop("_copies")
    )


def _repeat_sums(rows):
    """Count a CDS's sums once per annotation row, as a join ahead of the sums does."""
    times = F.coalesce(F.col("n_rows"), F.lit(1))
    return (
        rows.withColumn("depth", F.col("depth") * times)
        .withColumn("num_bases", F.col("num_bases") * times)
        .withColumn("frac", F.col("num_bases") / F.col("cds_size"))
        .drop("n_rows")
    )


def annotate_collapsed(collapsed, annotations):
    """``collapse_covered(annotate_coverage(...))`` with the coverage summed before the join.

    The join then sees one row per CDS instead of one per depth.
    """
    counted = _with_row_count(annotations)
    return _repeat_sums(collapsed.join(counted, _annotation_keys(annotations), "left"))


def parse_annotation_lists(rows):
    """Comma lists -> arrays; ``ko:`` prefixes dropped, gene names lower-cased."""
    plain = lambda c: F.replace(F.col(c), F.lit("ko:"), F.lit(""))
    parsed = {
        "ec": _ids(F.col("ec")),
        "kegg_ko": _ids(plain("kegg_ko")),
        "kegg_pwy": _ids(F.col("kegg_pwy")),
        "protein_name": _ids(F.lower(plain("protein_name"))),
    }
    return rows.withColumns({c: e for c, e in parsed.items() if c in rows.columns})


# ---------------------------------------------------------------- target hits


def _or_null(ids):
    return F.when(F.size(ids) > 0, ids)


def _lists(kinds):
    """The id lists of a row as one value."""
    return F.struct(*[F.col(KIND_COLUMN[k]).alias(k) for k in kinds])


def _list_hits(rows, targets_long, kinds):
    """(_lists, <kind>_hit...): the distinct id lists of the rows that hold a target, with what they hold."""
    any_list = F.coalesce(*[F.col(KIND_COLUMN[k]) for k in kinds]).isNotNull()
    distinct = rows.filter(any_list).select(_lists(kinds).alias("_lists")).distinct()
    ids = distinct.select("_lists", F.inline(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"_lists.{k}").alias("ids")) for k in kinds])))
    found = ids.select("_lists", "kind", F.explode("ids").alias("id")).join(targets_long.select("kind", "id").distinct(), ["kind", "id"])
    hit = lambda k: _or_null(F.array_sort(F.collect_set(F.when(F.col("kind") == k, F.col("id"))))).alias(f"{k}_hit")
    return found.groupBy("_lists").agg(*[hit(k) for k in kinds])


def _join_list_hits(rows, hits, kinds):
    """Rows with the hits of their lists. Rows without any list have no hits; a key of their own spreads them."""
    any_list = F.coalesce(*[F.col(KIND_COLUMN[k]) for k in kinds]).isNotNull()
    apart = F.when(any_list, 0).otherwise(F.xxhash64(*[c for c in rows.columns if c in ("sample", "cds", "depth")]))
    keyed = rows.withColumns({"_key": _lists(kinds), "_apart": apart})
    return keyed.join(hits, (F.col("_key") == F.col("_lists")) & (F.col("_apart") == F.lit(0)), "left").drop("_key", "_apart", "_lists")


def intersect_targets(rows, targets_long, kinds=("ec", "ko", "gene", "pwy")):
    """Add ``<kind>_hit``: the ids of the row found among the targets, sorted, null when none.

    Hits depend on the lists of ids alone, so the distinct lists of all kinds meet the targets in one
    join, and rows get the result by their lists in another. The target table may have any size.
    The rows are stored, so what they are made of is evaluated once for both.
    """
    rows = settled(rows, "annotated")
    return _join_list_hits(rows, _list_hits(rows, targets_long, kinds), kinds)


def _kind_ids(rows, kinds, suffix=None):
    """Explode the id lists of the given kinds: (sample, cds, kind, ids, id)."""
    name = (lambda k: f"{k}_{suffix}") if suffix else (lambda k: KIND_COLUMN[k])
    return rows.select(
        "sample",
        "cds",
        F.inline(
            F.array(
                *[F.struct(F.lit(k).alias("kind"), F.col(name(k)).alias("ids")) for k in kinds]
            )
        ),
    ).select("sample", "cds", "kind", "ids", F.explode("ids").alias("id"))


def keep_any_hit(rows, kinds=("ec", "ko", "gene", "pwy")):
    return rows.filter(F.coalesce(*[F.col(f"{k}_hit") for k in kinds]).isNotNull())


def keep_all_hits(rows, kinds=("ec", "pwy")):
    for kind in kinds:
        rows = rows.filter(F.col(f"{kind}_hit").isNotNull())
    return rows


def drop_pathway_only(rows, kinds=("ec", "ko", "gene")):
    """Drop rows whose only evidence is a pathway id."""
    return keep_any_hit(rows, kinds)


def drop_poor_evidence(rows, min_frac=0.01, min_depth=5):
    """Drop rows that are both hardly covered and shallow; unknown values keep the row."""
    poor = (F.col("frac") < min_frac) & (F.col("depth") < min_depth)
    return rows.filter(~F.coalesce(poor, F.lit(False)))


def percent_threshold(percent):
    """A percentage such as 75 -> 0.75; values of 1 and less are refused."""
    if percent <= 1:
        raise ValueError("the threshold is a percentage, e.g. 10, 30 or 75")
    return percent / 100


def filter_cds_coverage(rows, threshold=0.75):
    """Keep CDS covered by more than the threshold (strictly)."""
    if not 0 <= threshold <= 1:
        raise ValueError("the coverage threshold is a fraction between 0 and 1")
    return rows.filter(F.col("frac") > threshold)


# ---------------------------------------------------------------- per pathway


def intersect_by_pathway(rows, targets_long, kinds=("ec", "ko", "gene", "pwy")):
    """The hits of each row split by pathway: (sample, cds, pathway, kind, ids)."""
    return (
        _kind_ids(rows, kinds, "hit")
        .select("sample", "cds", "kind", "id")
        .join(targets_long.filter(F.col("kind").isin(*kinds)), ["kind", "id"])
        .groupBy("sample", "cds", "pathway", "kind")
        .agg(F.array_sort(F.collect_set("id")).alias("ids"))
    )


def _with_pathways(samples, targets_long, value):
    """Every sample with every pathway of the target table and the pathway's ``value``."""
    per_pathway = targets_long.groupBy("pathway").agg(value.alias("wanted"))
    return per_pathway.select(F.explode(sample_list(samples)).alias("sample"), "pathway", "wanted")


def missing_enzymes(pathway_hits, targets_long, samples, wildcard=EC_WILDCARD, last=50):
    """Per sample and pathway the target enzymes not found, sorted; wildcard members excused."""
    stem = wildcard.rstrip("_")
    excused = [f"{stem}{i}" for i in range(last + 1)]
    is_required = (F.col("kind") == "ec") & ~F.col("id").isin(excused)
    wanted = _with_pathways(
        samples,
        targets_long,
        F.array_sort(F.collect_set(F.when(is_required, F.col("id")))),
    )
    found = (
        pathway_hits.filter(F.col("kind") == "ec")
        .select("sample", "pathway", F.explode("ids").alias("id"))
        .groupBy("sample", "pathway")
        .agg(F.collect_set("id").alias("found"))
    )
    none = F.expr("cast(array() as array<string>)")
    return wanted.join(found, ["sample", "pathway"], "left").select(
        "sample",
        "pathway",
        F.array_sort(F.array_except("wanted", F.coalesce("found", none))).alias("missing"),
    )


def pathway_present(missing):
    """A pathway counts as present with at most one enzyme missing."""
    return missing.select("sample", "pathway", (F.size("missing") <= 1).alias("present"))


def found_ids(pathway_hits, targets_long, samples, one_per_cds=True):
    """Per sample and pathway the ids found, prefixed by kind and sorted."""
    prefix = F.concat(F.col("kind"), F.lit(":"))
    evidence = pathway_hits.filter(F.col("kind").isin("ec", "ko", "gene"))
    ids = F.array(F.array_min("ids")) if one_per_cds else F.col("ids")
    found = (
        evidence.select("sample", "pathway", prefix.alias("prefix"), F.explode(ids).alias("id"))
        .groupBy("sample", "pathway")
        .agg(F.array_sort(F.collect_set(F.concat("prefix", "id"))).alias("found"))
    )
    wanted = _with_pathways(samples, targets_long, F.first(F.lit(None).cast("array<string>"))).drop("wanted")
    none = F.expr("cast(array() as array<string>)")
    return wanted.join(found, ["sample", "pathway"], "left").select(
        "sample", "pathway", F.coalesce("found", none).alias("found")
    )


def pathway_columns(per_pathway, value, pathways=None):
    """One row per sample, one column per pathway holding the comma-joined list."""
    grouped = per_pathway.groupBy("sample")
    pivoted = grouped.pivot("pathway", pathways) if pathways else grouped.pivot("pathway")
    return pivoted.agg(F.first(F.concat_ws(",", value)))


# ---------------------------------------------------------------- feature tables


def choose_keywords(rows):
    """Keywords of a row: its enzyme hits, else ortholog hits, else gene hits."""
    return rows.withColumn("keywords", F.coalesce("ec_hit", "ko_hit", "gene_hit"))


def gene_to_ec(rows, targets):
    """Give rows with gene hits but no enzyme hit the enzymes of those genes."""
    pairs = (
        targets.filter(F.col("short_name").isNotNull() & F.col("ec").isNotNull())
        .select(
            F.explode(F.split(F.lower("short_name"), ",")).alias("gene"), F.split("ec", ",").alias("ecs")
        )
        .select(F.trim("gene").alias("gene"), F.explode("ecs").alias("ec"))
        .groupBy("gene")
        .agg(F.array_sort(F.collect_set(F.trim("ec"))).alias("ecs"))
    )
    lists = rows.filter(F.col("ec_hit").isNull()).select(F.col("gene_hit").alias("_genes")).distinct()
    translated = (
        lists.select("_genes", F.explode("_genes").alias("gene"))
        .join(pairs, "gene")
        .groupBy("_genes")
        .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ecs")))).alias("_ecs"))
    )
    known = rows.join(translated, rows["gene_hit"] == translated["_genes"], "left")
    return known.withColumn("ec_hit", F.coalesce("ec_hit", "_ecs")).drop("_genes", "_ecs")


def split_depth(rows, ids, name="id"):
    """One row per id of the list, the depth shared equally."""
    kept = [c for c in rows.columns if c != ids]
    return rows.filter(F.size(ids) > 0).select(
        *kept,
        (F.col("depth") / F.size(ids)).alias("split_depth"),
        F.explode(ids).alias(name),
    )


def depth_conservation(before, after, rtol=1e-5, atol=1e-8):
    """Per sample: depth before and after a split and whether they agree."""
    zero = F.lit(0.0)
    both = before.select("sample", F.col("depth").cast("double").alias("b"), zero.alias("a")).unionByName(
        after.select("sample", zero.alias("b"), F.col("split_depth").alias("a"))
    )
    sums = both.groupBy("sample").agg(F.sum("b").alias("depth_before"), F.sum("a").alias("depth_after"))
    close = F.abs(F.col("depth_after") - F.col("depth_before")) <= atol + rtol * F.abs(F.col("depth_before"))
    return sums.withColumn("conserved", close)


def assert_depth_conserved(before, after, rtol=1e-5, atol=1e-8):
    """Run the check; raise when a sample lost or gained depth."""
    broken = depth_conservation(before, after, rtol, atol).filter(~F.col("conserved")).limit(5).collect()
    if broken:
        raise AssertionError(f"depth differs before and after the split: {broken}")


def _with_hits(collapsed, targets, kinds, genes_to_ec=False):
    """Rows with their target hits. The rows are stored, so what they are made of is evaluated once.

    With ``genes_to_ec`` the lists, not the rows, have gene hits turned into enzymes.
    """
    rows = settled(parse_annotation_lists(collapsed), "collapsed")
    hits = _list_hits(rows, normalize_targets(targets), kinds)
    return _join_list_hits(rows, gene_to_ec(hits, targets) if genes_to_ec else hits, kinds)


def keyword_candidates(collapsed, targets):
    """Collapsed rows with enzyme, ortholog or gene evidence, before the coverage threshold."""
    kinds = ("ec", "pwy", "ko", "gene")
    return drop_pathway_only(keep_any_hit(_with_hits(collapsed, targets, kinds), kinds))


def keyword_rows(collapsed, targets, threshold=0.75, check=True):
    """Long form of the keyword table: one row per sample, CDS and keyword.

    ``check`` stores the split rows, compares their depth with that of the rows before, and raises on a loss.
    """
    rows = choose_keywords(filter_cds_coverage(keyword_candidates(collapsed, targets), threshold))
    rows = rows.select("sample", "cds", "depth", "seed_orth", "keywords")
    return _checked(rows, "keywords", "kwd", check)


def _checked(before, ids, name, check):
    """``split_depth`` of the rows; with ``check`` the depth is summed on both sides of the split while
    its rows are stored, which is their only evaluation, and a loss raises.

    Both sums are taken by the same tasks, so a task that runs again can't set them apart.
    """
    if not check:
        return split_depth(before, ids, name)
    whole, shared = Observation(), Observation()
    watched = before.observe(whole, F.sum(F.col("depth").cast("double")).alias("depth"))
    split = split_depth(watched, ids, name).observe(shared, F.sum("split_depth").alias("depth"))
    kept = settled(split, "split")
    total, after = whole.get["depth"] or 0.0, shared.get["depth"] or 0.0
    if not math.isclose(total, after, rel_tol=1e-5, abs_tol=1e-8):
        raise AssertionError(f"depth differs before and after the split: {total} and {after}")
    return kept


def summarize_keywords(long_rows):
    """Summed depth and the ``|``-joined seed orthologs per sample and keyword.

    Equal seed orthologs are counted before the shuffle and repeated only when the text is made.
    """
    counted = long_rows.groupBy("sample", "kwd", "seed_orth").agg(
        F.sum("split_depth").alias("split_depth"), F.count("seed_orth").cast("int").alias("n")
    )
    repeated = F.flatten(
        F.transform(
            F.array_sort(F.collect_list(F.struct("seed_orth", "n"))),
            lambda s: F.array_repeat(s["seed_orth"], s["n"]),
        )
    )
    return counted.groupBy("sample", "kwd").agg(
        F.sum("split_depth").alias("split_depth"), F.concat_ws("|", repeated).alias("seed_orth")
    )


def keyword_feature_table(cov_annot, targets, threshold=0.75, check=True):
    """Depth per sample and keyword (enzyme, else ortholog, else gene)."""
    return summarize_keywords(keyword_rows(collapse_covered(cov_annot), targets, threshold, check))


def split_depth_by_pathway(ec_depth, targets_long):
    """Share an enzyme's depth among the pathways it belongs to; others are dropped."""
    members = targets_long.filter(F.col("kind") == "ec").select("pathway", F.col("id").alias("ec")).distinct()
    counted = members.groupBy("ec").agg(
        F.count(F.lit(1)).alias("n_pathways"), F.array_sort(F.collect_set("pathway")).alias("pathways")
    )
    return ec_depth.join(counted, "ec").select(
        *[c for c in ec_depth.columns if c not in ("ec", "depth")],
        "ec",
        (F.col("depth") / F.col("n_pathways")).alias("depth"),
        F.explode("pathways").alias("pathway"),
    )


def pathway_candidates(collapsed, targets, genes_to_ec=False):
    """Collapsed rows with enzyme or gene evidence, before depth and coverage are looked at."""
    kinds = ("ec", "pwy", "gene")
    return drop_pathway_only(keep_any_hit(_with_hits(collapsed, targets, kinds, genes_to_ec), kinds), ("ec", "gene"))


def pathway_rows(collapsed, targets, threshold=0.75, by=("sample",), check=True):
    """Long form before summing: one row per CDS and enzyme that passes the threshold.

    ``check`` as in ``keyword_rows``; rows without an enzyme take no part in the split.
    """
    rows = drop_poor_evidence(pathway_candidates(collapsed, targets, genes_to_ec=True))
    rows = filter_cds_coverage(rows.select(*by, "cds", "frac", "depth", "ec_hit"), threshold)
    return _checked(rows.filter(F.col("ec_hit").isNotNull()), "ec_hit", "ec", check)


def pathway_features(collapsed, targets, threshold=0.75, by=("sample",), check=True):
    """Depth per sample, enzyme and pathway from collapsed annotated rows."""
    by = list(by)
    ec_depth = (
        pathway_rows(collapsed, targets, threshold, by, check)
        .groupBy(*by, "ec")
        .agg(F.sum("split_depth").alias("depth"))
    )
    return split_depth_by_pathway(ec_depth, normalize_targets(targets))


def annotation_enzymes(annotations, targets):
    """Target enzymes of each annotation row with enzyme or gene evidence.

    Evidence depends on the annotation alone, so it is looked up once per annotation row and not
    once per sample and CDS.
    """
    rows = pathway_candidates(_with_row_count(annotations), targets, genes_to_ec=True)
    return rows.select(*_annotation_keys(annotations), "n_rows", "ec_hit")


def target_spans(spans, enzymes):
    """Only the spans on CDS with target enzymes; their list is stored, so Spark knows whether to broadcast it."""
    names = enzymes.select(*[c for c in ("sample", "cds") if c in enzymes.columns])
    names = names.withColumnRenamed("cds", "rname").distinct()
    return spans.join(settled(names, "target-cds"), names.columns, "left_semi")


def enzyme_features(collapsed, enzymes, targets, threshold=0.75, by=("sample",)):
    """``pathway_features`` from coverage per CDS and ``annotation_enzymes``."""
    by = list(by)
    keys = [c for c in ("sample", "cds") if c in enzymes.columns]
    rows = drop_poor_evidence(_repeat_sums(collapsed.join(enzymes, keys)))
    long_rows = split_depth(filter_cds_coverage(rows, threshold), "ec_hit", "ec")
    ec_depth = long_rows.groupBy(*by, "ec").agg(F.sum("split_depth").alias("depth"))
    return split_depth_by_pathway(ec_depth, normalize_targets(targets))


def pathway_feature_table(cov_annot, targets, threshold=0.75, check=True):
    """Depth per sample, enzyme and pathway: (sample, ec, depth, pathway)."""
    return pathway_features(collapse_covered(cov_annot), targets, threshold, check=check)


def placeholder_for_empty(features, candidates, samples):
    """Add one row of nulls for each sample that had no candidate before the threshold."""
    empty = samples.select("sample").distinct().join(
        candidates.select("sample").distinct(), "sample", "left_anti"
    )
    return features.unionByName(empty, allowMissingColumns=True)


# ---------------------------------------------------------------- rarefaction


def sample_of_annotation_path(path):
    """Sample name from a ``.../eggnog_map.<sample>/<file>`` path, ``unknown`` elsewhere."""
    name = F.regexp_extract(path, "eggnog_map\\.([^/]+)/[^/]*$", 1)
    return F.when(name != "", name).otherwise("unknown")


def entry_level(bucket, limits):
    """Index of the first of the ascending bucket limits above the bucket; null above all."""
    entry = F.lit(None).cast("int")
    for i, limit in reversed(list(enumerate(limits))):
        entry = F.when(bucket < limit, F.lit(i)).otherwise(entry)
    return entry


def all_samples(df):
    """One row per sample of a table."""
    return df.select("sample").distinct()


def collapse_runs(runs, ref_lengths, by=("sample",)):
    """``collapse_coverage`` straight from depth runs, without depth 0 and genome rows."""
    by = list(by)
    sums = (
        runs.groupBy(*by, "rname", "depth")
        .agg(F.sum("bases").alias("bases"))
        .groupBy(*by, "rname")
        .agg(F.sum("depth").alias("depth"), F.sum("bases").alias("num_bases"))
    )
    return _with_sizes(sums, ref_lengths)


def collapse_levels(runs, ref_lengths, names, levels):
    """``collapse_runs`` of runs with the depths of all nested levels, each named by ``names`` as ``percent``.

    Runs are not copied per level: a CDS is one row with the bases and distinct depths (at most its length)
    of every level until these are summed.
    """
    at = [F.get("depths", F.lit(i)) for i in range(levels)]
    per_cds = runs.groupBy("sample", "rname").agg(
        F.array(*[F.sum(F.when(d > 0, F.col("bases"))) for d in at]).alias("num_bases"),
        F.array(*[F.collect_set(F.when(d > 0, d)) for d in at]).alias("depths"),
    )
    split = per_cds.select("sample", "rname", "depths", F.posexplode("num_bases").alias("_at", "num_bases")).filter(F.col("num_bases").isNotNull())
    depth = F.aggregate(F.get("depths", F.col("_at")), F.lit(0).cast("bigint"), lambda acc, d: acc + d)
    return _with_sizes(split.select("sample", F.get(names, F.col("_at")).alias("percent"), "rname", depth.alias("depth"), "num_bases"), ref_lengths)


def _with_sizes(sums, ref_lengths):
    keys = [k for k in ("sample", "rname") if k in ref_lengths.columns]
    return (
        sums.join(ref_lengths.select(*keys, F.col("length").alias("cds_size")), keys)
        .withColumnRenamed("rname", "cds")
        .withColumn("frac", F.col("num_bases") / F.col("cds_size"))
    )


def feature_rarefaction(spans, ref_lengths, annotations, targets, threshold=0.75, fractions=None, key="qname", seed=1, how="xxhash64"):
    """Number of pathway feature rows per sample and fraction of the reads.

    All fractions run in one job over one sweep of the reads, which are not copied per fraction;
    a fraction without features counts 0.
    """
    fractions = sorted(fractions or [p / 100 for p in range(5, 100, 5)])
    # Every fraction is a level of its own, however close to the next.
    shown = [round(f * 100, 10) for f in fractions]
    percents = F.array(*[F.lit(int(p) if all(x == int(x) for x in shown) else float(p)) for p in shown])
    # The bucket is a column of its own and the filter looks at the last limit only, so that a key
    # is not hashed again for every fraction.
    limits = [fraction_limit(f) for f in fractions]
    enzymes = annotation_enzymes(annotations, targets)
    entered = (
        target_spans(spans, enzymes)
        .withColumn("_bucket", bucket(key, seed, how))
        .filter(F.col("_bucket") < limits[-1])
        .withColumn("entry", entry_level(F.col("_bucket"), limits))
    )
    by = ["sample", "percent"]
    collapsed = collapse_levels(coverage_runs(entered, levels=len(fractions)), ref_lengths, percents, len(fractions))
    features = enzyme_features(collapsed, enzymes, targets, threshold, by)
    grid = all_samples(spans).select("sample", F.explode(percents).alias("percent"))
    counted = features.select(*by, F.lit(1).alias("n")).unionByName(
        grid.select(*by, F.lit(0).alias("n"))
    )
    return counted.groupBy(*by).agg(F.sum("n").alias("features"))
