"""End-to-end plans: each composes operators into one lazy DataFrame."""

from ..functions.joins import settled
from ..operators import alignments as al
from ..operators import annotation as an
from ..operators import reads as rd
from ..operators import resistome as rs
from ..operators import taxonomy as tx


def clean_reads(reads, adapters, artifacts, host=None, k=31, hdist=1, cutoff=10, min_len=50, keep=settled):
    """Adapters, artifacts, host and quality in order: the reads after every stage by name.

    ``keep`` stores each stage, so that counting stages and going on from them computes each once;
    pass ``lambda reads, name: reads`` for one lazy chain.
    """
    stages = {"input": reads}
    stages["no_adapter"] = keep(rd.trim_adapters(reads, adapters), "no-adapter")
    stages["filtered"] = keep(rd.kmer_screen(stages["no_adapter"], artifacts, k, hdist)[0], "filtered")
    stages["decontaminated"] = stages["filtered"]
    if host is not None:
        stages["decontaminated"] = keep(rd.kmer_screen(stages["filtered"], host, k, 0)[0], "decontaminated")
    stages["qtrimmed"] = keep(rd.filter_pairs_by_length(rd.quality_trim(stages["decontaminated"], cutoff), min_len), "qtrimmed")
    return stages


def pathway_features(alignments, ref_lengths, annotations, targets, threshold=0.75):
    """Alignments (or spans) -> depth per sample, enzyme and pathway.

    Same rows as coverage_histogram -> annotate_coverage -> pathway_feature_table. The target
    enzymes are looked up in the annotation first; alignments elsewhere are dropped before the
    sweep when the CDS that matter are few, and coverage is summed per CDS before the join.
    """
    spans = alignments if "start0" in alignments.columns else al.alignment_spans(alignments)
    enzymes = an.annotation_enzymes(annotations, targets)
    runs = al.coverage_runs(an.target_spans(spans, enzymes))
    return an.enzyme_features(an.collapse_runs(runs, ref_lengths), enzymes, targets, threshold)


def keyword_features(alignments, ref_lengths, annotations, targets, threshold=0.75, samples=None):
    """Alignments (or spans) -> depth and seed orthologs per sample and keyword.

    Same rows as coverage_histogram -> annotate_coverage -> keyword_feature_table, with coverage summed
    per CDS before the join. ``samples`` adds a row of nulls for each sample without candidates.
    """
    spans = alignments if "start0" in alignments.columns else al.alignment_spans(alignments)
    collapsed = an.annotate_collapsed(an.collapse_runs(al.coverage_runs(spans), ref_lengths), annotations)
    if samples is None:
        return an.summarize_keywords(an.keyword_rows(collapsed, targets, threshold))
    collapsed = settled(collapsed, "collapsed")
    features = an.summarize_keywords(an.keyword_rows(collapsed, targets, threshold))
    return an.placeholder_for_empty(features, an.keyword_candidates(collapsed, targets), samples)


def gene_abundance(alignments, intervals, gene_lengths, score=None):
    """Duplicate removal, read counts per gene, TPM."""
    kept = al.remove_duplicates(alignments, score)
    return al.tpm(al.count_reads_per_interval(kept, intervals), gene_lengths)


def taxonomy_summary(reads, kmer_db, taxonomy, track_reads, k=35):
    """Reads -> classification -> report -> domain counts and richness per sample."""
    tree = tx.lineages(taxonomy)
    report = settled(tx.taxonomy_report(tx.classify_reads(reads, kmer_db, tree, k), tree), "report")
    return tx.classification_summary(report, track_reads)


def resistome(alignments, genes, amr_annotations, threshold=80):
    """The four level tables by name."""
    levels = rs.resistome_levels(rs.gene_fraction_hits(alignments, genes, threshold), amr_annotations)
    return {level: rs.level_table(levels, level) for level in rs.LEVELS}
