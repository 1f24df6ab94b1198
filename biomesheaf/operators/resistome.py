"""Resistance genes: covered fraction, levels, rarefaction, haplotypes."""

from pyspark.sql import functions as F

from ..functions import cigar as cg
from ..functions.cohort import sample_list
from ..functions.sampling import bucket, fraction_limit
from .alignments import SECONDARY, SUPPLEMENTARY, UNMAPPED, alignment_spans, coverage_runs, lacks_flag
from .annotation import entry_level

# Levels of the resistance annotation, finest first.
LEVELS = ("gene", "group", "mechanism", "class")


def _gene_fractions(spans, genes):
    """Reads and covered percent per sample and gene."""
    zero = F.lit(0).cast("bigint")
    covered = coverage_runs(spans).select("sample", "rname", zero.alias("hits"), F.col("bases").alias("covered"))
    reads = spans.select("sample", "rname", F.lit(1).cast("bigint").alias("hits"), zero.alias("covered"))
    return (
        covered.unionByName(reads)
        .groupBy("sample", F.col("rname").alias("gene"))
        .agg(F.sum("hits").alias("hits"), F.sum("covered").alias("covered"))
        .join(genes.select("gene", "gene_length"), "gene")
        .select(
            "sample",
            "gene",
            "hits",
            "covered",
            "gene_length",
            (F.lit(100.0) * F.col("covered") / F.col("gene_length")).alias("gene_fraction"),
        )
    )


def _passing(fractions, threshold):
    if not 0 <= threshold <= 100:
        raise ValueError("the gene fraction threshold is a percentage")
    # Integers on both sides: a gene exactly at the threshold is kept.
    return fractions.filter(F.col("covered") * 100 >= F.col("gene_length") * threshold)


def gene_fraction_hits(alignments, genes, threshold=80):
    """Genes of each sample covered to at least ``threshold`` percent."""
    return _passing(_gene_fractions(alignment_spans(alignments), genes), threshold)


def _levels(amr_annotations):
    return F.inline(
        F.array(
            *[F.struct(F.lit(level).alias("level"), F.col(level).alias("name")) for level in LEVELS]
        )
    )


def resistome_levels(gene_hits, amr_annotations):
    """Hits summed at every level in one pass: (sample, level, name, hits)."""
    placed = gene_hits.select("sample", "gene", "hits").join(
        amr_annotations.select(*LEVELS), "gene"
    )
    return (
        placed.select("sample", "hits", _levels(amr_annotations))
        .groupBy("sample", "level", "name")
        .agg(F.sum("hits").alias("hits"))
    )


def level_table(levels, level):
    """The per-sample table of one level."""
    return levels.filter(F.col("level") == level).select(
        "sample", F.col("name").alias(level), "hits"
    )


def resistome_rarefaction(
    alignments, genes, amr_annotations, threshold=80, first=5, last=100, step=5, iterations=1, key="qname", how="xxhash64"
):
    """Distinct names per level that pass the threshold in subsamples of the reads.

    All levels and iterations are worked out in one job: (sample, iteration, percent, level,
    names), zero counts included. The subsamples of an iteration are nested, so one sweep over
    the reads gives the covered bases of a gene in all of them.
    """
    percents = list(range(first, last + 1, step))
    limits = [fraction_limit(p / 100) for p in percents]
    draws = F.array(
        *[
            F.struct(F.lit(i).alias("iteration"), bucket(key, i, how).alias("bucket"))
            for i in range(1, iterations + 1)
        ]
    )
    spans = (
        alignment_spans(alignments, [draws.alias("draws")])
        .select("sample", "rname", "start0", "end0", F.inline("draws"))
        .filter(F.col("bucket") < limits[-1])
        .withColumn("entry", entry_level(F.col("bucket"), limits))
    )
    by = ["sample", "iteration"]
    runs = coverage_runs(spans, by, levels=len(percents))
    covered = runs.groupBy(*by, F.col("rname").alias("gene")).agg(
        *[
            F.sum(F.when(F.get("depths", F.lit(i)) > 0, F.col("bases")).otherwise(0)).alias(f"_c{i}")
            for i in range(len(percents))
        ]
    )
    per_percent = covered.select(
        *by,
        "gene",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(p).alias("percent"), F.col(f"_c{i}").alias("covered"))
                    for i, p in enumerate(percents)
                ]
            )
        ),
    )
    by.append("percent")
    found = (
        _passing(per_percent.join(genes.select("gene", "gene_length"), "gene"), threshold)
        .filter(F.col("covered") > 0)
        .select(*by, "gene")
        .join(amr_annotations.select(*LEVELS), "gene")
        .select(*by, _levels(amr_annotations))
    )
    every = genes.sparkSession.range(1).select(F.explode(sample_list(alignments)).alias("sample"))
    grid = every
    for name, values in (
        ("iteration", range(1, iterations + 1)),
        ("percent", percents),
        ("level", LEVELS),
    ):
        grid = grid.withColumn(name, F.explode(F.array(*[F.lit(x) for x in values])))
    # The grid rows name nothing and only keep the zero counts.
    grid = grid.withColumn("name", F.lit(None).cast("string"))
    return (
        found.unionByName(grid)
        .groupBy(*by, "level")
        .agg(F.count_distinct("name").alias("names"))
    )


def snp_haplotypes(alignments, genes):
    """Mismatch patterns of reads against their gene and how often each occurs.

    A pattern is ``pos:ref>alt`` joined by ``;`` in order of position (1-based), taken from the
    gap-free blocks of primary records that carry their bases; case does not matter. Reads equal to the gene stop at one comparison of two strings.
    """
    hits = (
        alignments.filter(lacks_flag(UNMAPPED) & lacks_flag(SECONDARY) & lacks_flag(SUPPLEMENTARY))
        .filter(F.col("seq").isNotNull() & (F.col("seq") != "*"))
        .select("sample", F.col("rname").alias("gene"), "pos", "cigar", F.upper("seq").alias("seq"))
        .groupBy("sample", "gene", "pos", "cigar", "seq")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(genes.select("gene", "gene_seq"), "gene")
        .withColumn("ref", F.substring(F.upper("gene_seq"), F.col("pos").cast("int"), cg.reference_span("cigar")))
        .drop("gene_seq")
        .filter((F.col("seq") != F.col("ref")))
    )

    def mismatches(block):
        read = F.split(F.substring(F.col("seq"), block["read_off"] + 1, block["n"]), "")
        ref = F.split(F.substring(F.col("ref"), block["ref_off"] + 1, block["n"]), "")
        compared = F.transform(
            F.arrays_zip(read.alias("alt"), ref.alias("ref")),
            lambda c, i: F.when(
                c["alt"] != c["ref"],
                F.concat(
                    (F.col("pos") + block["ref_off"] + i).cast("string"), F.lit(":"), c["ref"], F.lit(">"), c["alt"]
                ),
            ),
        )
        return F.filter(compared, lambda text: text.isNotNull())

    pattern = F.array_join(F.flatten(F.transform(cg.match_blocks("cigar"), mismatches)), ";")
    return (
        hits.select("sample", "gene", pattern.alias("pattern"), "n")
        .filter(F.col("pattern") != "")
        .groupBy("sample", "gene", "pattern")
        .agg(F.sum("n").alias("occurrence"))
    )
