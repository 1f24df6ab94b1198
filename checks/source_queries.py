"""Sources and sinks: tables written as the text formats and read back."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from biomesheaf import schemas
from biomesheaf.operators import reads as rd
from biomesheaf.operators import resistome as rs
from biomesheaf.operators import taxonomy as tx
from biomesheaf.session import scratch_path
from biomesheaf.sources import sinks
from biomesheaf.sources import text as tt
from biomesheaf.sources.fastq import read_fastq

from .annotation_queries import hist
from .registry import check, rounded
from .taxonomy_queries import genes

BY_SAMPLE = "sample=([^/]+)/"


def write_lines(df, name, spark, ordered_by=None):
    """Write (sample, value) lines as text, one folder per sample; in order where asked."""
    path = scratch_path(spark, name)
    if ordered_by:
        df = df.repartition("sample").sortWithinPartitions("sample", *ordered_by)
    df.select("sample", "value").write.partitionBy("sample").text(path)
    return path


def tabs(*columns):
    return F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]).alias("value")


@check(
    "read_manifest",
    "select c_name as sample, 'reads/' || c_name || '_R1.fq.gz' as r1, 'reads/' || c_name || '_R2.fq.gz' as r2 from customer",
)
def _(v):
    path = scratch_path(v.spark, "manifest")
    name = F.col("c_name")
    v.customer.select(
        F.col("c_custkey").alias("index"),
        F.concat(F.lit("reads/"), name, F.lit("_R1.fq.gz")).alias("R1"),
        F.concat(F.lit("reads/"), name, F.lit("_R2.fq.gz")).alias("R2"),
        name.alias("sname"),
    ).write.csv(path, header=True)
    return tt.read_manifest(v.spark, path)


READS = "select sample, cast(pair_id as varchar) as pair_id, mate, seq, qual from reads_v"


@check("read_fastq_interleaved", READS)
def _(v):
    path = scratch_path(v.spark, "fastq")
    sinks.write_fastq(v.reads_v, path)
    # Small byte ranges, so that most ranges start inside a record.
    return read_fastq(v.spark, path, sample_pattern=BY_SAMPLE, split_bytes=10_000)


@check("read_fastq_gzip_split", READS)
def _(v):
    path = scratch_path(v.spark, "fastq")
    sinks.write_fastq(v.reads_v, path, layout="split", compression="gzip")
    return read_fastq(v.spark, (f"{path}/R1", f"{path}/R2"), "split", BY_SAMPLE)


@check("write_fastq", "select sample, count(*) as reads from reads_v group by 1")
def _(v):
    path = scratch_path(v.spark, "fastq")
    sinks.write_fastq(v.reads_v, path, compression="gzip")
    lines = v.spark.read.text(path)
    return lines.groupBy("sample").agg((F.count(F.lit(1)) / 4).cast("bigint").alias("reads"))


def write_fasta(v):
    wrapped = F.regexp_replace("seq", "(.{60})", "$1\n")
    header = F.concat(F.lit(">"), F.col("ref_id"), F.lit(" len="), F.length("seq").cast("string"))
    return write_lines(
        v.contigs_v.select("sample", F.concat_ws("\n", header, F.regexp_replace(wrapped, "\n$", "")).alias("value")),
        "fasta",
        v.spark,
    )


@check(
    "read_fasta",
    "select sample, ref_id, 'len=' || cast(length(seq) as varchar) as description, seq, length(seq) as length from contigs_v",
)
def _(v):
    return tt.read_fasta(v.spark, write_fasta(v), BY_SAMPLE)


@check("fasta_index", 'select sample, ref_id as rname, 0 as start, length(seq) as "end" from contigs_v')
def _(v):
    return tt.fasta_index(tt.read_fasta(v.spark, write_fasta(v), BY_SAMPLE))


def write_sam(v):
    hits = v.hits_v.select(
        "sample",
        F.concat_ws(
            "\t",
            *[F.col(c).cast("string") for c in ("qname", "flag", "rname", "pos")],
            F.lit("60"),
            "cigar",
            F.lit("*"),
            F.lit("0"),
            F.lit("0"),
            "seq",
            F.lit("*"),
            F.concat(F.lit("NM:i:"), F.col("nm").cast("string")),
            F.concat(F.lit("AS:i:"), F.col("base_quality_sum").cast("string")),
        ).alias("value"),
    )
    header = v.sql("select distinct event_type as sample from events").select(
        "sample", F.lit("@HD\tVN:1.6").alias("value")
    )
    names = v.genes_v.select(
        F.lit("click").alias("sample"),
        F.concat(F.lit("@SQ\tSN:"), "gene", F.lit("\tLN:"), F.col("gene_length").cast("string")).alias("value"),
    )
    return write_lines(header.unionByName(names).unionByName(hits), "sam", v.spark)


@check(
    "read_sam",
    """
select sample, cast(qname as varchar) as qname, flag, rname, pos, 60 as mapq, cigar, seq, cast(nm as varchar) as nm,
  cast(base_quality_sum as varchar) as "as" from hits_v""",
)
def _(v):
    alignments, _ = tt.read_sam(v.spark, write_sam(v), BY_SAMPLE)
    return alignments.select(
        "sample", "qname", "flag", "rname", "pos", "mapq", "cigar", "seq",
        F.col("tags")["NM"].alias("nm"), F.col("tags")["AS"].alias("as"),
    )


@check("read_sam_header", "select 'click' as sample, gene as rname, gene_length as length from genes_v")
def _(v):
    return tt.read_sam(v.spark, write_sam(v), BY_SAMPLE)[1]


@check(
    "read_coverage_hist",
    "select sample, cds, depth, num_bases, cast(cds_size as bigint) as cds_size, round(1.0 * num_bases / cds_size, 6) as frac from hist_v",
)
def _(v):
    path = write_lines(hist(v).select("sample", tabs(*schemas.COVERAGE_HIST.names)), "hist", v.spark)
    return rounded(tt.read_coverage_hist(v.spark, path, BY_SAMPLE), "frac")


@check("read_annotations", "select cds, seed_orth, ec, kegg_ko, kegg_pwy, protein_name from ann_v")
def _(v):
    full = v.ann_v
    for f in schemas.ANNOTATIONS:
        if f.name not in full.columns:
            full = full.withColumn(f.name, F.lit(None).cast("string"))
    rows = full.select(F.lit("all").alias("sample"), tabs(*schemas.ANNOTATIONS.names))
    notes = v.part.select(F.lit("all").alias("sample"), F.concat(F.lit("# part "), "p_name").alias("value"))
    path = write_lines(rows.unionByName(notes), "annot", v.spark)
    return tt.read_annotations(v.spark, path).select(
        "cds", "seed_orth", "ec", "kegg_ko", "kegg_pwy", "protein_name"
    )


@check("read_targets", "select pathway, ec, ko, short_name, pwy from tgt_v where pathway <> 'All'")
def _(v):
    path = scratch_path(v.spark, "targets")
    v.tgt_v.select(
        F.col("pathway").alias("ButyratePwy"), F.col("ec").alias("EC"), F.col("ko").alias("KO"),
        F.col("short_name").alias("ShortName"), "pwy",
    ).write.csv(path, header=True)
    return tt.read_targets(v.spark, path, "ButyratePwy", drop_all=True)


@check(
    "read_gff_gene_lengths",
    "select 'c' || cast(p_partkey as varchar) as gene_id, cast(p_size * 10 + 1 as bigint) as gene_length from part",
)
def _(v):
    start = F.col("p_partkey") % 1000 + 1
    genes_rows = v.part.select(
        F.lit("all").alias("sample"),
        F.concat_ws(
            "\t", F.concat(F.lit("gnl|X|"), F.col("p_partkey").cast("string")), F.lit("prodigal"), F.lit("CDS"),
            start.cast("string"), (start + F.col("p_size") * 10).cast("string"), F.lit("."), F.lit("+"), F.lit("0"),
            F.concat(F.lit("ID=c"), F.col("p_partkey").cast("string"), F.lit(";product=x")),
        ).alias("value"),
    )
    other = v.supplier.select(F.lit("all").alias("sample"), F.concat(F.lit("##sequence-region "), "s_name").alias("value"))
    return tt.read_gff_gene_lengths(v.spark, write_lines(genes_rows.unionByName(other), "gff", v.spark))


def write_report(v):
    rows = v.rep_v.withColumn("pct", F.lit("1.00")).withColumn("indented", F.concat(F.lit("    "), "name"))
    return write_lines(
        rows.select("sample", "line_no", tabs("pct", "clade_reads", "direct_reads", "rank", "tax_id", "indented")),
        "report", v.spark, ["line_no"],
    )


@check("read_tax_report", "select sample, line_no, clade_reads, direct_reads, rank, tax_id, name from rep_v")
def _(v):
    report = tt.read_tax_report(v.spark, write_report(v), BY_SAMPLE)
    place = F.row_number().over(Window.partitionBy("sample").orderBy("line_no")).cast("bigint")
    return report.withColumn("line_no", place).drop("pct")


@check(
    "richness_of_report_files",
    """
select sample, count(distinct case when dn = 'Bacteria' and rank = 'S' then tax_id end) as bacterial_species from (
  select *, last_value(case when rank = 'D' then name end ignore nulls) over (partition by sample order by line_no) as dn from rep_v)
group by 1""",
)
def _(v):
    return tx.bacterial_species_richness(tt.read_tax_report(v.spark, write_report(v), BY_SAMPLE))


@check(
    "read_classification",
    """
select c.sample, c.status, cast(c.read_id as varchar) as read_id, c.tax_id, coalesce(t.name, 'unclassified') as tax_name, '64|64' as length, '0:1' as kmer_hits
from cls_v c left join tax_v t on t.tax_id = c.tax_id""",
)
def _(v):
    named = v.cls_v.join(v.tax_v.select("tax_id", "name"), "tax_id", "left").withColumns(
        {
            "taxon": F.concat(F.coalesce("name", F.lit("unclassified")), F.lit(" (taxid "), F.col("tax_id").cast("string"), F.lit(")")),
            "length": F.lit("64|64"),
            "hits": F.lit("0:1"),
        }
    )
    path = write_lines(named.select("sample", tabs("status", "read_id", "taxon", "length", "hits")), "class", v.spark)
    return tt.read_classification(v.spark, path, BY_SAMPLE)


@check("read_track_reads", "select sample, input, qtrimmed from track_v")
def _(v):
    path = scratch_path(v.spark, "track")
    columns = ("sample", *rd.TRACK_STAGES)
    lines = v.track_v.select(F.concat_ws("   ", *[F.col(c).cast("string") for c in columns]).alias("value"))
    head = v.spark.range(1).select(F.lit("#sample   #input  #noAdpt #filtered  #decontaminated #qtrimmed").alias("value"))
    head.unionByName(lines).write.text(path)
    return tt.read_track_reads(v.spark, path)


@check(
    "combine_sample_files",
    "select sample as \"Sample\", cds, depth, num_bases from hist_v where cds <> 'genome'",
)
def _(v):
    path = scratch_path(v.spark, "tables")
    rows = hist(v).filter("cds <> 'genome'").select("sample", "cds", "depth", "num_bases")
    rows.write.partitionBy("sample").csv(path, sep="\t", header=True)
    return tt.combine_sample_files(
        v.spark, f"{path}/sample=*", "cds string, depth bigint, num_bases bigint", sample_pattern=BY_SAMPLE
    )


@check(
    "combine_resistome",
    "select sample || '.mechanism' as \"Sample\", name as mechanism, hits from levels_v where level = 'mechanism'",
)
def _(v):
    levels = rs.resistome_levels(rs.gene_fraction_hits(v.hits_v, genes(v), 70), genes(v))
    path = scratch_path(v.spark, "tables")
    named = rs.level_table(levels, "mechanism").withColumn("sample", F.concat("sample", F.lit(".mechanism.tsv")))
    named.write.partitionBy("sample").csv(path, sep="\t", header=True)
    tables = tt.combine_resistome(v.spark, path, {"mechanism": "mechanism string, hits bigint"})
    # The folders are called sample=<name>.mechanism.tsv.
    return tables["mechanism"].withColumn("Sample", F.replace("Sample", F.lit("sample="), F.lit("")))


@check("write_table", "select sample, ec, round(depth, 6) as depth, pathway from pw_feat_v")
def _(v):
    from biomesheaf import plans

    path = scratch_path(v.spark, "features")
    table = plans.pathway_features(v.aln_v, v.cds_v, v.ann_v, v.tgt_v.filter("pathway <> 'All'"))
    sinks.write_table(rounded(table, "depth"), path)
    return v.spark.read.parquet(path)


@check("materialize_if_absent", "select sample, input, no_adapter, filtered, decontaminated, qtrimmed from track_v")
def _(v):
    path = scratch_path(v.spark, "stage")
    sinks.materialize_if_absent(v.spark, lambda: v.track_v, path)

    def never():
        raise AssertionError("the stage was built twice")

    return sinks.materialize_if_absent(v.spark, never, path)


@check("materialize_when_changed", "select sample, input, qtrimmed from track_v where qtrimmed > 0")
def _(v):
    """Made with one parameter, made again with another, and then kept."""
    path, tracked = scratch_path(v.spark, "stage"), scratch_path(v.spark, "tracked")
    v.track_v.write.parquet(tracked)

    def made(least, build=None):
        usual = lambda: v.spark.read.parquet(tracked).filter(F.col("qtrimmed") > least).select("sample", "input", "qtrimmed")
        return sinks.materialize_if_absent(v.spark, build or usual, path, inputs=[tracked], parameters={"least": least})

    def never():
        raise AssertionError("the stage was built twice")

    made(1 << 40)
    made(0)
    return made(0, never)


@check("append_samples", "select sample, cds, depth, num_bases, ec from cov_annot_v")
def _(v):
    from .annotation_queries import cov_annot

    path = scratch_path(v.spark, "annotated")
    names = [*schemas.COVERAGE_HIST.names, *schemas.ANNOTATIONS.names[1:]]
    rows = cov_annot(v)
    full = rows.select("sample", F.lit(0).alias("index"), *[F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in names])
    folders = full.withColumn("sample", F.concat(F.lit("eggnog_map."), "sample"))
    folders.write.partitionBy("sample").csv(path, header=True, escape='"')
    return tt.read_annotated_coverage(v.spark, f"{path}/sample=*").select("sample", "cds", "depth", "num_bases", "ec")
