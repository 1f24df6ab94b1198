"""Readers of the tabular and sequence text formats."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import schemas

FILE = "_metadata.file_path"


def sample_from(column, pattern):
    """Sample name from a file path or name; null when the pattern does not match."""
    name = F.regexp_extract(F.url_decode(column), pattern, 1)
    return F.when(name != "", name)


def read_manifest(spark, path):
    """Sample sheet: the first CSV column is an index; R1, R2 and sname are required."""
    table = spark.read.csv(path, header=True)
    named = table.drop(table.columns[0])
    missing = {"R1", "R2", "sname"} - set(named.columns)
    if missing:
        raise ValueError(f"manifest lacks columns: {sorted(missing)}")
    return named.select(
        F.trim("sname").alias("sample"), F.trim("R1").alias("r1"), F.trim("R2").alias("r2")
    )


def read_fasta(spark, path, sample_pattern=None):
    """FASTA records of any line width: (ref_id, description, seq, length).

    Records are split on ``>`` at the start of a line, so a file is read by many tasks and a
    record is never cut.
    """
    lines = spark.read.option("lineSep", "\n>").text(path)
    record = F.regexp_replace("value", "^>", "")
    header = F.trim(F.regexp_replace(F.substring_index(record, "\n", 1), "\r", ""))
    body = F.substring(record, F.length(F.substring_index(record, "\n", 1)) + 1, F.length(record))
    sample = [sample_from(FILE, sample_pattern).alias("sample")] if sample_pattern else []
    return (
        lines.filter(F.trim("value") != "")
        .select(
            *sample,
            F.regexp_extract(header, "^(\\S*)", 1).alias("ref_id"),
            F.trim(F.regexp_extract(header, "^\\S*(.*)$", 1)).alias("description"),
            F.translate(body, " \n\r\t", "").alias("seq"),
        )
        .withColumn("length", F.length("seq").cast("bigint"))
    )


def fasta_index(sequences):
    """Name, start 0, length of every record."""
    sample = ["sample"] if "sample" in sequences.columns else []
    return sequences.select(
        *sample,
        F.col("ref_id").alias("rname"),
        F.lit(0).cast("bigint").alias("start"),
        F.length("seq").cast("bigint").alias("end"),
    )


def read_sam(spark, path, sample_pattern="([^/.]+)\\.[^/]*$"):
    """(alignments, ref_lengths) of SAM text files, the sample taken from the path."""
    lines = spark.read.text(path).select(
        sample_from(FILE, sample_pattern).alias("sample"), "value"
    )
    cells = F.split("value", "\t")
    names = ("qname", "flag", "rname", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual")
    kinds = {"flag": "int", "pos": "bigint", "mapq": "int", "pnext": "bigint", "tlen": "bigint"}
    cell = lambda i: F.get("cells", F.lit(i))
    # ``*`` in these two stands for bases and qualities that are not given.
    given = {n: F.nullif(cell(names.index(n)), F.lit("*")) for n in ("seq", "qual")}
    fields = [given.get(n, cell(i)).cast(kinds.get(n, "string")).alias(n) for i, n in enumerate(names)]
    tags = F.map_from_entries(
        F.transform(
            F.slice("cells", len(names) + 1, F.size("cells")),
            lambda t: F.struct(F.substring(t, 1, 2), F.substring(t, F.lit(6), F.length(t))),
        )
    )
    alignments = (
        lines.filter(~F.col("value").startswith("@") & (F.col("value") != ""))
        .select("sample", cells.alias("cells"))
        .select("sample", *fields, tags.alias("tags"))
    )
    ref_lengths = lines.filter(F.col("value").startswith("@SQ")).select(
        "sample",
        F.regexp_extract("value", "\tSN:([^\t]+)", 1).alias("rname"),
        F.regexp_extract("value", "\tLN:(\\d+)", 1).cast("bigint").alias("length"),
    )
    return alignments, ref_lengths


def _tsv(spark, path, schema, **options):
    # Fields are read as they stand: these formats know no quoting.
    return spark.read.csv(path, sep="\t", schema=schema, quote="", **options)


def read_coverage_hist(spark, path, sample_pattern="prokka_Annot\\.([^/]+)/"):
    """Coverage histograms without header; ``genome`` rows stay."""
    return _tsv(spark, path, schemas.COVERAGE_HIST).select(
        sample_from(FILE, sample_pattern).alias("sample"), *schemas.COVERAGE_HIST.names
    )


def read_annotations(spark, path, sample_pattern=None):
    """Orthology annotations by position, comment lines dropped."""
    table = _tsv(spark, path, schemas.ANNOTATIONS, comment="#")
    if sample_pattern:
        return table.select(sample_from(FILE, sample_pattern).alias("sample"), *schemas.ANNOTATIONS.names)
    return table


def read_annotated_coverage(spark, path):
    """All samples' annotated coverage tables (CSV with index) in one DataFrame.

    The sample is the ``eggnog_map.<sample>`` folder of the file, else ``unknown``.
    """
    from ..operators.annotation import sample_of_annotation_path

    names = ["index", *schemas.COVERAGE_HIST.names, *schemas.ANNOTATIONS.names[1:]]
    kinds = {f.name: f.dataType for f in [*schemas.COVERAGE_HIST, *schemas.ANNOTATIONS]}
    schema = ", ".join(f"{n} {kinds[n].simpleString() if n in kinds else 'string'}" for n in names)
    table = spark.read.csv(path, header=True, enforceSchema=True, schema=schema, escape='"')
    return table.select(
        sample_of_annotation_path(F.url_decode(FILE)).alias("sample"), *names[1:]
    )


def read_targets(spark, path, group_col, drop_all=False):
    """Pathway target table: (pathway, ec, ko, short_name, pwy), absent lists null."""
    table = spark.read.csv(path, header=True)
    # Column names of the target files.
    wanted = {"ec": "EC", "ko": "KO", "short_name": "ShortName", "pwy": "pwy"}
    targets = table.select(
        F.col(group_col).alias("pathway"),
        *[
            (F.col(c) if c in table.columns else F.lit(None).cast("string")).alias(n)
            for n, c in wanted.items()
        ],
    )
    return targets.filter(F.col("pathway") != "All") if drop_all else targets


def read_gff_gene_lengths(spark, path):
    """Lengths of the ``gnl`` features of GFF files: (gene_id, gene_length)."""
    cells = F.split("value", "\t")
    return (
        spark.read.text(path)
        .filter(F.col("value").startswith("gnl"))
        .select(
            F.regexp_extract(F.get(cells, F.lit(8)), "ID=([^;]*)", 1).alias("gene_id"),
            (F.get(cells, F.lit(4)).cast("bigint") - F.get(cells, F.lit(3)).cast("bigint") + 1).alias(
                "gene_length"
            ),
        )
    )


def read_tax_report(spark, path, sample_pattern="([^/]+)\\.krakenReport$"):
    """Taxonomy reports with their line order; empty files give no rows.

    ``line_no`` grows along a file. It is the byte order of Spark's own file splits: the start of
    the split, then the place in it.
    """
    table = _tsv(spark, path, schemas.TAX_REPORT).withColumns(
        {"_id": F.monotonically_increasing_id(), "_at": F.col("_metadata.file_block_start")}
    )
    in_split = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return table.select(
        sample_from(FILE, sample_pattern).alias("sample"),
        # A split of S bytes holds fewer than S lines, so starts and places never collide.
        (F.col("_at") * 2 + in_split).alias("line_no"),
        "pct",
        "clade_reads",
        "direct_reads",
        F.trim("rank").alias("rank"),
        "tax_id",
        F.trim("name").alias("name"),
    )


def read_classification(spark, path, sample_pattern="([^/]+)\\.krakenClass$"):
    """Per-read classifications; the taxon column may be an id or ``name (taxid id)``."""
    named = F.regexp_extract("taxon", "\\(taxid (\\d+)\\)\\s*$", 1)
    return _tsv(spark, path, schemas.READ_CLASS).select(
        sample_from(FILE, sample_pattern).alias("sample"),
        "status",
        "read_id",
        F.when(named != "", named).otherwise(F.trim("taxon")).cast("bigint").alias("tax_id"),
        F.when(named != "", F.trim(F.regexp_replace("taxon", "\\(taxid \\d+\\)\\s*$", ""))).alias("tax_name"),
        F.col("length"),
        "kmer_hits",
    )


def _first_lines(spark, paths):
    """(file, header) of every file that has a line: the line at its very beginning."""
    lines = spark.read.text(paths).select(
        "value",
        F.col(FILE).alias("file"),
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("place"),
    )
    return lines.groupBy("file").agg(F.min_by("value", "place").alias("header"))


def read_track_reads(spark, path):
    """Blank-separated tracking table: (sample, input, qtrimmed), found by the names in each file's header.

    A file that begins without a header (a part of a written folder) has that of the others, if they
    agree. A header that lacks one of the three names, or none at all, raises.
    """
    # The header names.
    wanted = {"sample": "#sample", "input": "#input", "qtrimmed": "#qtrimmed"}
    cells = lambda c: F.split(F.trim(c), "\\s+")
    headers = _first_lines(spark, path).withColumn("header", F.when(F.col("header").startswith("#"), F.trim("header")))
    shared = headers.agg(F.collect_set("header").alias("all")).select(F.when(F.size("all") == 1, F.get("all", F.lit(0)))).scalar()
    headers = headers.select("file", cells(F.coalesce("header", shared)).alias("names"))
    rows = spark.read.text(path).select("value", F.col(FILE).alias("file"))
    rows = rows.filter((F.trim("value") != "") & ~F.col("value").startswith("#")).join(headers, "file")

    def cell(name):
        at = F.array_position("names", wanted[name]).cast("int")
        message = F.concat(F.lit(f"no column {wanted[name]} in "), F.col("file"))
        return F.when(at > 0, F.get(cells("value"), at - 1)).otherwise(F.raise_error(message).cast("string"))

    return rows.select(
        cell("sample").alias("sample"), cell("input").cast("bigint").alias("input"), cell("qtrimmed").cast("bigint").alias("qtrimmed")
    )


def combine_sample_files(
    spark, paths, schema, sep="\t", header=True, sample_pattern=r"([^/]+)\.tsv(?:/[^/]*)?$"
):
    """Append per-sample tables by column name; ``Sample`` is the name of the file without ``.tsv``.

    The table of a sample may be a file or a folder of that name written by Spark. ``schema`` is a
    DDL string. Files may hold the columns in any order; one that a file lacks is null there. Files
    without rows add nothing, whichever comes first. Without a header columns go by position.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    sample = sample_from(FILE, sample_pattern).alias("Sample")
    kinds = StructType.fromDDL(schema)
    if not header:
        return spark.read.csv(paths, sep=sep, schema=schema).select("*", sample)
    # One read for each order of columns there is.
    orders = {}
    for row in _first_lines(spark, paths).collect():
        orders.setdefault(row["header"], []).append(row["file"])
    parts = []
    for line, files in sorted(orders.items()):
        names = [n.strip().strip('"') for n in line.split(sep)]
        found = StructType([kinds[n] if n in kinds.names else StructField(n, StringType()) for n in names])
        part = spark.read.csv(sorted(files), sep=sep, header=True, schema=found)
        parts.append(part.select(*[F.col(f"`{n}`") for n in names if n in kinds.names], sample))
    none = spark.createDataFrame([], kinds).withColumn("Sample", F.lit(None).cast("string"))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts, none).select(*kinds.names, "Sample")


def append_tables(tables):
    """Append tables by column name; columns a table lacks are null."""
    return reduce(lambda a, b: DataFrame.unionByName(a, b, allowMissingColumns=True), tables)


# The file names of the combined tables; haplotypes are named by sequencing lane.
RESISTOME_FILES = {"gene": "*gene.tsv", "group": "*group.tsv", "mechanism": "*mechanism.tsv", "class": "*class.tsv", "snp": "*_L???.tsv"}


def combine_resistome(spark, folder, schemas_by_level):
    """The combined table of each level (gene, group, mechanism, class, snp) from the files of that level."""
    return {
        level: combine_sample_files(spark, f"{folder.rstrip('/')}/{RESISTOME_FILES.get(level, f'*{level}.tsv')}", ddl)
        for level, ddl in schemas_by_level.items()
    }
