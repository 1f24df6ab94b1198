"""Alignments: order, duplicates, coverage, counts, TPM, assembly statistics, sketches."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import cigar as cg
from ..functions import packed as pk
from ..functions import sequences as sq
from ..functions.cohort import per_sample

# SAM flag bits.
UNMAPPED, MATE_UNMAPPED, REVERSE = 4, 8, 16
MATE_REVERSE, FIRST_MATE, SECOND_MATE = 32, 64, 128
SECONDARY, SUPPLEMENTARY = 256, 2048

GENOME = "genome"

# Coverage and overlaps are worked out inside bins of this many bases, so that no task has to
# sort the events of a whole chromosome or of one reference holding most of the reads.
BIN_WIDTH = 1 << 14


def has_flag(bits):
    return F.col("flag").bitwiseAND(F.lit(bits)) == bits


def lacks_flag(bits):
    return F.col("flag").bitwiseAND(F.lit(bits)) == 0


def alignment_spans(alignments, extra=()):
    """Mapped alignments as 0-based half-open spans (sample, rname, start0, end0)."""
    return alignments.filter(lacks_flag(UNMAPPED)).select(
        "sample",
        "rname",
        (F.col("pos") - 1).cast("bigint").alias("start0"),
        (F.col("pos") - 1 + cg.reference_span("cigar")).cast("bigint").alias("end0"),
        *extra,
    )


def _as_spans(df, extra=()):
    return df if "start0" in df.columns else alignment_spans(df, extra)


# ---------------------------------------------------------------- order and duplicates


def sort_by_coordinate(alignments, partitions=None):
    """Total order by reference and position.

    Range partitioning includes the read name, so a position shared by very many reads is
    spread over several ranges and the order stays total.
    """
    keys = ["sample", "rname", "pos", "qname"]
    ranged = (
        alignments.repartitionByRange(partitions, *keys)
        if partitions
        else alignments.repartitionByRange(*keys)
    )
    return ranged.sortWithinPartitions(*keys)


def _examined():
    return lacks_flag(UNMAPPED) & lacks_flag(SECONDARY) & lacks_flag(SUPPLEMENTARY)


def _duplicate_groups(alignments, score):
    """One row per group of duplicate fragments: its ends, its best fragment and its size.

    A fragment is what shares a read name: one record or two mates. Its ends are the unclipped 5'
    positions and strands of its records. Only names, ends and scores are shuffled, and a fragment
    copied millions of times moves one row per task.
    """
    end = F.struct(
        "rname",
        cg.unclipped_five_prime("pos", "cigar", has_flag(REVERSE)).alias("five_prime"),
        has_flag(REVERSE).alias("reverse"),
    )
    fragments = (
        alignments.filter(_examined())
        .groupBy("sample", "qname")
        .agg(F.sort_array(F.collect_list(end)).alias("ends"), F.sum(score).alias("score"))
    )
    best = F.min(F.struct((-F.col("score")).alias("neg_score"), "qname")).alias("best")
    return fragments.groupBy("sample", "ends").agg(best, F.count(F.lit(1)).alias("copies"))


def remove_duplicates(alignments, score=None):
    """Keep the best of the fragments with equal ends, both mates of it; ties go to the smallest name.

    Mates are examined together, so no orphan is left: a pair equals another only if both its
    unclipped 5' ends and strands do. Unmapped, secondary and supplementary records are not
    examined and stay.
    """
    score = sq.base_quality_sum("qual") if score is None else score
    names = _duplicate_groups(alignments, score).select("sample", "best.qname")
    kept = alignments.filter(_examined()).join(names, ["sample", "qname"], "left_semi")
    return kept.unionByName(alignments.filter(~_examined())).select(*alignments.columns)


def duplicate_metrics(alignments, score=None):
    """Per sample: alignments examined, duplicates removed, their share."""
    records = F.size("ends")
    return (
        _duplicate_groups(alignments, F.lit(0) if score is None else score)
        .groupBy("sample")
        .agg(
            F.sum(F.col("copies") * records).alias("examined"),
            F.sum((F.col("copies") - 1) * records).alias("duplicates"),
        )
        .withColumn("duplicate_fraction", F.try_divide("duplicates", "examined"))
    )


# ---------------------------------------------------------------- coverage


def coverage_runs(spans, by=("sample",), bin_width=BIN_WIDTH, levels=0):
    """Stretches of equal depth: (*by, rname, depth, bases), depth > 0 only.

    Every span is cut at bin borders and each bin is swept on its own; +1/-1 events at one
    position are added up before the shuffle, so a window never holds more than one row per
    position of its bin, however many reads a reference has.

    With ``levels`` the spans carry ``entry``, the first of so many nested subsamples they are
    in, and ``depth`` becomes ``depths``, one value per subsample: all are swept together.
    """
    by = list(by)
    width = F.lit(bin_width).cast("bigint")
    entry = ["entry"] if levels else []
    pieces = spans.filter(F.col("end0") > F.col("start0")).select(
        *by,
        "rname",
        "start0",
        "end0",
        *entry,
        F.explode(
            F.sequence(F.expr(f"start0 div {bin_width}"), F.expr(f"(end0 - 1) div {bin_width}"))
        ).alias("bin"),
    )
    one = F.lit(1).cast("bigint")
    first = F.greatest(F.col("start0"), F.col("bin") * width)
    behind = F.least(F.col("end0"), (F.col("bin") + 1) * width)
    events = pieces.select(
        *by,
        "rname",
        "bin",
        *entry,
        F.inline(
            F.array(
                F.struct(first.alias("pos"), one.alias("delta")),
                F.struct(behind.alias("pos"), (-one).alias("delta")),
            )
        ),
    )
    names = [f"_d{i}" for i in range(levels)] or ["depth"]
    # A row of each level that begins or ends at a position, and no column per level: sums of levels are
    # made in the sweep. Of the rows of one position all but the last span no bases.
    at_position = events.groupBy(*by, "rname", "bin", "pos", *entry).agg(F.sum("delta").alias("delta"))
    sweep = Window.partitionBy(*by, "rname", "bin").orderBy("pos")
    upto = sweep.rowsBetween(Window.unboundedPreceding, 0)
    steps = [F.when(F.col("entry") <= i, F.col("delta")).otherwise(0) for i in range(levels)] or [F.col("delta")]
    runs = at_position.select(
        *by,
        "rname",
        *[F.sum(step).over(upto).alias(n) for n, step in zip(names, steps)],
        (F.lead("pos").over(sweep) - F.col("pos")).alias("bases"),
    ).filter((F.col(names[-1]) > 0) & (F.col("bases") > 0))
    if levels:
        return runs.select(*by, "rname", F.array(*names).alias("depths"), "bases")
    return runs


def coverage_histogram(alignments, ref_lengths, by=("sample",), bin_width=BIN_WIDTH):
    """Bases at each depth for every reference and for ``genome``; depth 0 rows included.

    ``alignments`` are SAM rows or spans; ``ref_lengths`` (rname, length) may hold a ``sample``
    column, else every sample gets all references. One aggregation serves references and
    genome: a covered run adds its bases to its depth, each reference brings its whole length to
    depth 0, and what is covered is taken from there when the depths of a reference are together.
    """
    by = list(by)
    runs = coverage_runs(_as_spans(alignments), by, bin_width)
    zero = F.lit(0).cast("bigint")

    def row(name, depth, bases, size):
        return F.struct(
            name.alias("cds"), depth.alias("depth"), bases.alias("num_bases"), size.alias("size")
        )

    name, genome = F.col("rname").cast("string"), F.lit(GENOME)
    covered = runs.select(
        *by, F.inline(F.array(*[row(who, F.col("depth"), F.col("bases"), zero) for who in (name, genome)]))
    )
    length = F.col("length").cast("bigint")
    header = ref_lengths.select(
        *by, F.inline(F.array(*[row(who, zero, length, length) for who in (name, genome)]))
    )
    histogram = (
        covered.unionByName(header)
        .groupBy(*by, "cds", "depth")
        .agg(F.sum("num_bases").alias("num_bases"), F.sum("size").alias("size"))
    )
    # One row per distinct depth of a reference: the window stays small.
    whole = Window.partitionBy(*by, "cds")
    return (
        histogram.withColumn("cds_size", F.sum("size").over(whole))
        .withColumn("_covered", F.sum(F.when(F.col("depth") > 0, F.col("num_bases")).otherwise(zero)).over(whole))
        .withColumn("num_bases", F.col("num_bases") - F.when(F.col("depth") > 0, zero).otherwise(F.col("_covered")))
        .filter((F.col("num_bases") > 0) & (F.col("cds_size") > 0))
        .select(
            *by,
            "cds",
            "depth",
            "num_bases",
            "cds_size",
            (F.col("num_bases") / F.col("cds_size")).alias("frac"),
        )
    )


def cohort_ref_lengths(ref_lengths, alignments):
    """Reference lengths with a ``sample`` column (all samples of the alignments)."""
    return per_sample(ref_lengths, alignments)


def coverage_depth_distribution(coverage_hist):
    """Bases at each depth over all references of a sample."""
    return (
        coverage_hist.filter(F.col("cds") != GENOME)
        .groupBy("sample", "depth")
        .agg(F.sum("num_bases").alias("num_bases"))
    )


def contig_coverage_stats(alignments, ref_lengths, bin_width=BIN_WIDTH):
    """Per contig: length, average depth, covered bases and percent, reads, reads per strand."""
    spans = alignment_spans(
        alignments, extra=[has_flag(REVERSE).alias("reverse")]
    )
    zero = F.lit(0).cast("bigint")
    names = ("length", "covered", "bases", "reads", "plus", "minus")

    def part(df, **given):
        return df.select(
            "sample", "rname", *[given.get(n, zero).cast("bigint").alias(n) for n in names]
        )

    parts = (
        part(ref_lengths, length=F.col("length"))
        .unionByName(part(coverage_runs(spans, bin_width=bin_width), covered=F.col("bases")))
        .unionByName(
            part(
                spans,
                bases=F.col("end0") - F.col("start0"),
                reads=F.lit(1),
                plus=(~F.col("reverse")).cast("int"),
                minus=F.col("reverse").cast("int"),
            )
        )
    )
    return (
        parts.groupBy("sample", "rname")
        .agg(*[F.sum(n).alias(n) for n in names])
        .filter(F.col("length") > 0)
        .select(
            "sample",
            F.col("rname").alias("contig"),
            "length",
            (F.col("bases") / F.col("length")).alias("avg_depth"),
            F.col("covered").alias("covered_bases"),
            (F.lit(100.0) * F.col("covered") / F.col("length")).alias("covered_percent"),
            "reads",
            F.col("plus").alias("plus_reads"),
            F.col("minus").alias("minus_reads"),
        )
    )


# ---------------------------------------------------------------- counts and abundance


def count_reads_per_interval(alignments, intervals, bin_width=BIN_WIDTH):
    """Reads overlapping each interval, zero counts kept: (sample, gene_id, count).

    ``intervals`` are (rname, start, end), 0-based half-open, named by ``gene_id`` or else by
    ``rname``. A span overlaps an interval if it begins before the interval's end and does not end by its
    start, so the count is a difference of two ranks: spans begun before ``end`` less spans ended by
    ``start``. Both are running sums over one merged order of span ends and interval ends. The order is cut
    into bins of positions that carry on the sums of the bins before them, so a long or deep reference
    is many tasks, and no pair of a read and an interval is ever a row, however intervals are nested.
    """
    spans = _as_spans(alignments)
    intervals = per_sample(intervals, alignments)
    if "gene_id" not in intervals.columns:
        intervals = intervals.withColumn("gene_id", F.col("rname").cast("string"))
    zero, none = F.lit(0).cast("bigint"), F.lit(None).cast(intervals.schema["gene_id"].dataType)
    # At one position interval ends come before the spans that begin there, starts after those that end there.
    ends = [F.struct(F.col("start0").cast("bigint").alias("pos"), F.lit(1).alias("begun"), F.lit(0).alias("ended")), F.struct(F.col("end0").cast("bigint").alias("pos"), F.lit(0).alias("begun"), F.lit(1).alias("ended"))]
    events = (
        spans.filter(F.col("end0") > F.col("start0"))
        .select("sample", "rname", F.explode(F.array(*ends)).alias("e"))
        .groupBy("sample", "rname", "e.pos")
        .agg(F.sum("e.begun").alias("begun"), F.sum("e.ended").alias("ended"))
        .select("sample", "rname", "pos", F.lit(1).alias("turn"), "begun", "ended", none.alias("gene_id"))
    )
    asked = [F.struct(F.col("end").cast("bigint").alias("pos"), F.lit(0).alias("turn")), F.struct(F.col("start").cast("bigint").alias("pos"), F.lit(2).alias("turn"))]
    questions = (
        intervals.filter(F.col("end") > F.col("start"))
        .select("sample", "rname", "gene_id", F.explode(F.array(*asked)).alias("q"))
        .select("sample", "rname", "q.pos", "q.turn", zero.alias("begun"), zero.alias("ended"), "gene_id")
    )
    place = ["sample", "rname", "bin"]
    merged = events.unionByName(questions).withColumn("bin", F.floor(F.col("pos") / bin_width))
    earlier = Window.partitionBy("sample", "rname").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        merged.groupBy(*place)
        .agg(F.sum("begun").alias("begun"), F.sum("ended").alias("ended"))
        .select(*place, *[F.coalesce(F.sum(c).over(earlier), zero).alias(f"{c}_before") for c in ("begun", "ended")])
    )
    so_far = Window.partitionBy(*place).orderBy("pos", "turn").rowsBetween(Window.unboundedPreceding, 0)
    ranks = merged.select(*place, "turn", "gene_id", F.sum("begun").over(so_far).alias("begun"), F.sum("ended").over(so_far).alias("ended"))
    answered = ranks.filter(F.col("turn") != 1).join(carried, place)
    term = F.when(F.col("turn") == 0, F.col("begun") + F.col("begun_before")).otherwise(-F.col("ended") - F.col("ended_before"))
    counts = answered.select("sample", "gene_id", term.alias("count"))
    return counts.unionByName(intervals.select("sample", "gene_id", zero.alias("count"))).groupBy("sample", "gene_id").agg(F.sum("count").alias("count"))


def tpm(counts, gene_lengths, read_length=100):
    """Transcripts per million over the genes present in both tables: (sample, gene_id, tpm)."""
    keys = ["sample", "gene_id"] if "sample" in gene_lengths.columns else ["gene_id"]
    rates = counts.join(gene_lengths, keys).select(
        "sample",
        "gene_id",
        F.try_divide(F.lit(read_length) * F.col("count"), F.col("gene_length")).alias("rate"),
    )
    totals = rates.groupBy("sample").agg(F.sum("rate").alias("total"))
    return rates.join(totals, "sample").select(
        "sample", "gene_id", F.try_divide(F.lit(1e6) * F.col("rate"), F.col("total")).alias("tpm")
    )


def tpm_wide(tpm_long, samples=None):
    """One row per gene, one column per sample."""
    grouped = tpm_long.groupBy("gene_id")
    pivoted = grouped.pivot("sample", samples) if samples else grouped.pivot("sample")
    return pivoted.agg(F.first("tpm"))


# ---------------------------------------------------------------- split by mapping


def alignment_identity(alignments):
    """1 - NM / aligned columns. NM is taken from a column ``nm`` or from the tags."""
    nm = F.col("nm") if "nm" in alignments.columns else F.try_element_at("tags", F.lit("NM")).cast("int")
    return F.lit(1.0) - F.try_divide(nm, cg.aligned_columns("cigar"))


def mapped_ids(alignments, min_id=0.90, keys=("sample", "qname")):
    return (
        alignments.filter(lacks_flag(UNMAPPED) & (alignment_identity(alignments) >= min_id))
        .select(*keys)
        .distinct()
    )


def split_by_alignment(reads, alignments, min_id=0.90):
    """(mapped, unmapped) reads; a read counts as mapped from ``min_id`` identity on."""
    ids = mapped_ids(alignments, min_id).withColumnRenamed("qname", "pair_id")
    keys = ["sample", "pair_id"]
    return reads.join(ids, keys, "left_semi"), reads.join(ids, keys, "left_anti")


# ---------------------------------------------------------------- assemblies


def count_sequences(sequences, by=("sample",)):
    return sequences.groupBy(*by).agg(F.count(F.lit(1)).alias("sequences"))


def assembly_stats(contigs, thresholds=(0, 1000, 5000, 10000, 25000, 50000), by=("sample", "assembler"), min_contig=0):
    """Size and contiguity per assembly, with one contig count per length threshold.

    Contigs are first counted per distinct length. An assembly of T bases has fewer than
    sqrt(2 T) distinct lengths, so the running sums stay small however many contigs there are.
    """
    by = list(by)
    contigs = contigs.filter(F.length("seq") >= min_contig)
    lengths = contigs.groupBy(*by, F.length("seq").cast("bigint").alias("len")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(sq.gc_count("seq")).alias("gc"),
        F.sum(sq.base_count("seq", "N")).alias("unknown"),
    )
    group = Window.partitionBy(*by)
    down = group.orderBy(F.col("len").desc()).rowsBetween(Window.unboundedPreceding, 0)
    swept = lengths.select(
        "*",
        F.sum(F.col("len") * F.col("n")).over(down).alias("cum"),
        F.sum("n").over(down).alias("cum_n"),
        F.sum(F.col("len") * F.col("n")).over(group).alias("total"),
    )

    def nx(share):
        reached = F.col("cum") >= F.col("total") * share
        return F.max(F.when(reached, F.col("len")))

    def lx(share):
        # Contigs before the length at which the share is reached, then as many of that length.
        target = F.col("total") * share
        before = F.col("cum") - F.col("len") * F.col("n")
        reached_here = (F.col("cum") >= target) & (before < target)
        inside = F.ceil((target - before) / F.col("len"))
        return F.max(F.when(reached_here, F.col("cum_n") - F.col("n") + inside)).cast("bigint")

    counts = [
        F.sum(F.when(F.col("len") >= t, F.col("n")).otherwise(0)).alias(f"contigs_{t}")
        for t in thresholds
    ]
    return swept.groupBy(*by).agg(
        F.sum("n").alias("contigs"),
        *counts,
        F.max("total").alias("total_length"),
        F.max("len").alias("largest"),
        F.try_divide(F.lit(100.0) * F.sum("gc"), F.max("total") - F.sum("unknown")).alias("gc_percent"),
        nx(0.5).alias("n50"),
        lx(0.5).alias("l50"),
        nx(0.75).alias("n75"),
        lx(0.75).alias("l75"),
        F.try_divide(F.lit(100000.0) * F.sum("unknown"), F.max("total")).alias("n_per_100kbp"),
    )


# ---------------------------------------------------------------- sketches


def _smallest(hashes, key, size):
    """The ``size`` smallest distinct hashes of each key, numbered from 1."""
    # row_number() <= size is pushed below the shuffle as a per-task group limit.
    order = Window.partitionBy(key).orderBy("hash")
    return hashes.select(key, "hash").distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= size)


def sketches(sequences, key, k=31, size=1000, hash_of=None):
    """Bottom-``size`` sketch of the canonical k-mers of each key: (key, hash, rank), one row per hash.

    Hashes are xxhash64 of packed words; ``hash_of`` is a function of a k-mer's text instead (up to
    32 bases). Words are told apart before they are hashed.
    """
    words = pk.explode_words(sequences, k, key, canonical=True).select(key, "word").distinct()
    hashed = F.xxhash64("word") if hash_of is None else hash_of(pk.unpacked("word", k))
    return _smallest(words.select(key, hashed.alias("hash")), key, size)


def merge_sketches(sketched, into, size=1000):
    """Sketches of larger units (a column ``into``) from those of their parts: the smallest hashes of the union.

    The same rows as a sketch of all the sequences, if the parts were sketched with ``size`` or more.
    """
    return _smallest(sketched, into, size)


def keep_sketches(sequences, path, key, k=31, size=1000, hash_of=None):
    """The sketches stored at ``path``, with those of the sequences whose key is not there yet added.

    Only new keys are cut into words; the files that are there are not touched. Sequences of one key
    must come together. Parameters are part of the path's meaning: another k or size needs another path.
    """
    spark = sequences.sparkSession
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        sequences = sequences.join(spark.read.parquet(path).select(key).distinct(), key, "left_anti")
    sketches(sequences, key, k, size, hash_of).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def sketch_similarity(left, right, left_key, right_key, size=1000):
    """(left key, right key, shared, similarity) of the pairs of sketches with a hash in common.

    The similarity estimates the Jaccard index: of the ``size`` smallest hashes of the union of both
    sketches, the share that is in both. The i-th common hash is number rank + rank - i of the
    union, so the union itself is never built. Exact for sequences with fewer words than ``size``.
    """
    sizes = lambda df, key: df.groupBy(key).agg(F.max("rank").alias(f"{key}_n"))
    both = left.select(left_key, "hash", F.col("rank").alias("_l")).join(right.select(right_key, "hash", F.col("rank").alias("_r")), "hash")
    order = Window.partitionBy(left_key, right_key).orderBy("hash")
    placed = both.withColumn("_u", F.col("_l") + F.col("_r") - F.row_number().over(order))
    counted = placed.groupBy(left_key, right_key).agg(F.count(F.lit(1)).alias("shared"), F.count(F.when(F.col("_u") <= size, 1)).alias("_low"))
    known = counted.join(sizes(left, left_key), left_key).join(sizes(right, right_key), right_key)
    union = F.least(F.lit(size), F.col(f"{left_key}_n") + F.col(f"{right_key}_n") - F.col("shared"))
    return known.select(left_key, right_key, "shared", (F.col("_low") / union).alias("similarity"))


def sketch_top_hits(contigs, ref_seqs, k=31, size=1000, records=50, hash_of=None):
    """The reference sequences sharing most of an assembly's bottom-``size`` MinHash sketch.

    ``ref_seqs`` are sequences (ref_id, seq) or kept sketches of them (ref_id, hash, rank).
    """
    query = sketches(contigs, "sample", k, size, hash_of)
    target = ref_seqs if "hash" in ref_seqs.columns else sketches(ref_seqs, "ref_id", k, size, hash_of)
    shared = (
        query.join(target, "hash")
        .groupBy("sample", "ref_id")
        .agg(F.count(F.lit(1)).alias("shared"))
    )
    top = Window.partitionBy("sample").orderBy(F.col("shared").desc(), "ref_id")
    return (
        shared.withColumn("rank", F.row_number().over(top))
        .filter(F.col("rank") <= records)
        .withColumn("similarity", F.col("shared") / F.lit(size))
    )
