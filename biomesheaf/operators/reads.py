"""Read processing. A read row is one mate: (sample, pair_id, mate, seq, qual)."""

import math
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import packed as pk
from ..functions import sequences as sq
from ..functions.joins import settled
from ..functions.kernels import (
    adapter_cut_udf,
    longest_overlap_udf,
    quality_adapter_cut_udf,
    quality_cut_udf,
)
from ..functions.sampling import bucket, fraction_limit
from .alignments import FIRST_MATE, REVERSE, SECOND_MATE, has_flag, lacks_flag

PAIR = ["sample", "pair_id"]

# ---------------------------------------------------------------- pairs


def verify_pairs(reads):
    """Pairs that do not consist of exactly mates 1 and 2, with their mate counts."""
    return (
        reads.groupBy(*PAIR)
        .agg(
            F.count(F.lit(1)).alias("reads"),
            F.sum((F.col("mate") == 1).cast("int")).alias("mate1"),
            F.sum((F.col("mate") == 2).cast("int")).alias("mate2"),
        )
        .filter((F.col("reads") != 2) | (F.col("mate1") != 1) | (F.col("mate2") != 1))
    )


def require_pairs(reads):
    """Raise when a pair is broken, else return the reads."""
    broken = verify_pairs(reads).limit(5).collect()
    if broken:
        raise ValueError(f"broken pairs: {broken}")
    return reads


def interleave(r1, r2):
    """First and second mates as one reads table."""
    columns = [*PAIR, "seq", "qual"]
    one = r1.select(*columns).withColumn("mate", F.lit(1))
    two = r2.select(*columns).withColumn("mate", F.lit(2))
    return one.unionByName(two).select(*PAIR, "mate", "seq", "qual")


def deinterleave(reads):
    """One row per pair with the bases and qualities of both mates."""
    def of_mate(n, column):
        return F.first(F.when(F.col("mate") == n, F.col(column)), ignorenulls=True).alias(f"{column}{n}")

    return reads.groupBy(*PAIR).agg(
        *[of_mate(n, column) for n in (1, 2) for column in ("seq", "qual")]
    )


# ---------------------------------------------------------------- trimming


#: Bases of all adapters together; a panel is a hand-kept list and its tables travel with the tasks.
PANEL_BASES = 4_000_000


def _adapter_panel(adapters):
    """The sequences of a panel in upper case; its size is checked before it is fetched."""
    if isinstance(adapters, DataFrame):
        listed = adapters.filter("seq is not null").select(F.upper("seq").alias("seq")).distinct()
        size = listed.agg(F.coalesce(F.sum(F.length("seq")), F.lit(0)).alias("bases")).first().bases
        if size > PANEL_BASES:
            raise ValueError(f"{size} bases are no adapter panel (at most {PANEL_BASES}); screen reads by kmer_screen")
        adapters = [r["seq"] for r in listed.orderBy("seq").collect()]
    return [a.upper() for a in adapters]


def _keep_first(reads, kept):
    cut = reads.withColumn("_kept", kept)
    return cut.withColumns(
        {
            "seq": F.substring(F.col("seq"), F.lit(1), F.col("_kept")),
            "qual": F.substring(F.col("qual"), F.lit(1), F.col("_kept")),
        }
    ).drop("_kept")


def trim_adapters(reads, adapters, error_rate=0.1, min_overlap=3):
    """Cut each mate at the leftmost adapter match; the number of reads stays the same.

    A match is the whole adapter or its start running off the read's end, over at least
    ``min_overlap`` bases with at most ``error_rate`` mismatches.
    """
    cut = adapter_cut_udf(_adapter_panel(adapters), error_rate, min_overlap)
    return _keep_first(reads, cut(F.upper("seq")))


def quality_trim(reads, cutoff=10):
    """Trim the 3' end by the running-sum rule at the given quality."""
    return _keep_first(reads, quality_cut_udf(cutoff)(F.col("qual")))


def filter_pairs_by_length(reads, min_len=50, policy="any"):
    """Drop pairs with any mate (or, ``policy="both"``, only pairs with both mates) too short."""
    pair = Window.partitionBy(*PAIR)
    if policy not in ("any", "both"):
        raise ValueError(f"unknown pair policy: {policy}")
    decisive = F.min if policy == "any" else F.max
    return (
        reads.withColumn("_len", decisive(F.length("seq")).over(pair))
        .filter(F.col("_len") >= min_len)
        .drop("_len")
    )


def trim_and_filter(reads, adapters, cutoff=10, min_len=50, error_rate=0.1, min_overlap=3):
    """Quality trim, then adapters (both in one pass over the batch), then the length filter."""
    cut = quality_adapter_cut_udf(cutoff, _adapter_panel(adapters), error_rate, min_overlap)
    trimmed = _keep_first(reads, cut(F.upper("seq"), F.col("qual")))
    return filter_pairs_by_length(trimmed, min_len)


# ---------------------------------------------------------------- k-mer screens


def contaminant_words(refs, k=31):
    """(ref_id, word): packed k-mers of both strands of the references."""
    strands = refs.select("ref_id", F.explode(F.array("seq", sq.reverse_complement("seq"))).alias("seq"))
    return pk.explode_words(strands, k, "ref_id").select("ref_id", "word").distinct()


def _by_halves(words, k, *keep):
    """Every word under two keys, its halves; two words that differ in at most one base share one of them."""
    left, right = pk.halves("word", k)
    sides = [F.struct(F.lit(i).alias("side"), key.alias("key"), other.alias("other")) for i, (key, other) in enumerate([(left, right), (right, left)])]
    return words.select(*keep, F.explode(F.array(*sides)).alias("half")).select(*keep, "half.*")


def _screen_hits(reads, refs, k, hdist, by, of_refs, how):
    """Columns ``by`` of the reads with a contaminant word (joined with ``of_refs`` of the references).

    With one mismatch allowed a word is looked up by both halves and the other halves are compared
    bit by bit: two rows a reference word, and no table of variants. Only the reference side knows both
    strands, so reads are cut once. The reference rows are stored first: Spark then broadcasts those of a
    small reference, so that no read word is shuffled, and shuffles those of a host genome.
    """
    if hdist not in (0, 1):
        raise ValueError("hdist is 0 or 1")
    known = contaminant_words(refs, k).select(*of_refs, "word").distinct()
    words = pk.explode_words(reads, k, *by)
    if hdist == 0:
        return words.join(settled(known, "contaminants"), "word", how)
    known = settled(_by_halves(known, k, *of_refs), "contaminants").alias("known")
    words = _by_halves(words, k, *by).alias("words")
    same = (F.col("words.side") == F.col("known.side")) & (F.col("words.key") == F.col("known.key"))
    near = pk.differing_bases(F.col("words.other"), F.col("known.other")) <= 1
    return words.join(known, same & near, how).select(*[f"words.{c}" for c in by], *[f"known.{c}" for c in of_refs])


def screened_pairs(reads, refs, k=31, hdist=1):
    """Pairs with a mate holding a contaminant k-mer, or one that differs from it in one base."""
    return _screen_hits(reads, refs, k, hdist, PAIR, [], "left_semi").select(*PAIR).distinct()


def kmer_screen(reads, refs, k=31, hdist=1):
    """(kept, removed): a pair goes when either mate has a contaminant k-mer."""
    hit = screened_pairs(reads, refs, k, hdist)
    return reads.join(hit, PAIR, "left_anti"), reads.join(hit, PAIR, "left_semi")


def kmer_screen_stats(reads, refs, k=31, hdist=1):
    """Reads matching each reference, as a count and as a percentage of the sample's reads."""
    matched = (
        _screen_hits(reads, refs, k, hdist, [*PAIR, "mate"], ["ref_id"], "inner")
        .select("sample", "ref_id", "pair_id", "mate")
        .distinct()
        .groupBy("sample", "ref_id")
        .agg(F.count(F.lit(1)).alias("reads"))
    )
    totals = reads.groupBy("sample").agg(F.count(F.lit(1)).alias("total"))
    return matched.join(totals, "sample").select(
        "sample", "ref_id", "reads", (F.lit(100.0) * F.col("reads") / F.col("total")).alias("percent")
    )


def kmer_cardinality(reads, k=31, rsd=0.05):
    """Approximate number of distinct canonical k-mers per sample."""
    words = pk.explode_words(reads, k, "sample", canonical=True)
    return words.groupBy("sample").agg(F.approx_count_distinct("word", rsd).alias("kmers"))


def cardinality_sketches(reads, k=31, lg_size=12):
    """One HyperLogLog sketch of the distinct canonical k-mers per sample: (sample, sketch). To be stored.

    The relative standard error of its estimate is about 0.8 / sqrt(2 ** lg_size), 1.3 % by default.
    """
    words = pk.explode_words(reads, k, "sample", canonical=True)
    hashed = F.col("word") if k <= pk.ONE else F.xxhash64("word")
    return words.groupBy("sample").agg(F.hll_sketch_agg(hashed, F.lit(lg_size)).alias("sketch"))


def cohort_cardinality(sketches, *by):
    """Distinct k-mers of groups of samples from stored sketches, reads not looked at: (by..., samples, kmers).

    A k-mer of several samples counts once. Without ``by`` the cohort is all samples.
    """
    merged = sketches.groupBy(*by).agg(F.count(F.lit(1)).alias("samples"), F.hll_union_agg("sketch").alias("sketch"))
    return merged.select(*by, "samples", F.hll_sketch_estimate("sketch").alias("kmers"))


#: Bases of a minimizer.
MINIMIZER = 13


def toss_low_depth_reads(reads, k=32, depth=4):
    """Drop pairs holding a k-mer seen at most ``depth`` times in the sample.

    Runs of k-mers that share a minimizer travel as one row of packed bases, dealt by sample and
    minimizer, and are cut into words and counted where they arrive. Both strands of a word have the
    same minimizer, so all its occurrences meet. Equal runs of a batch that are seen more often than
    ``depth`` leave as one row, so sequence that much of a sample repeats does not gather in one task.
    """
    name, owner = (reads.schema[c].dataType.simpleString() for c in PAIR)
    cut = pk.pieces(reads, k, "sample", F.col("pair_id").alias("owner")).select("sample", "owner", F.col("bases").alias("seq"))
    runs = cut.mapInArrow(
        pk.run_batches(k, min(MINIMIZER, k), depth), f"sample {name}, owner {owner}, minimizer bigint, size int, bases binary, n bigint"
    )
    dealt = runs.repartition("sample", "minimizer").sortWithinPartitions("sample", "minimizer")
    tossed = dealt.mapInArrow(pk.rare_owners(k, depth), f"sample {name}, owner {owner}").select("sample", F.col("owner").alias("pair_id"))
    return reads.join(tossed.distinct(), PAIR, "left_anti")


# ---------------------------------------------------------------- host removal, sampling


def unaligned_pairs(alignments):
    """Reads of the pairs whose both mates are unmapped, primary records only."""
    both_unmapped = has_flag(4 | 8) & lacks_flag(256) & lacks_flag(2048)
    mate = F.when(has_flag(SECOND_MATE), 2).when(has_flag(FIRST_MATE), 1)
    flipped = has_flag(REVERSE)
    columns = [
        "sample",
        F.col("qname").alias("pair_id"),
        mate.alias("mate"),
        F.when(flipped, sq.reverse_complement("seq")).otherwise(F.col("seq")).alias("seq"),
    ]
    if "qual" in alignments.columns:
        columns.append(F.when(flipped, F.reverse("qual")).otherwise(F.col("qual")).alias("qual"))
    return alignments.filter(both_unmapped).select(*columns)


def drop_sequences_by_id(sequences, remove="both"):
    """Remove the viral and/or mitochondrial record of a host genome."""
    # Record names.
    names = {"EBV": ["chrEBV"], "MT": ["chrM"], "both": ["chrEBV", "chrM"]}
    if remove not in names:
        raise ValueError(f"remove must be one of {sorted(names)}")
    return sequences.filter(~F.col("ref_id").isin(names[remove]))


def subsample(df, fraction, seed=1, key="pair_id", how="xxhash64"):
    """Keep a fraction of the keys; mates stay together, smaller fractions are subsets."""
    return df.filter(bucket(key, seed, how) < fraction_limit(fraction))


# ---------------------------------------------------------------- tracking

TRACK_STAGES = ("input", "no_adapter", "filtered", "decontaminated", "qtrimmed")


def track_reads(stages):
    """Reads per sample after each stage; ``stages`` maps stage name -> reads."""
    unknown = set(stages) - set(TRACK_STAGES)
    if unknown:
        raise ValueError(f"unknown stages: {sorted(unknown)}")
    tagged = reduce(
        DataFrame.unionByName,
        [df.select("sample", F.lit(name).alias("stage")) for name, df in stages.items()],
    )
    return tagged.groupBy("sample").agg(
        *[F.count(F.when(F.col("stage") == s, 1)).alias(s) for s in TRACK_STAGES]
    )


# ---------------------------------------------------------------- merging


def _overlapped(reads, min_overlap, error_rate):
    pairs = deinterleave(reads).withColumns(
        {"rc2": sq.reverse_complement("seq2"), "rq2": F.reverse("qual2")}
    )
    overlap = longest_overlap_udf(error_rate, min_overlap)
    return pairs.withColumn("overlap", overlap(F.col("seq1"), F.col("rc2")))


def _merged(pairs):
    def split_at(first, second):
        """(before, overlap of the first, overlap of the second, after)"""
        before = F.length(first) - F.col("overlap")
        return (
            F.substring(F.col(first), F.lit(1), before),
            F.substring(F.col(first), before + 1, F.col("overlap")),
            F.substring(F.col(second), F.lit(1), F.col("overlap")),
            F.substring(F.col(second), F.col("overlap") + 1, F.length(second)),
        )

    s_before, s1, s2, s_after = split_at("seq1", "rc2")
    q_before, q1, q2, q_after = split_at("qual1", "rq2")
    cells = F.arrays_zip(
        *[F.split(c, "").alias(n) for c, n in ((s1, "b1"), (s2, "b2"), (q1, "q1"), (q2, "q2"))]
    )
    base = F.transform(cells, lambda c: F.when(c["q1"] >= c["q2"], c["b1"]).otherwise(c["b2"]))
    quality = F.transform(cells, lambda c: F.greatest(c["q1"], c["q2"]))
    return pairs.filter(F.col("overlap") > 0).select(
        *PAIR,
        "overlap",
        F.concat(s_before, F.concat_ws("", base), s_after).alias("seq"),
        F.concat(q_before, F.concat_ws("", quality), q_after).alias("qual"),
    )


def merge_overlapping_pairs(reads, min_overlap=12, error_rate=0.05):
    """(merged, unmerged): mates joined over their longest overlap.

    In the overlap the base of higher quality wins, the first mate's on ties. ``unmerged``
    holds the mates of the other pairs.
    """
    pairs = _overlapped(reads, min_overlap, error_rate)
    apart = pairs.filter(F.col("overlap") == 0).select(
        *PAIR,
        F.inline(
            F.array(
                F.struct(F.lit(1).alias("mate"), F.col("seq1").alias("seq"), F.col("qual1").alias("qual")),
                F.struct(F.lit(2).alias("mate"), F.col("seq2").alias("seq"), F.col("qual2").alias("qual")),
            )
        ),
    )
    return _merged(pairs), apart


def insert_size_histogram(merged):
    return merged.groupBy("sample", F.length("seq").alias("insert_size")).agg(
        F.count(F.lit(1)).alias("pairs")
    )


# ---------------------------------------------------------------- quality control


def _fingerprint():
    """Two 64-bit hashes that stand for a sequence, so that no bases are shuffled."""
    return [F.xxhash64("seq").alias("_h1"), F.xxhash64(F.lit(1), F.col("seq")).alias("_h2")]


def qc_summary(reads):
    """Per sample: reads, bases, GC and N percent, share of reads that repeat another.

    Sequences are told apart by 128 bits of hashes.
    """
    sums = {"reads": F.lit(1), "bases": F.length("seq"), "gc": sq.gc_count("seq"), "n": sq.base_count("seq", "N")}
    by_sequence = (
        reads.select("sample", *_fingerprint(), *[value.alias(name) for name, value in sums.items()])
        .groupBy("sample", "_h1", "_h2")
        .agg(*[F.sum(name).alias(name) for name in sums])
    )
    return by_sequence.groupBy("sample").agg(
        F.sum("reads").alias("reads"),
        F.sum("bases").alias("bases"),
        F.try_divide(F.lit(100.0) * F.sum("gc"), F.sum("bases")).alias("gc_percent"),
        F.try_divide(F.lit(100.0) * F.sum("n"), F.sum("bases")).alias("n_percent"),
        (F.lit(1.0) - F.count(F.lit(1)) / F.sum("reads")).alias("duplicate_fraction"),
    )


def qc_length_distribution(reads):
    return reads.groupBy("sample", F.length("seq").alias("length")).agg(
        F.count(F.lit(1)).alias("reads")
    )


def qc_position_quality(reads):
    """Mean and quartiles of the quality per sample, mate and read position (from 1).

    A quartile is the smallest quality reached by that share of the reads. It is read off the
    counts per quality value, of which a position has fewer than a hundred.
    """
    counts = (
        reads.select("sample", "mate", F.posexplode(sq.phred_scores("qual")).alias("p", "q"))
        .groupBy("sample", "mate", "p", "q")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    place = Window.partitionBy("sample", "mate", "p")
    running = place.orderBy("q").rowsBetween(Window.unboundedPreceding, 0)
    swept = counts.withColumns({"cum": F.sum("n").over(running), "total": F.sum("n").over(place)})

    def quantile(share):
        return F.min(F.when(F.col("cum") >= F.col("total") * share, F.col("q")))

    return swept.groupBy("sample", "mate", (F.col("p") + 1).alias("position")).agg(
        (F.sum(F.col("q") * F.col("n")) / F.sum("n")).alias("mean_quality"),
        quantile(0.25).alias("q1"),
        quantile(0.5).alias("median"),
        quantile(0.75).alias("q3"),
    )


def qc_mean_quality_histogram(reads):
    """Reads per rounded-down mean quality."""
    scores = sq.phred_scores("qual")
    total = F.aggregate(scores, F.lit(0), lambda acc, q: acc + q)
    mean = F.floor(F.try_divide(total, F.size(scores))).cast("int")
    return reads.groupBy("sample", mean.alias("mean_quality")).agg(F.count(F.lit(1)).alias("reads"))


#: Shares below this would need a larger sketch than Spark makes; their candidates are counted by hash.
SKETCHED_SHARE = 1e-4


def _frequent_candidates(reads, share):
    """(sample, _h1) of all sequences over the share, and of some others."""
    hashed = reads.select("sample", F.xxhash64("seq").alias("_h1"))
    if share < SKETCHED_SHARE:
        total = F.sum("reads").over(Window.partitionBy("sample"))
        counted = hashed.groupBy("sample", "_h1").agg(F.count(F.lit(1)).alias("reads")).withColumn("_total", total)
        return counted.filter(F.col("reads") > F.col("_total") * share).select("sample", "_h1")
    # Counts of the sketch are off by at most 3.5 in ``tracked`` of all reads, less than half the share. So
    # it holds every sequence over the share, and what it counts as more is over half of it: under 2 / share.
    tracked = math.ceil(8 / share)
    top = F.expr(f"approx_top_k(_h1, {math.ceil(4 / share)}, {tracked})")
    return hashed.groupBy("sample").agg(top.alias("top")).select("sample", F.explode("top.item").alias("_h1"))


def qc_overrepresented(reads, share=0.001):
    """Sequences making up more than the given share of a sample's reads.

    A mergeable sketch of frequent hashes names candidates; these alone are counted, exactly. Only sketches
    and candidates are shuffled, however many distinct sequences there are.
    """
    totals = reads.groupBy("sample").agg(F.count(F.lit(1)).alias("total"))
    candidates = settled(_frequent_candidates(reads, share), "frequent")
    counted = (
        reads.withColumn("_h1", F.xxhash64("seq"))
        .join(candidates, ["sample", "_h1"], "left_semi")
        .groupBy("sample", "seq")
        .agg(F.count(F.lit(1)).alias("reads"))
    )
    return (
        counted.join(totals, "sample")
        .filter(F.col("reads") > F.col("total") * share)
        .select("sample", "seq", "reads", (F.lit(100.0) * F.col("reads") / F.col("total")).alias("percent"))
    )


def read_qc(reads):
    """All quality tables by name."""
    return {
        "summary": qc_summary(reads),
        "length": qc_length_distribution(reads),
        "position_quality": qc_position_quality(reads),
        "mean_quality": qc_mean_quality_histogram(reads),
        "overrepresented": qc_overrepresented(reads),
    }
