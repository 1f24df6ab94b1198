"""Column expressions over bases and qualities."""

from pyspark.sql import functions as F

from . import packed as pk

# Phred offset of the FASTQ files, IUPAC bases taken part in k-mers.
PHRED_OFFSET = 33
BASES = "ACGT"


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def reverse_complement(seq):
    return F.translate(F.reverse(_col(seq)), "ACGTacgt", "TGCAtgca")


def phred_scores(qual):
    """Quality string -> array<int>."""
    qual = _col(qual)
    return F.transform(
        F.filter(F.split(qual, ""), lambda ch: ch != ""), lambda ch: F.ascii(ch) - F.lit(PHRED_OFFSET)
    )


def canonical(kmer):
    """The smaller of a k-mer and its reverse complement."""
    kmer = _col(kmer)
    return F.least(kmer, reverse_complement(kmer))


def base_count(seq, base):
    """Occurrences of a base, soft-masked (lower case) ones included."""
    seq = F.upper(_col(seq))
    return F.length(seq) - F.length(F.replace(seq, F.lit(base), F.lit("")))


def gc_count(seq):
    return base_count(seq, "G") + base_count(seq, "C")


def base_quality_sum(qual, floor=15):
    """Sum of the base qualities that reach ``floor``."""
    return F.aggregate(
        phred_scores(qual),
        F.lit(0).cast("bigint"),
        lambda acc, q: acc + F.when(q >= floor, q).otherwise(0).cast("bigint"),
    )


# Sequences are cut into pieces of this many k-mer starts: finding a place in a string costs
# time in proportion to the place, and a chromosome must not become one array of k-mers.
PIECE = 256


def _pieces(seq, k):
    whole = F.length(seq) <= PIECE + k - 1
    overlapping = F.regexp_extract_all(
        seq, F.lit(f"(?s)(?=(.{{1,{PIECE + k - 1}}})).{{1,{PIECE}}}"), F.lit(1)
    )
    return F.when(whole, F.array(seq)).otherwise(overlapping)


def explode_kmers(df, k, *keep, seq="seq", canonical=False, as_numbers=False):
    """One row per k-mer of A, C, G, T: the kept columns, ``pos`` (0-based) and ``kmer``.

    ``as_numbers`` gives each k-mer packed (``functions.packed``) in place of its text, which is all that
    telling them apart takes: 8 bytes to shuffle (16 from 33 bases on).

    Soft-masked (lower case) bases count like others. With ``canonical`` the smaller of the k-mer and its reverse complement is given; the strand is
    complemented once per piece, not per k-mer.
    """
    if as_numbers:
        return pk.explode_words(df, k, *keep, seq=seq, canonical=canonical).withColumnRenamed("word", "kmer")
    text = F.upper(_col(seq))
    clean = F.when(text.rlike(f"[^{BASES}]"), F.regexp_replace(text, f"[^{BASES}]", "N")).otherwise(text)
    pieces = (
        df.select(*keep, clean.alias("_clean"))
        .select(*keep, F.posexplode(_pieces(F.col("_clean"), k)).alias("_piece", "_text"))
        .filter(F.length("_text") >= k)
    )
    size = F.length("_text")
    backward = [reverse_complement("_text").alias("_back")] if canonical else []
    placed = pieces.select(
        *keep, "_piece", "_text", size.alias("_size"), *backward
    ).select("*", F.explode(F.sequence(F.lit(1), F.col("_size") - k + 1)).alias("_at"))
    kmer = F.substring(F.col("_text"), F.col("_at"), F.lit(k))
    if canonical:
        other = F.substring(F.col("_back"), F.col("_size") - F.col("_at") - k + 2, F.lit(k))
        kmer = F.least(kmer, other)
    return placed.select(
        *keep, (F.col("_piece") * PIECE + F.col("_at") - 1).alias("pos"), kmer.alias("kmer")
    ).filter(~F.contains("kmer", F.lit("N")))
