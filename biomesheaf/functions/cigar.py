"""Column expressions over CIGAR strings (SAM specification)."""

from pyspark.sql import functions as F

from .sequences import _col

# CIGAR operations by what they consume.
REF_OPS = ("M", "D", "N", "=", "X")
READ_OPS = ("M", "I", "S", "=", "X")
MATCH_OPS = ("M", "=", "X")
CLIP_OPS = ("S", "H")
COLUMN_OPS = ("M", "I", "D", "=", "X")


def operations(cigar):
    """array<struct<n int, op string>>"""
    cigar = _col(cigar)
    lengths = F.regexp_extract_all(cigar, F.lit("(\\d+)[MIDNSHP=X]"), F.lit(1))
    codes = F.regexp_extract_all(cigar, F.lit("\\d+([MIDNSHP=X])"), F.lit(1))
    return F.zip_with(
        lengths, codes, lambda n, op: F.struct(n.cast("int").alias("n"), op.alias("op"))
    )


def _consumed(ops, codes):
    return F.aggregate(
        F.filter(ops, lambda o: o["op"].isin(*codes)), F.lit(0), lambda acc, o: acc + o["n"]
    )


def _is_single_match(cigar):
    return _col(cigar).rlike("^\\d+M$")


def reference_span(cigar):
    """Reference bases covered. The common all-match alignment skips the array work."""
    cigar = _col(cigar)
    return F.when(_is_single_match(cigar), F.regexp_extract(cigar, "^(\\d+)M$", 1).try_cast("int")).otherwise(
        _consumed(operations(cigar), REF_OPS)
    )


def aligned_columns(cigar):
    return _consumed(operations(cigar), COLUMN_OPS)


def _clipped(cigar, pattern):
    return F.coalesce(F.regexp_extract(cigar, pattern, 1).try_cast("int"), F.lit(0))


def unclipped_five_prime(pos, cigar, reverse):
    """Position of the 5' end as if clipped bases were aligned."""
    pos, cigar = _col(pos), _col(cigar)
    lead = _clipped(cigar, "^(?:\\d+H)?(\\d+)S") + _clipped(cigar, "^(\\d+)H")
    tail = _clipped(cigar, "(\\d+)S(?:\\d+H)?$") + _clipped(cigar, "(\\d+)H$")
    return F.when(reverse, pos + reference_span(cigar) - 1 + tail).otherwise(pos - lead)


def match_blocks(cigar):
    """Gap-free blocks: array<struct<read_off int, ref_off int, n int>>, 0-based offsets."""
    start = F.struct(
        F.lit(0).alias("read_off"),
        F.lit(0).alias("ref_off"),
        F.expr("cast(array() as array<struct<read_off:int,ref_off:int,n:int>>)").alias("blocks"),
    )

    def step(acc, o):
        block = F.struct(
            acc["read_off"].alias("read_off"), acc["ref_off"].alias("ref_off"), o["n"].alias("n")
        )
        return F.struct(
            (acc["read_off"] + F.when(o["op"].isin(*READ_OPS), o["n"]).otherwise(0)).alias("read_off"),
            (acc["ref_off"] + F.when(o["op"].isin(*REF_OPS), o["n"]).otherwise(0)).alias("ref_off"),
            F.when(o["op"].isin(*MATCH_OPS), F.concat(acc["blocks"], F.array(block)))
            .otherwise(acc["blocks"])
            .alias("blocks"),
        )

    return F.aggregate(operations(cigar), start, step, lambda acc: acc["blocks"])
