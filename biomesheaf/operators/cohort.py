"""Cohort summaries."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def low_yield_samples(track_reads, min_reads=1_000_000):
    """Samples with fewer input reads than ``min_reads``, a number or a one-cell scalar subquery."""
    return track_reads.filter(F.col("input") < min_reads).select("sample", "input")


def stage_completion(manifest, stage_outputs):
    """Samples in the manifest and, per stage, how many of them have output.

    ``stage_outputs`` maps stage name -> table with a ``sample`` column. Outputs are reduced
    to distinct samples before they meet.
    """
    listed = manifest.select("sample").distinct()
    total = listed.select(F.lit("samples").alias("stage"), "sample")
    done = [
        df.select("sample").distinct().join(listed, "sample", "left_semi").select(
            F.lit(name).alias("stage"), "sample"
        )
        for name, df in stage_outputs.items()
    ]
    empty = [
        listed.sparkSession.range(1).select(F.lit(name).alias("stage"), F.lit(None).cast("string").alias("sample"))
        for name in stage_outputs
    ]
    every = reduce(DataFrame.unionByName, [total, *done, *empty])
    return every.groupBy("stage").agg(F.count_distinct("sample").alias("samples"))
