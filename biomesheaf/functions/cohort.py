"""Helpers for tables that hold one row set per sample."""

from pyspark.sql import functions as F


def sample_list(df):
    """The sample names of a table as a one-cell scalar subquery (array<string>).

    Its size is the number of samples of the cohort, never the number of reads; the names are
    combined map-side before they reach the single result row.
    """
    return df.select("sample").distinct().agg(F.array_sort(F.collect_set("sample"))).scalar()


def per_sample(table, samples):
    """Give a table shared by all samples a ``sample`` column; leave per-sample tables alone."""
    if "sample" in table.columns:
        return table
    return table.withColumn("sample", F.explode(sample_list(samples)))
