"""Stable sampling buckets."""

from math import ceil

from pyspark.sql import functions as F

BUCKETS = 1 << 32


def bucket(key, seed=1, how="xxhash64"):
    """A bucket in [0, BUCKETS) that depends on the key and the seed only.

    Rows with one key share a bucket, so mates stay together and a smaller fraction under the
    same seed is a subset of a larger one. ``how="md5"`` gives buckets any SQL engine can repeat.
    """
    keys = [F.col(k) if isinstance(k, str) else k for k in (key if isinstance(key, (list, tuple)) else [key])]
    if how == "md5":
        text = F.concat_ws(":", F.lit(str(seed)), *[k.cast("string") for k in keys])
        return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    if how == "xxhash64":
        return F.pmod(F.xxhash64(F.lit(int(seed)), *keys), F.lit(BUCKETS))
    raise ValueError(f"unknown bucket hash: {how}")


def fraction_limit(fraction):
    return ceil(fraction * BUCKETS)
