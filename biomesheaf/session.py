"""Session defaults and the shared scratch folder."""

import os
import uuid

from pyspark.sql import SparkSession


def cohort_session(app_name="biomesheaf", master=None, shuffle_partitions=None, driver_memory=None, scratch=None):
    """A session with the settings the operators are written for.

    Joins between tables are left to Spark, which broadcasts a side only after its own size
    check and otherwise shuffles, splitting skewed partitions; tables whose sizes it cannot foresee
    are stored first (``functions.joins``). ``scratch`` is a folder that driver and executors share.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # A join side whose shuffled partitions are all below this is hashed, and the other side not sorted.
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64m")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    if scratch:
        builder = builder.config("spark.checkpoint.dir", scratch)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def scratch_path(spark, name):
    """A fresh folder below the shared folder named by ``spark.checkpoint.dir``."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError("name a folder that driver and executors share in spark.checkpoint.dir")
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")
