"""Scratch tables in the shared folder, and expressions that several operators use."""

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_own_folder = []


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; one of our own only where that is unset and all is local (tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("name a folder that driver and executors share in spark.checkpoint.dir")
    if not _own_folder:
        _own_folder.append(tempfile.mkdtemp(prefix="llm-"))
    return _own_folder[0]


def fresh_path(spark: SparkSession, name: str) -> str:
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")


#: Rows that go to Python at once: whole texts and sets of shingles are large rows.
BATCH_ROWS, BATCH = 1000, "spark.sql.execution.arrow.maxRecordsPerBatch"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it again: later jobs start there.

    While it is written, batches for Python are kept to BATCH_ROWS rows; the session's setting is put back.
    """
    spark, path = df.sparkSession, fresh_path(df.sparkSession, name)
    usual = spark.conf.get(BATCH)
    spark.conf.set(BATCH, str(BATCH_ROWS))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(BATCH, usual)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(text) -> Column:
    return F.translate(text, UPPER, LOWER)


def fold(column: str, parts: int) -> Column:
    """crc32 of the value as text, modulo ``parts``; a null counts as the text ``null``."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("null")).cast("binary")) % parts


def unit(column: str, seed: str) -> Column:
    """A number in [0, 1) that depends on the value and the seed only; other engines compute the same."""
    text = F.concat(F.lit(seed + ":"), F.coalesce(F.col(column).cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / float(2**52)


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """Names a document by its id and text, nulls included; equal for equal rows only."""
    return F.concat_ws(
        ":",
        F.coalesce(F.col(id_col).cast("string"), F.lit("null")),
        F.coalesce(F.xxhash64(text_col).cast("string"), F.lit("")),
        F.coalesce(F.length(text_col).cast("string"), F.lit("null")),
    )
