"""Join sides whose size Spark's statistics cannot foresee.

Exploding sequences into k-mers multiplies rows by hundreds, which static estimates ignore. Such
a side is stored first, so that Spark knows its bytes and broadcasts or shuffles it by its own
size check.
"""

from ..session import scratch_path


def shuffled(df):
    """A side that is never broadcast; both sides are shuffled and skewed partitions split."""
    return df.hint("merge")


def settled(df, name="settled"):
    """``df`` written to the shared scratch folder and read again: its size is then known."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
