"""Exact dedup: sorted runs of digests, merged in binomial rounds between partitions."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import stored

BLANKS = " \t\n\x0b\x0c\r"
#: Binomial levels of one round: runs of 2**LEVELS partitions are merged at once.
LEVELS = 4
NAME = ("digest", "chars")


def normalised(text) -> Column:
    """The text without blanks and the characters 0x09-0x0D; null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), BLANKS, "")


def _described(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A row's id, digest and length of its normalised text, and its order among equal texts.

    ``best`` is smaller for more code points of the original text, then for the smaller id (rows
    without one last), then for the earlier row of equal ones.
    """
    bare = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("bare", normalised(F.col("text")))
    return bare.select(
        "id",
        F.unhex(F.sha2(F.col("bare").cast("binary"), 256)).alias("digest"),
        F.length("bare").alias("chars"),
        F.spark_partition_id().alias("rank"),
        F.struct((-F.length("text")).alias("shorter"), F.col("id").isNull().alias("nameless"), "id", F.monotonically_increasing_id().alias("row")).alias("best"),
    )


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each stretch of equal names in the order read; the last of a batch waits for the next."""
    held = None

    def folded(t: pa.Table) -> pa.Table:
        differs = np.zeros(t.num_rows, bool)
        differs[0] = True
        for c in ("rank", *NAME):
            x = t.column(c).combine_chunks()
            differs[1:] |= pc.not_equal(x[1:], x[:-1]).to_numpy(zero_copy_only=False)
        at = np.flatnonzero(differs)
        n = np.add.reduceat(t.column("n").to_numpy(), at)
        where = t.schema.get_field_index("n")
        return t.take(pa.array(at)).set_column(where, t.schema.field(where), pa.array(n))

    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        t = folded(pa.concat_tables([held, t]) if held is not None else t)
        held = t.slice(t.num_rows - 1)
        yield from t.slice(0, t.num_rows - 1).combine_chunks().to_batches()
    if held is not None:
        yield from held.combine_chunks().to_batches()


def tree_merged(runs: DataFrame, places: int) -> DataFrame:
    """(digest, chars, best, n) of the sorted runs: one row per name, ``n`` added up, the smallest ``best``.

    Runs lie at places (their rank). A round takes the next LEVELS bits of the place: the 2**LEVELS
    places that differ in these bits only exchange pieces of their runs, each taking the digests with
    its own bits, and merge what they get in digest order. So after each round a place holds what a
    binomial tree over so many runs would have merged, for its share of the digests, and at the end
    its range of digests of all runs. No place ever holds more than its share, and a name, however
    frequent, is one row per place. Two rows are merged only if the whole SHA-256 and the length agree.
    """
    bits = max(1, (places - 1).bit_length())
    key = F.shiftright(F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long"), 32 - bits)
    merged = runs.withColumn("place", F.pmod(F.col("rank"), F.lit(1 << bits)).cast("long"))
    for low in range(0, bits, LEVELS):
        own = ((1 << min(LEVELS, bits - low)) - 1) << low
        place = F.col("place").bitwiseAND(~own & ((1 << bits) - 1)).bitwiseOR(key.bitwiseAND(own))
        sent = merged.withColumn("place", place).repartitionById(1 << bits, F.col("place").cast("int")).sortWithinPartitions("place", *NAME)
        merged = sent.groupBy("place", *NAME).agg(F.min("best").alias("best"), F.sum("n").alias("n"))
    return merged.drop("place")


def exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, keep_id, group_size, kept, digest, row) of every row of ``docs``.

    Texts are equal if they are the same after blanks and 0x09-0x0D are taken out. Of equal texts the
    row with the most code points as written stays, then the one with the smallest id; keep_id is its
    id, group_size the rows of the group, digest the SHA-256 of the text without blanks.

    1. Every partition sorts its rows by digest and keeps one row per digest, with the best row and
       the number of rows: its run. Only ids, digests and lengths are kept, no texts.
    2. The runs are merged by ``tree_merged``.
    3. Groups of several rows go back to the ranks that sent them, and from there to their rows: a
       group of any size is spread over as many keys as there were partitions with rows of it.

    Null texts are empty, and empty and blank texts are equal to each other. Rows without an id lose
    against rows with one of the same length; if they win, keep_id is null. Of repeated rows (same id
    and length) one stays. Ids may be of any type that has an order. Other columns are not looked at.
    """
    spark = docs.sparkSession
    rows = stored(_described(docs, id_col, text_col).sortWithinPartitions("digest", "chars", "best"), "digests")
    shape = rows.select("rank", *NAME, "best", F.lit(1).cast("long").alias("n"))
    runs = stored(shape.mapInArrow(_runs, shape.schema), "runs")
    groups = tree_merged(runs, int(spark.conf.get("spark.sql.shuffle.partitions"))).where("n > 1")
    back = runs.select("rank", *NAME).distinct().join(groups, [*NAME]).select("rank", *NAME, F.col("best").alias("winner"), "n")
    told = rows.join(back, ["rank", *NAME], "left")
    alone = F.col("n").isNull()
    return told.select(
        "id",
        F.when(alone, F.col("id")).otherwise(F.col("winner.id")).alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("winner.row") == F.col("best.row"))).alias("kept"),
        "digest",
        F.col("best.row").alias("row"),
    )


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``exact_copies`` keeps, with all their columns.

    Rows meet their groups by id, digest and length, so the copies of a group are not brought together.
    """
    stay = exact_copies(docs, id_col, text_col).where("kept").select(F.col("id").alias("_id"), F.col("digest").alias("_digest")).distinct()
    bare = F.sha2(normalised(F.col(text_col)).cast("binary"), 256)
    named = docs.select(F.struct("*").alias("_row"), F.col(id_col).alias("_own"), F.unhex(bare).alias("_sha"), F.length(F.coalesce(F.col(text_col), F.lit(""))).alias("_length"))
    met = named.join(stay, F.col("_own").eqNullSafe(F.col("_id")) & (F.col("_sha") == F.col("_digest")))
    longest = met.groupBy("_sha").agg(F.max_by("_row", "_length").alias("_row"))
    return longest.select("_row.*")
