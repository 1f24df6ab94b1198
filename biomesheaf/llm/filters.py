"""Audit of filters that overlap: steps of every order and Shapley shares from removal-game potentials."""

from collections.abc import Mapping
from functools import reduce
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import stored

BLANK = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: The rows that a row of the audit counts: all, those of good quality, toxic ones.
GAMES = ("all", "good", "toxic")


def text_failures(text: Column, words: Column) -> dict[str, Column]:
    """The conditions under which a text fails, but for copies (E)."""
    return {
        "A": F.size(words) < 50,
        "B": 100 * F.size(F.array_distinct(words)) < 65 * F.size(words),
        "C": 100 * (F.length(text) - F.length(F.translate(text, UPPER, ""))) > 5 * F.length(text),
        "D": F.rlike(text, F.lit("[#$%&*|]")),
    }


def _mask(failures: Mapping[str, Column]) -> Column:
    """Bit i is set if the i-th filter fails."""
    bits = [F.when(failed, F.lit(1 << i)).otherwise(0) for i, failed in enumerate(failures.values())]
    return reduce(lambda a, b: a + b, bits).cast("int")


def failure_counts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(part, mask, all, good, toxic): rows of each part by the set of filters A to E that they fail.

    Rows are reduced to id, digest, part and the mask of A to D, and equal ones counted, before they
    are sent anywhere; no text is shuffled, and texts are read once. E asks for the smallest id of a text: rows of one
    text are first counted by (part, labels), with the smallest id of each such group, so a text that a
    third of all rows share is as many rows as it has parts and labels.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.filter(F.split(text, BLANK), lambda w: w != "")
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.sha2(text.cast("binary"), 256).alias("digest"),
        _mask(text_failures(text, words)).alias("fails"),
    )
    # One row per id and text; the rows without an id have no smallest id and are counted at once.
    counted = stored(rows.groupBy("id", "part", "digest", "fails").agg(F.count(F.lit(1)).alias("n")), "failing")
    marked = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    no = F.lit(False)
    told = counted.where("id is not null").join(marked, "id", "left").unionByName(counted.where("id is null").withColumns({"good": no, "toxic": no}))
    groups = told.groupBy("digest", "part", "fails", F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic")).agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("id").isNull(), F.col("n"))).alias("nameless"), F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n"))).alias("first")
    )
    same = stored(groups, "texts")
    # The first row of each (text, part, labels) may be the smallest id of the text; all others with an id fail E.
    smallest = same.groupBy("digest").agg(F.min("first.id").alias("least"), F.count(F.lit(1)).alias("groups"))
    smallest = smallest.where("groups > 1").select("digest", "least")
    several = same.join(smallest, "digest", "left")
    stays = F.when(F.col("least").isNull() | (F.col("first.id") == F.col("least")), F.coalesce("first.n", F.lit(0))).otherwise(0) + F.coalesce("nameless", F.lit(0))
    split = several.select("part", "good", "toxic", "fails", "n", stays.alias("stays")).select(
        "part", "good", "toxic", F.explode(F.array(F.struct(F.col("fails").alias("mask"), F.col("stays").alias("n")), F.struct((F.col("fails") + 16).alias("mask"), (F.col("n") - F.col("stays")).alias("n")))).alias("x")
    )
    flat = split.select("part", "good", "toxic", "x.mask", "x.n").where("n > 0")
    return flat.groupBy("part", "mask").agg(
        F.sum("n").alias("all"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"), F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic")
    )


def _removed(game: str, coalitions: int) -> Column:
    """The rows of a part that each coalition of filters removes."""
    return F.array(*[F.sum(F.when(F.col("mask").bitwiseAND(F.lit(s)) != 0, F.col(game)).otherwise(0)) for s in range(coalitions)]).alias(game)


def _potentials(removed: Column, filters: int) -> Column:
    """|S|! times the potential of every coalition S, as whole numbers, from the removed rows.

    The potential of a game (Hart and Mas-Colell) is 0 without players, and P(S) = (v(S) + the sum of
    P(S without i) over i in S) / |S|. Coalitions come in the order of their bits, so those with one
    filter less are there already. Times |S|! this is (|S| - 1)! v(S) + the sum of the smaller ones'.
    """
    factorials = F.array(*[F.lit(factorial(k)).cast("long") for k in range(filters)])
    size = lambda s: F.bit_count(s).cast("int")

    def step(known, s):
        smaller = [F.when(s.bitwiseAND(F.lit(1 << i)) != 0, F.get(known, s - (1 << i))).otherwise(0) for i in range(filters)]
        return F.concat(known, F.array(F.get(factorials, size(s) - 1) * F.get(removed, s) + reduce(lambda a, b: a + b, smaller)))

    return F.aggregate(F.sequence(F.lit(1), F.lit((1 << filters) - 1)), F.array(F.lit(0).cast("long")), step)


def audit(counts: DataFrame, filters: str = "ABCDE") -> DataFrame:
    """One row per part, order of the filters and step, from rows per part and mask (``failure_counts``).

    With v(S) the rows that the filters S remove together, a step that adds filter i to S removes
    v(S and i) - v(S); what fails i and was removed earlier is redundant. Filter i's Shapley share is the
    grand potential less the potential without i; ``shapley`` is that times the number of orders.
    A part is one row with its 2**n coalitions; any number of parts fits.
    """
    n, every = len(filters), (1 << len(filters)) - 1
    parts = counts.groupBy("part").agg(F.sum("all").alias("total"), *[_removed(g, 1 << n) for g in GAMES])
    parts = parts.withColumn("potential", _potentials(F.col("all"), n))
    orders = F.array(*[F.lit("".join(p)) for p in permutations(filters)])
    stepped = parts.withColumn("filter_order", F.explode(orders)).select("*", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("step"))
    bits = F.array(*[F.lit(1 << i) for i in range(n)])
    at = lambda k: F.get(bits, F.instr(F.lit(filters), F.substring("filter_order", k, F.lit(1))) - 1)
    placed = stepped.withColumn("own", at(F.col("step")))
    earlier = F.transform(F.sequence(F.lit(1), F.lit(n)), lambda k: F.when(k < F.col("step"), at(k)).otherwise(0))
    placed = placed.withColumn("before", F.aggregate(earlier, F.lit(0), lambda s, b: s + b))
    gain = lambda game: F.get(game, F.col("before") + F.col("own")) - F.get(game, F.col("before"))
    without = F.lit(every) - F.col("own")
    return placed.select(
        "part",
        "filter_order",
        "step",
        (F.col("total") - F.get("all", F.col("before") + F.col("own"))).alias("kept"),
        gain("all").alias("removed"),
        (F.get("all", F.col("own")) - gain("all")).alias("redundant"),
        (F.get("all", F.lit(every)) - F.get("all", without)).alias("unique_fails"),
        gain("good").alias("good_lost"),
        gain("toxic").alias("toxic_lost"),
        (F.get("potential", F.lit(every)) - n * F.get("potential", without)).alias("shapley"),
    )
