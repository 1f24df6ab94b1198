"""Mixing to target weights: iterative proportional fitting over source, language and topic."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import stored, unit

NONE = "none"
WORD = r"[^\x20\x09-\x0D]+"


def default_topic() -> Column:
    """What a text's own form says about it; documents carry no topic column."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return (
        F.when(F.contains(text, F.lit(" | ")), "table")
        .when(F.contains(text, F.lit("!!")), "shouting")
        .when(F.contains(text, F.lit("License")) | F.contains(text, F.lit("Licensed under")), "notice")
        .otherwise("prose")
    )


def _keyed(docs: DataFrame, topic: Column) -> DataFrame:
    """The documents as _row, their words and the three keys; null keys are the key ``none``."""
    key = lambda c: F.coalesce(c.cast("string"), F.lit(NONE))
    return docs.select(
        F.struct("*").alias("_row"),
        F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("double").alias("_tokens"),
        key(F.col("source")).alias("_source"),
        key(F.col("lang")).alias("_lang"),
        key(topic).alias("_topic"),
    )


def _shares(found: list[str], wanted: Mapping[str, float] | None) -> dict[str, float]:
    """Target shares of the keys found: those named, the others as one share each; they add up to 1."""
    raw = {k: float((wanted or {}).get(k, 1.0 if not wanted else min(wanted.values()))) for k in found}
    total = sum(raw.values()) or 1.0
    return {k: v / total for k, v in sorted(raw.items())}


def _lookup(weights: Mapping[str, float], key: Column) -> Column:
    """A factor by its key as an expression; languages and topics are short, bounded lists.

    Keys and factors are array constants, so that every step of the raking runs the same compiled code.
    """
    if not weights:
        return F.lit(0.0)
    at = F.array_position(F.lit(list(weights)), key).cast("int")
    return F.when(at > 0, F.get(F.lit([float(v) for v in weights.values()]), at - 1)).otherwise(0.0)


def raked(
    docs: DataFrame,
    lang_targets: Mapping[str, float] | None = None,
    topic_targets: Mapping[str, float] | None = None,
    source_power: float = 0.5,
    keep: float = 0.5,
    iterations: int = 12,
    cap_rounds: int = 6,
    topic: Column | None = None,
    seed: str = "mix",
    id_col: str = "doc_id",
) -> DataFrame:
    """The documents as the struct _row, with _tokens, _weight, _probability and _kept.

    Words are counted per (source, language, topic). Raking multiplies the counts by a factor per
    source, language and topic until the shares of each dimension meet their targets: sources get
    ``tokens ** source_power``, normalised; languages and topics the given shares (keys without one
    get the smallest given; with none given all are equal). The factors of a step are sums over the
    cells in Spark; a source is one row that holds its few cells, so any number of sources fits.
    A document's _weight is the target share of its cell over the present one; its _probability is
    the weight times one scale that makes the expected words ``keep`` of all, at most 1 (cells
    that reach 1 are used up and the rest is shared out again). It is kept if a hash of its id in
    [0, 1) is below its probability, so the choice is the same in every run and for every copy of a row.

    Null texts have no words; a null source, language or topic is the key ``none``. Without any
    words all weights and probabilities are 0. Rows are never dropped or merged here.
    """
    keyed = _keyed(docs, default_topic() if topic is None else topic)
    cells = keyed.groupBy("_source", "_lang", "_topic").agg(F.sum("_tokens").alias("n")).where("n > 0")
    # A row per source; its list is as long as there are languages times topics.
    rows = stored(
        cells.groupBy("_source").agg(F.sum("n").alias("total"), F.sort_array(F.collect_list(F.struct("_lang", "_topic", "n"))).alias("cells")),
        "raking",
    )
    known = rows.select("_source", F.explode("cells").alias("x")).groupBy("x._lang", "x._topic").agg(F.sum("x.n").alias("n")).collect()
    sums = rows.agg(F.sum("total").alias("n"), F.sum(F.pow("total", F.lit(source_power))).alias("powers")).first()
    everything, powers = float(sums["n"] or 0.0), float(sums["powers"] or 1.0)
    by_lang = _shares(sorted({r["_lang"] for r in known}), lang_targets)
    by_topic = _shares(sorted({r["_topic"] for r in known}), topic_targets)
    b, c = dict.fromkeys(by_lang, 1.0), dict.fromkeys(by_topic, 1.0)

    def with_factor(b, c):
        part = lambda x: x["n"] * _lookup(b, x["_lang"]) * _lookup(c, x["_topic"])
        held = F.aggregate("cells", F.lit(0.0), lambda a, x: a + part(x))
        return rows.withColumn("a", F.try_divide(F.pow("total", F.lit(source_power)) / powers, held))

    for _ in range(iterations if known else 0):
        m = {
            (r["_lang"], r["_topic"]): r["n"] or 0.0
            for r in with_factor(b, c)
            .select("a", F.explode("cells").alias("x"))
            .groupBy("x._lang", "x._topic")
            .agg(F.sum(F.col("a") * F.col("x.n")).alias("n"))
            .collect()
        }
        for k in b:
            held = sum(v * c[t] for (lang, t), v in sorted(m.items()) if lang == k)
            b[k] = by_lang[k] / held if held > 0 else 0.0
        for k in c:
            held = sum(v * b[lang] for (lang, t), v in sorted(m.items()) if t == k)
            c[k] = by_topic[k] / held if held > 0 else 0.0

    factors = stored(with_factor(b, c), "raked")
    weights = factors.select("a", F.explode("cells").alias("x")).select(
        F.col("x.n").alias("n"), (F.col("a") * _lookup(b, F.col("x._lang")) * _lookup(c, F.col("x._topic"))).alias("w")
    )
    scale = 0.0
    for _ in range(cap_rounds if known else 0):
        full = F.col("w") * scale >= 1.0
        r = weights.agg(F.sum(F.when(full, F.col("n")).otherwise(0.0)).alias("used"), F.sum(F.when(full, 0.0).otherwise(F.col("n") * F.col("w"))).alias("rest")).first()
        if not r["rest"] or r["rest"] <= 0:
            break
        scale = max(scale, (keep * everything - r["used"]) / r["rest"])
    at = factors.select(F.col("_source").alias("_key"), F.col("a").alias("_a"))
    weight = F.coalesce(F.col("_a"), F.lit(0.0)) * _lookup(b, F.col("_lang")) * _lookup(c, F.col("_topic"))
    return (
        keyed.join(at, F.col("_source") == F.col("_key"), "left")
        .withColumn("_w", weight)
        .withColumns(
            {
                "_weight": F.col("_w") * everything,
                "_probability": F.least(F.lit(1.0), F.col("_w") * scale),
            }
        )
        .withColumn("_kept", unit(f"_row.`{id_col}`", seed) < F.col("_probability"))
        .drop("_key", "_a", "_w")
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The sampled documents: their own columns, then mix_weight and mix_probability."""
    own = docs.drop("mix_weight", "mix_probability")
    return (
        raked(own, **options)
        .where("_kept")
        .select("_row.*", F.col("_weight").alias("mix_weight"), F.col("_probability").alias("mix_probability"))
    )
