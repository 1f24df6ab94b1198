"""Language ID: averaged hashed subword embeddings under a linear softmax, with calibrated rejection."""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import PandasUDFType  # noqa: F401  (loads the Arrow function types)

from .shared import fold
from .words import byte_grams, text_groups

BITS = 15
SIZES = (3, 4)
UNKNOWN = "und"


@dataclass
class LanguageModel:
    """labels; table: the score of each bucket for each label (embeddings times output weights)."""

    labels: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, b, offsets in text_groups(batch.column("text")):
            n = last - first
            keys = [np.zeros(0, np.int64)]
            for bucket, text in byte_grams(b, offsets, SIZES, BITS):
                keys.append((text.astype(np.int64) << BITS) | bucket)
            key, count = np.unique(np.concatenate(keys), return_counts=True)
            cuts = np.searchsorted(key, np.arange(n + 1, dtype=np.int64) << BITS)
            packed = lambda x: pa.array([x[s:e].tobytes() for s, e in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("label").slice(first, n),
                    batch.column("part").slice(first, n),
                    packed((key & ((1 << BITS) - 1)).astype(np.uint16)),
                    packed(count.astype(np.uint32)),
                ],
                ["label", "part", "bucket", "count"],
            )


def labelled_sample(docs: DataFrame, label: Column, per_label: int, key: str = "doc_id") -> DataFrame:
    """About ``per_label`` rows of each label, never more, chosen by a hash of the key."""
    named = docs.withColumn("label", label).where(F.col("label").isNotNull())
    sizes = {r["label"]: r["n"] for r in named.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return named.where(F.lit(False)).withColumn("_pick", F.lit(0.0))
    pick = F.pmod(F.xxhash64(F.lit(17), F.col(key)), F.lit(1 << 40)).cast("double") / float(1 << 40)
    rate = F.element_at(F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, 1.2 * per_label / n))]), F.col("label"))
    order = Window.partitionBy("label").orderBy("_pick", key)
    return named.withColumn("_pick", pick).where(F.col("_pick") < rate).withColumn("_at", F.row_number().over(order)).where(F.col("_at") <= per_label).drop("_at")


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=-1, keepdims=True))
    return x / x.sum(axis=-1, keepdims=True)


def fit(docs: DataFrame, per_label: int = 250, dims: int = 16, epochs: int = 6, rate: float = 0.5, lost: float = 0.0005, seed: int = 5) -> LanguageModel:
    """Train on a bounded sample: at most ``per_label`` rows of each non-null ``lang`` (texts whole).

    Only bucket counts of the sample come to the driver, at most 2**15 numbers a row. Every fifth row of
    it is kept apart: on those the temperature is fitted, and the rejection threshold set so that a
    share ``lost`` of rightly named texts would be rejected, at 0.5 at the most.
    """
    sample = labelled_sample(docs.select("doc_id", "text", F.col("lang").alias("_lang")), F.col("_lang"), per_label)
    part = F.pmod(F.xxhash64(F.lit(23), F.col("doc_id")), F.lit(5)).cast("int")
    rows = (
        sample.select("text", "label", part.alias("part"))
        .mapInArrow(_features, "label string, part int, bucket binary, count binary")
        .toPandas()
    )
    # Rows come in the order of partitions; training must not depend on it.
    rows = rows[np.array([len(x) > 0 for x in rows["bucket"]], bool)].sort_values(["label", "bucket", "count", "part"], ignore_index=True)
    labels = sorted(set(rows["label"]))
    if not labels:
        return LanguageModel([], np.zeros((1 << BITS, 0), np.float32), np.zeros(0, np.float32), 1.0, 0.0)
    y = np.array([labels.index(x) for x in rows["label"]])
    counts = [np.frombuffer(c, np.uint32) for c in rows["count"]]
    xs = [(np.frombuffer(i, np.uint16), (c / c.sum()).astype(np.float32)) for i, c in zip(rows["bucket"], counts, strict=True)]
    apart = (rows["part"] == 0).to_numpy()
    if apart.all() or len(set(y[~apart])) < len(labels):
        apart = np.zeros(len(y), bool)
    rng = np.random.default_rng(seed)
    e = rng.normal(0, 0.3, (1 << BITS, dims)).astype(np.float32)
    w = np.zeros((dims, len(labels)), np.float32)
    bias = np.zeros(len(labels), np.float32)
    order = np.flatnonzero(~apart)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for i in rng.permutation(order):
            at, share = xs[i]
            h = share @ e[at]
            g = _softmax(h @ w + bias)
            g[y[i]] -= 1
            e[at] -= (step * 20 * share)[:, None] * (w @ g)
            w -= step * np.outer(h, g)
            bias -= 0.1 * step * g
    table = e @ w
    held = np.flatnonzero(apart) if apart.any() else order
    logits = np.stack([share @ table[at] for at, share in (xs[i] for i in held)]) + bias
    losses = {t: -np.mean(np.log(_softmax(logits / t)[np.arange(len(held)), y[held]] + 1e-12)) for t in np.geomspace(0.05, 20, 40)}
    temperature = float(min(losses, key=losses.get))
    p = _softmax(logits / temperature)
    right = p.argmax(axis=1) == y[held]
    threshold = min(0.5, float(np.quantile(p.max(axis=1)[right], lost))) if right.any() else 0.5
    return LanguageModel(labels, table.astype(np.float32), bias, temperature, threshold)


def _scorer(model: LanguageModel):
    labels = [*model.labels, UNKNOWN]

    def score(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for text, known in columns:
            best = np.full(len(text), len(model.labels), np.int64)
            chance = np.zeros(len(text))
            for first, last, b, offsets in text_groups(text):
                if not model.labels:
                    break
                n = last - first
                total, seen = np.zeros((n, len(model.labels))), np.zeros(n)
                for bucket, owner in byte_grams(b, offsets, SIZES, BITS):
                    if not len(owner):
                        continue
                    cuts = np.flatnonzero(np.diff(owner, prepend=-1))
                    total[owner[cuts]] += np.add.reduceat(model.table[bucket], cuts, axis=0, dtype=np.float64)
                    seen[owner[cuts]] += np.diff(cuts, append=len(owner))
                p = _softmax((total / np.maximum(seen, 1)[:, None] + model.bias) / model.temperature)
                best[first:last], chance[first:last] = p.argmax(axis=1), p.max(axis=1)
            named = known.fill_null(False).to_numpy(zero_copy_only=False)
            best[~named], chance[~named] = len(model.labels), 0.0
            yield pa.StructArray.from_arrays(
                [pa.array([labels[i] for i in best], pa.string()), pa.array(np.clip(chance, 0.0, 1.0))], ["lang", "score"]
            )

    return F.arrow_udf(score, "lang string, score double", F.ArrowUDFType.SCALAR_ITER)


def language(model: LanguageModel, text: str = "text") -> Column:
    """A struct (lang, score) for each whole text: the likeliest label and its calibrated probability.

    ``und`` with score 0 where the text is null or has no letter, or where nothing was learned.
    """
    return _scorer(model)(F.col(text), F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)))


def identified(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The documents as the struct _row, with _lang, _score and _rejected (no label, or score below the threshold)."""
    named = docs.select(F.struct("*").alias("_row"), F.col("text").alias("_text")).withColumn("_found", language(model, "_text"))
    rejected = (F.col("_found.lang") == UNKNOWN) | (F.col("_found.score") < model.threshold)
    return named.select("_row", F.col("_found.lang").alias("_lang"), F.col("_found.score").alias("_score"), rejected.alias("_rejected"))


def learnable(docs: DataFrame) -> DataFrame:
    """The rows that models may learn from: those whose crc32 of the id, modulo 4, is not 2."""
    return docs.where(fold("doc_id", 4) != 2)
