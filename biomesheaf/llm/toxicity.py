"""Toxicity: a factorization machine over hashed terms."""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .langid import labelled_sample
from .words import term_hashes, text_groups

BITS = 22
#: Words count whole and by their first bytes, so that inflected forms share terms.
PREFIXES = (4, 5, 6)
#: The Euclidean length of a text's inputs.
SCALE = 4.0


@dataclass
class FactorizationMachine:
    """buckets: the sorted term buckets it knows; idf, weight and factors: of each, in that order."""

    buckets: np.ndarray
    idf: np.ndarray
    weight: np.ndarray
    factors: np.ndarray
    bias: float


def _terms(b: np.ndarray, offsets: np.ndarray, place: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of the distinct terms of each text, in order; with ``place`` the places of those it knows."""
    h, text = term_hashes(b, offsets, PREFIXES)
    bucket = (h >> np.uint64(64 - BITS)).astype(np.int64)
    if place is not None:
        bucket = place[bucket].astype(np.int64)
        text, bucket = text[bucket >= 0], bucket[bucket >= 0]
    key = np.unique((text << BITS) | bucket)
    return key >> BITS, key & ((1 << BITS) - 1)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, b, offsets in text_groups(batch.column("text")):
            text, bucket = _terms(b, offsets)
            cuts = np.searchsorted(text, np.arange(last - first + 1))
            bucket = bucket.astype(np.int32)
            terms = pa.array([bucket[s:e].tobytes() for s, e in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("label").slice(first, last - first), terms], ["label", "terms"])


def _sum_by(owner: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of rows by owner; ``owner`` ascends."""
    out = np.zeros((n, *values.shape[1:]))
    if len(owner):
        cuts = np.flatnonzero(np.diff(owner, prepend=-1))
        out[owner[cuts]] = np.add.reduceat(values, cuts, axis=0)
    return out


def _inputs(idf: np.ndarray, at: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """What each term counts for in its text: its idf over the text's Euclidean length, so long texts weigh no more."""
    x = idf[at]
    return SCALE * x / np.sqrt(_sum_by(owner, x * x, n))[owner]


def _logits(model: FactorizationMachine, at: np.ndarray, x: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Logits of n texts, and the sums of their factors; ``x`` is what each term counts for."""
    v = model.factors[at] * x[:, None]
    total = _sum_by(owner, v, n)
    pairs = 0.5 * (total**2 - _sum_by(owner, v * v, n)).sum(axis=1)
    return model.bias + _sum_by(owner, model.weight[at] * x, n) + pairs, total


def _constant(toxic: bool, dims: int) -> FactorizationMachine:
    empty = np.zeros(0)
    return FactorizationMachine(empty.astype(np.int64), empty, empty, np.zeros((0, dims)), 30.0 if toxic else -30.0)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    per_label: int = 1500,
    least: int = 3,
    dims: int = 6,
    epochs: int = 10,
    steps: int = 600,
    rate: float = 0.1,
    decay: float = 0.002,
    sparse: float = 0.0003,
    seed: int = 11,
) -> FactorizationMachine:
    """Train on a bounded sample: at most ``per_label`` labelled documents of either class (texts whole).

    ``labels`` has doc_id and toxic (of several rows of an id the largest counts, nulls are no
    label); of documents with one id the text that comes first in order is taken. Every term in ``least`` texts of the sample or more has
    a weight and factors, whatever it tells alone. The machine's logit is bias + sum of weights + sum
    over pairs of terms of the product of their factors, so a pair can count for more, or less, than
    its two terms; terms count by their idf in texts of length 1. Linear weights are
    kept sparse by soft thresholds (``sparse``) while they are learned, factors shrink by ``decay``.
    The bias is moved from the sample to the share of toxic rows among all labels. ``epochs`` passes
    are made, or more for ``steps`` steps. The result does not depend on the order of rows.
    """
    one = labels.groupBy("doc_id").agg(F.max("toxic").alias("_toxic")).where(F.col("_toxic").isNotNull() & F.col("doc_id").isNotNull())
    known = {r["_toxic"]: r["n"] for r in one.groupBy("_toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not known.get(0) or not known.get(1):
        return _constant(bool(known.get(1)), dims)
    # Two labels, so at most 2 * per_label ids; one text each, however often an id repeats.
    sample = labelled_sample(one, F.col("_toxic"), per_label).select("doc_id", F.col("label").cast("int").alias("label"))
    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(sample), "doc_id")
        .groupBy("doc_id")
        .agg(F.min("text").alias("text"), F.min("label").alias("label"))
        .mapInArrow(_features, "label int, terms binary")
        .toPandas()
        .sort_values(["label", "terms"], ignore_index=True)
    )
    y = rows["label"].to_numpy(dtype=np.float64)
    if len(set(y)) < 2:
        return _constant(bool(len(y) and y[0]), dims)
    lists = [np.frombuffer(t, np.int32) for t in rows["terms"]]
    owner, flat = np.repeat(np.arange(len(y)), [len(t) for t in lists]), np.concatenate(lists)
    found, at, texts = np.unique(flat, return_inverse=True, return_counts=True)
    place = np.where(texts >= least, np.cumsum(texts >= least) - 1, -1)
    owner, at = owner[place[at] >= 0], place[at][place[at] >= 0]
    found, texts = found[texts >= least], texts[texts >= least]
    rng = np.random.default_rng(seed)
    model = FactorizationMachine(
        found.astype(np.int64), np.log1p(len(y) / texts), np.zeros(len(found)), rng.normal(0, 0.01, (len(found), dims)), 0.0
    )
    inputs = _inputs(model.idf, at, owner, len(y))
    cuts = np.searchsorted(owner, np.arange(len(y) + 1))
    seen_w, seen_v, seen_b = np.full(len(found), 1e-3), np.full((len(found), dims), 1e-3), 1e-6
    for _ in range(max(epochs, -(-steps * 32 // len(y)))):
        order = rng.permutation(len(y))
        for part in np.array_split(order, max(1, len(y) // 32)):
            local = np.repeat(np.arange(len(part)), cuts[part + 1] - cuts[part])
            rows_of = np.concatenate([np.arange(cuts[i], cuts[i + 1]) for i in part])
            take, x = at[rows_of], inputs[rows_of]
            logit, total = _logits(model, take, x, local, len(part))
            g = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y[part]) / len(part)
            touched, back = np.unique(take, return_inverse=True)
            pull = g[local] * x
            gw = np.bincount(back, weights=pull, minlength=len(touched)) + decay * model.weight[touched]
            pulls = pull[:, None] * (total[local] - model.factors[take] * x[:, None])
            gv = np.stack([np.bincount(back, weights=pulls[:, k], minlength=len(touched)) for k in range(dims)], axis=1)
            gv += decay * model.factors[touched]
            seen_w[touched] += gw**2
            seen_v[touched] += gv**2
            seen_b += g.sum() ** 2
            step = rate / np.sqrt(seen_w[touched])
            moved = model.weight[touched] - step * gw
            model.weight[touched] = np.sign(moved) * np.maximum(np.abs(moved) - step * sparse, 0)
            model.factors[touched] -= 0.2 * rate * gv / np.sqrt(seen_v[touched])
            model.bias -= rate * g.sum() / np.sqrt(seen_b)
    model.bias += float(np.log(known[1] / known[0]) - np.log(y.sum() / (len(y) - y.sum())))
    return model


def toxicity(model: FactorizationMachine, text: str = "text") -> Column:
    """The probability that each whole text is toxic; null and empty texts get that of no terms."""

    def score(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        place = np.full(1 << BITS, -1, np.int32)
        place[model.buckets] = np.arange(len(model.buckets))
        for column in columns:
            p = np.zeros(len(column))
            for first, last, b, offsets in text_groups(column):
                owner, at = _terms(b, offsets, place)
                logit, _ = _logits(model, at, _inputs(model.idf, at, owner, last - first), owner, last - first)
                p[first:last] = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
            yield pa.array(p)

    return F.arrow_udf(score, "double", F.ArrowUDFType.SCALAR_ITER)(F.col(text))
