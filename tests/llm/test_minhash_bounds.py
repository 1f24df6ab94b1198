"""Near-dedup of large groups of near copies: bounds on sets, and links found where most pairs just miss."""

import random

import numpy as np
from pyspark.sql import functions as F

from biomesheaf.llm import minhash

DOCS = "doc_id long, text string"


def test_bounds_never_tell_similar_sets_apart():
    rng = np.random.default_rng(5)
    for similarity in (50, 80, 85, 100):
        for _ in range(200):
            n = int(rng.integers(1, 400))
            a = rng.integers(0, 2**63, n, dtype=np.uint64)
            b = np.unique(np.concatenate([a[rng.random(n) < rng.uniform(0.7, 1)], rng.integers(0, 2**63, int(rng.integers(0, 40)), dtype=np.uint64)]))
            a = np.unique(a)
            both = len(np.intersect1d(a, b))
            one, other = (np.frombuffer(minhash.bound(x), np.uint8) for x in (a, b))
            if 100 * both >= similarity * (len(a) + len(b) - both):
                assert not minhash.unlike(one, other[None, :], similarity)[0]


def test_bounds_tell_most_sets_below_the_threshold_apart():
    rng = np.random.default_rng(6)
    told = 0
    for _ in range(100):
        a = np.unique(rng.integers(0, 2**64, 150, dtype=np.uint64))
        b = np.concatenate([a[:130], rng.integers(0, 2**64, 20, dtype=np.uint64)])  # Jaccard of 130 / 170
        one, other = (np.frombuffer(minhash.bound(np.unique(x)), np.uint8) for x in (a, b))
        told += minhash.unlike(one, other[None, :], 80)[0]
    assert told >= 98


def test_near_copies_just_under_the_threshold_make_few_pairs(spark, monkeypatch):
    """Copies of one text that differ from it in one run each and from each other in two: no two are linked but those planted."""
    rng = random.Random(7)
    base = [f"w{rng.randrange(10_000)}" for _ in range(200)]
    rows = []
    for i in range(1500):
        copy = list(base)
        at = rng.sample(range(5, 190, 8), 3)
        for p in at:
            copy[p : p + 3] = [f"x{i}a{p}", f"x{i}b{p}", f"x{i}c{p}"]
        rows.append((i, " ".join(copy)))
        if i % 300 == 0:
            rows.append((10_000 + i, " ".join([*copy[:-1], "end"])))
    found = {}
    confirm = minhash._confirm
    seen = spark.sparkContext.accumulator(0)

    def counting(similarity):
        inner = confirm(similarity)

        def run(batches):
            def tell():
                for b in batches:
                    seen.add(b.num_rows)
                    yield b

            yield from inner(tell())

        return run

    monkeypatch.setattr(minhash, "_confirm", counting)
    for r in minhash.near_duplicates(spark.createDataFrame(rows, DOCS).withColumn("pad", F.lit(1)), 85).collect():
        found.setdefault(r.component_id, set()).add(r.id)
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for i, t in rows}
    for component, members in found.items():
        for i in members - {component}:
            assert any(j != i and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]) for j in members)
    assert all({10_000 + i, i} <= next(m for m in found.values() if i in m) for i in range(0, 1500, 300))
    assert seen.value < 10 * len(rows)
