"""MinHash near-dedup: a multi-index Hamming join of b-bit signatures, then exact confirmation."""

from collections.abc import Iterator
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import components
from .shared import row_key, stored
from .words import hash_words, shingles, text_groups

WORDS = 5
#: Parts of a signature, of 8 bits each, and the parts in which two members of a chunk of the index may differ.
PARTS, ERRORS = 384, 1
BLOCK = 256
#: A round that finds links for fewer than one class in so many is the last before all pairs left are looked at.
FEW = 20
#: Bits of the parity vector of a set.
PARITY = 2048
_rng = np.random.default_rng(1_703)
FACTORS = (_rng.integers(1, 2**31, PARTS, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
SHIFTS = _rng.integers(0, 2**32, PARTS, dtype=np.uint32)


def reach(parts: int, similarity: float, deviations: float = 4.5) -> int:
    """Signature distance that sets of the given similarity stay within, but for so many standard deviations."""
    p = (1 - similarity) * (1 - 2**-8)
    return min(parts, int(np.ceil(parts * p + deviations * sqrt(parts * p * (1 - p)))))


def index_shape(similarity: float) -> tuple[int, int]:
    """(indexed parts, chunks): the fewest chunks whose guaranteed distance covers the reach of the similarity.

    Chunks have six parts, below 0.85 five, as more parts of a pair differ there.
    """
    size = 6 if similarity >= 0.85 else 5
    for chunks in range(1, PARTS // size + 1):
        if chunks * (ERRORS + 1) - 1 >= reach(size * chunks, similarity):
            return size * chunks, chunks
    raise ValueError(f"no index of {PARTS} parts covers similarity {similarity}")


#: Of the default similarity.
INDEXED, CHUNKS = index_shape(0.85)


def signature(sets: np.ndarray) -> bytes:
    """The lowest 8 bits of the smallest of the set's values under each of the hash functions."""
    low = sets.astype(np.uint32) ^ (sets >> np.uint64(32)).astype(np.uint32)
    least = np.full(PARTS, 2**32 - 1, np.uint32)
    for at in range(0, len(low), 2048):
        h = low[None, at : at + 2048] * FACTORS[:, None]
        h += SHIFTS[:, None]
        np.minimum(least, h.min(axis=1), out=least)
    least = (least ^ (least >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return (least >> np.uint32(24)).astype(np.uint8).tobytes()


def bound(sets: np.ndarray) -> bytes:
    """Whether each of PARITY buckets of the set's values holds an odd number of them, and the set's size."""
    odd = np.bincount((sets >> np.uint64(53)).astype(np.int64), minlength=PARITY) & 1
    return np.packbits(odd.astype(bool)).tobytes() + np.int64(len(sets)).tobytes()


def unlike(one: np.ndarray, others: np.ndarray, similarity: int) -> np.ndarray:
    """Which sets can't be as similar as asked, by their bounds alone; never true of a pair that is.

    A bucket that is odd for one set only holds a value that the other has not, so values that are in one set
    only are at least as many as such buckets, and as the sizes differ.
    """
    size = others[:, PARITY // 8 :].copy().view(np.int64)[:, 0]
    own = int(one[PARITY // 8 :].copy().view(np.int64)[0])
    apart = np.bitwise_count(others[:, : PARITY // 8] ^ one[: PARITY // 8]).sum(axis=1, dtype=np.int64)
    return np.maximum(apart, np.abs(size - own)) * (100 + similarity) > (size + own) * (100 - similarity)


def _sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The distinct shingle hashes of each text, sorted."""
    for _, _, b, offsets in text_groups(column):
        h, counts = hash_words(b, offsets)
        g, number = shingles(h, counts, WORDS)
        at = 0
        for n in number:
            yield np.unique(g[at : at + n])
            at += int(n)


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        size, one, two, sig, limit = [], [], [], [], []
        for s in _sets(batch.column("text")):
            size.append(len(s))
            one.append(int(s.sum(dtype=np.uint64).astype(np.int64)))
            two.append(int(np.bitwise_xor.reduce(s * np.uint64(0xD6E8FEB86659FD93) ^ (s >> np.uint64(29))).astype(np.int64)) if len(s) else 0)
            sig.append(signature(s) if len(s) else None)
            limit.append(bound(s) if len(s) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("_key"), batch.column("id"), pa.array(size, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(sig, pa.binary()), pa.array(limit, pa.binary())],
            ["_key", "id", "n", "one", "two", "sig", "bound"],
        )


def index_keys(similarity: float = 0.85) -> list[list[int]]:
    """The parts that each key of the index holds: every chunk without one of its parts."""
    indexed, chunks = index_shape(similarity)
    parts = [range(c * indexed // chunks, (c + 1) * indexed // chunks) for c in range(chunks)]
    return [[p for p in chunk if p != left] for chunk in parts for left in chunk]


def _keys(sig: str, similarity: float) -> Column:
    """The index keys of a signature: a pair within chunks * (ERRORS + 1) - 1 of each other shares one."""
    parts = [F.substring(sig, p + 1, 1) for p in range(index_shape(similarity)[0])]
    return F.array(*[F.xxhash64(F.lit(k), *[parts[p] for p in held]) for k, held in enumerate(index_keys(similarity))])


def _confirm(similarity: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            left, right = batch.column("set_a"), batch.column("set_b")
            for r in range(batch.num_rows):
                x, y = np.frombuffer(left[r].as_buffer(), np.uint64), np.frombuffer(right[r].as_buffer(), np.uint64)
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int((y[at] == x).sum())
                if 100 * both >= similarity * (len(x) + len(y) - both):
                    a.append(batch.column("a")[r].as_py())
                    b.append(batch.column("b")[r].as_py())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return confirm


def _store_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array([s.tobytes() for s in _sets(batch.column("text"))], pa.binary())], ["node", "set"])


def _search(similarity: float, nearest: bool):
    """Pairs within a block of a bucket that are in different components and within reach; each pair in its first bucket only."""
    held, near_all = index_keys(similarity), reach(PARTS, similarity)
    percent = round(100 * similarity)

    def pairs(key, first, second, node, component, block, sig, limits):
        rows, cols = np.flatnonzero(block == first), np.flatnonzero(block == second)
        for r in rows:
            c = cols[component[cols] != component[r]]
            if first == second:
                c = c[node[c] > node[r]]
            if not len(c):
                continue
            differs = sig[c] != sig[r]
            total = differs.sum(axis=1)
            good = total <= near_all
            for k in range(key):  # the bucket of an earlier key that the two share has the pair
                if not good.any():
                    break
                good &= differs[:, held[k]].any(axis=1)
            if limits is not None and good.any():
                good[good] = ~unlike(limits[r], limits[c[good]], percent)
            c, total = c[good], total[good]
            if nearest and len(c):
                c, total = c[[total.argmin()]], total[[total.argmin()]]
            yield np.full(len(c), node[r]), node[c], total

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by bucket and block pair; the last group of a batch waits for the next."""
        waiting = None

        def done(t):
            named = [t.column(c).to_numpy() for c in ("k", "key", "i", "j", "node", "component", "block")]
            sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), np.uint8).reshape(-1, PARTS)
            limits = np.frombuffer(b"".join(t.column("bound").to_pylist()), np.uint8).reshape(len(sig), -1) if "bound" in t.column_names else None
            change = np.flatnonzero(np.any([np.diff(x) != 0 for x in named[:4]], axis=0)) + 1
            found = []
            for s, e in zip([0, *change], [*change, t.num_rows], strict=True):
                if e - s > 1:
                    found += pairs(named[0][s], named[2][s], named[3][s], *(x[s:e] for x in named[4:]), sig[s:e], None if limits is None else limits[s:e])
            a, b, d = (np.concatenate(x) if found else np.zeros(0, np.int64) for x in (zip(*found, strict=True) if found else [()] * 3))
            return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (a, b, d)], ["a", "b", "d"])

        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = (pa.concat_tables([waiting, t]) if waiting is not None else t).combine_chunks()
            groups = [t.column(c).to_numpy() for c in ("k", "key", "i", "j")]
            inside = np.flatnonzero(np.any([np.diff(x) != 0 for x in groups], axis=0)) + 1
            cut = int(inside[-1]) if len(inside) else 0
            if cut:
                yield done(t.slice(0, cut))
            waiting = t.slice(cut)
        if waiting is not None and waiting.num_rows:
            yield done(waiting)

    return search


def near_duplicates(docs: DataFrame, similarity: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_key, id, n_shingles, component_id, kept) of every row of ``docs``.

    Words are runs of non-blank bytes, A-Z lowered; a document's set are its distinct shingles of five
    words (with fewer words the whole sequence). Documents with 100 * common >= similarity * union
    are linked; component_id is the smallest id reachable, kept is true where that is its own.

    1. Equal sets are one class (told by their size and two 64-bit sums).
    2. A class has a signature of 384 parts of 8 bits. The first of them are indexed in chunks (``index_shape``:
       at 85 90 parts in 15 chunks, at 80 90 in 18); two signatures that differ in at most 29 (at 80: 35) of
       them differ in at most one part of some chunk, so they share one of the keys made of a chunk
       less one part: no pair within that distance is missed. Sets at the similarity threshold stay
       within it but for 4.5 standard deviations.
    3. Each class is confirmed against two of the smallest members of its buckets, the one it shares most
       keys with and the smallest, and components of the links are built.
    4. Only buckets that still hold several components are searched, in blocks of about 256: for each
       member the nearest signature in another component, one pair a member, again and again until a round finds
       few (a class with a link to another component mostly finds one, so few are left then); then all that
       is left. Pairs are left out before that can't be similar enough by the sizes and
       parity vectors of their sets (``unlike``); of near copies just below the threshold hardly any pass.
    Links are confirmed on full sets. Ids are taken as longs.

    Null and empty texts, and texts of blanks, have no set: n_shingles 0, linked with nothing, kept.
    Rows without an id are linked like others and never kept beside one with an id; where no row of
    a component has an id its component_id is null and the row with the first text key is kept. Of
    repeated rows with the smallest id all are kept.
    """
    rows = docs.select(row_key(id_col, text_col).alias("_key"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    described = rows.mapInArrow(_describe, "_key string, id long, n long, one long, two long, sig binary, bound binary")
    signed = stored(described.withColumn("node", F.when(F.col("n") > 0, F.xxhash64("n", "one", "two"))), "signatures")
    classes = signed.where("n > 0").groupBy("node").agg(F.min("id").alias("id"), F.min("_key").alias("_key"))
    classes = stored(classes, "classes")
    keyed = signed.join(classes.select("_key"), "_key", "left_semi").where("n > 0").select("node", "sig", "bound").dropDuplicates(["node"])
    keyed = stored(keyed, "representatives")
    entries = keyed.select("node", F.posexplode(_keys("sig", similarity / 100)).alias("k", "key"))
    shared = entries.groupBy("k", "key").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("members")).where("members > 1")
    buckets = stored(entries.join(shared, ["k", "key"]), "buckets")
    taking = classes.join(buckets.select("node").distinct(), "node").select("node", "_key")
    sets = stored(
        rows.select("_key", "text").join(taking, "_key").dropDuplicates(["node"]).select("node", "text").mapInArrow(_store_sets, "node long, set binary"),
        "sets",
    )

    def confirmed(pairs):
        with_a = pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("set_a")), "a")
        with_both = with_a.join(sets.select(F.col("node").alias("b"), F.col("set").alias("set_b")), "b")
        return with_both.select("a", "b", "set_a", "set_b").mapInArrow(_confirm(similarity), "a long, b long")

    # Of its buckets' smallest members, a class asks the one it shares most keys with and the smallest.
    asked = buckets.where("node <> hub").groupBy("node", "hub").agg(F.count(F.lit(1)).alias("keys"))
    asked = asked.groupBy("node").agg(F.max_by("hub", "keys").alias("most"), F.min("hub").alias("least"))
    asked = asked.select(F.explode(F.array_distinct(F.array("most", "least"))).alias("a"), F.col("node").alias("b"))
    links = stored(confirmed(asked), "links")
    known, nearest, number = links.count(), True, classes.count()
    while True:
        found = components(links).select(F.col("id").alias("node"), "component")
        named = buckets.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
        still_open = named.groupBy("k", "key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("k", "key")
        blocks = F.ceil(F.col("members") / BLOCK).cast("int")
        blocked = named.join(still_open, ["k", "key"]).join(keyed, "node").withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int"))
        paired = blocked.select("*", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other")).select(
            "k", "key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node", "component", "block", "sig", "bound"
        )
        place = ["k", "key", "i", "j"]
        pairs = paired.repartition(*place).sortWithinPartitions(*place).mapInArrow(_search(similarity / 100, nearest), "a long, b long, d long")
        if nearest:
            pairs = pairs.groupBy("a").agg(F.min(F.struct("d", "b")).alias("x")).select("a", "x.b")
        links = stored(links.unionByName(confirmed(pairs.select("a", "b").distinct())), "links")
        if not nearest:
            break
        before, known = known, links.count()
        nearest = FEW * (known - before) > number
    found = components(links).select(F.col("id").alias("node"), "component")
    whole = classes.join(found, "node", "left").select("node", "id", "_key", F.coalesce("component", "node").alias("component"))
    smallest = whole.groupBy("component").agg(F.min("id").alias("least"), F.min("_key").alias("first"))
    by_class = whole.join(smallest, "component").select("node", "least", "first")
    told = signed.select("_key", "id", F.col("n").alias("n_shingles"), "node").join(by_class, "node", "left")
    alone = F.col("node").isNull()
    return told.select(
        "_key", "id", "n_shingles",
        F.when(alone, F.col("id")).otherwise(F.col("least")).alias("component_id"),
        F.when(alone, True).when(F.col("least").isNull(), F.col("_key") == F.col("first")).otherwise(F.coalesce(F.col("id") == F.col("least"), F.lit(False))).alias("kept"),
    )
