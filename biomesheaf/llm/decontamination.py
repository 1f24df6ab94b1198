"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment of words."""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import row_key, stored
from .words import hash_words, shingles, text_groups

MATCH, MISS, GAP = 2, -1, -1
FILTER_BITS = 24


@dataclass
class Seeds:
    """Items of one block of the benchmark and the n-grams that may seed an alignment.

    grams: sorted hashes; posts: for each gram from cuts[g] to cuts[g + 1] its places (item, position);
    reach: the longest item that holds the gram; sizes: lengths of grams (n, and less for shorter items).
    """

    ids: list
    words: list[np.ndarray]
    grams: np.ndarray
    cuts: np.ndarray
    post_item: np.ndarray
    post_at: np.ndarray
    reach: np.ndarray
    sizes: list[int]


def _word_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, b, offsets in text_groups(batch.column("text")):
            h, counts = hash_words(b, offsets)
            lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32), h.view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("item_id").slice(first, last - first), lists], ["item_id", "words"])


def _seeds(rows, n: int) -> Seeds:
    ids, words = [r["item_id"] for r in rows], [np.array(r["words"], np.int64).view(np.uint64) for r in rows]
    grams, items, places, sizes = [], [], [], set()
    for i, w in enumerate(words):
        size = min(n, len(w))
        sizes.add(size)
        g, _ = shingles(w, np.array([len(w)]), size)
        grams.append(g)
        items.append(np.full(len(g), i))
        places.append(np.arange(len(g)))
    grams, items, places = np.concatenate(grams), np.concatenate(items), np.concatenate(places)
    order = np.argsort(grams, kind="stable")
    found, cuts = np.unique(grams[order], return_index=True)
    lengths = np.array([len(w) for w in words])
    return Seeds(ids, words, found, np.append(cuts, len(order)), items[order], places[order], np.maximum.reduceat(lengths[items[order]], cuts), sorted(sizes))


def _slack(length, least: float):
    """The longest total gap with which an alignment may still score ``least`` of an exact copy."""
    return np.ceil(MATCH * (1 - least) * length / -GAP).astype(np.int64)


def _scan(seeds: Seeds, least: float):
    """Documents with seeds: their places, and the words around them as segments."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maybe = np.zeros(1 << FILTER_BITS, bool)
        shift = np.uint64(64 - FILTER_BITS)
        maybe[seeds.grams >> shift] = True
        for batch in batches:
            for first, _, b, offsets in text_groups(batch.column("text")):
                h, counts = hash_words(b, offsets)
                begin = np.cumsum(counts) - counts
                owner, gram, place = [], [], []
                for size in seeds.sizes:
                    g, number = shingles(h, np.where(counts >= size, counts, 0), size) if (counts >= size).all() else _long_only(h, counts, size)
                    at = np.flatnonzero(maybe[g >> shift])
                    if not len(at):
                        continue
                    where = np.searchsorted(seeds.grams, g[at])
                    where = np.minimum(where, len(seeds.grams) - 1)
                    hit = seeds.grams[where] == g[at]
                    at, where = at[hit], where[hit]
                    ends = np.cumsum(number)
                    who = np.searchsorted(ends, at, "right")
                    owner.append(who)
                    gram.append(where)
                    place.append(at - (ends[who] - number[who]))
                if not owner:
                    continue
                owner, gram, place = np.concatenate(owner), np.concatenate(gram), np.concatenate(place)
                order = np.lexsort((place, owner))
                owner, gram, place = owner[order], gram[order], place[order]
                out = {"_key": [], "_id": [], "gram": [], "place": [], "start": [], "words": []}
                for d in np.unique(owner):
                    mine = owner == d if len(owner) < 64 else slice(*np.searchsorted(owner, [d, d + 1]))
                    g, p = gram[mine], place[mine]
                    reach = seeds.reach[g] + _slack(seeds.reach[g], least) + max(seeds.sizes)
                    lo, hi = np.maximum(p - reach, 0), np.minimum(p + reach, counts[d])
                    spans = []
                    for s, e in sorted(zip(lo.tolist(), hi.tolist(), strict=True)):
                        if spans and s <= spans[-1][1]:
                            spans[-1][1] = max(spans[-1][1], e)
                        else:
                            spans.append([s, e])
                    out["_key"].append(batch.column("_key")[first + int(d)].as_py())
                    out["_id"].append(batch.column("_id")[first + int(d)].as_py())
                    out["gram"].append(g.tolist())
                    out["place"].append(p.tolist())
                    out["start"].append([s for s, _ in spans])
                    out["words"].append([h[begin[d] + s : begin[d] + e].view(np.int64).tolist() for s, e in spans])
                if out["_key"]:
                    yield pa.RecordBatch.from_pydict(
                        out,
                        pa.schema([("_key", pa.string()), ("_id", batch.schema.field("_id").type), ("gram", pa.list_(pa.int32())), ("place", pa.list_(pa.int32())), ("start", pa.list_(pa.int32())), ("words", pa.list_(pa.list_(pa.int64())))]),
                    )

    return scan


def _long_only(h, counts, size):
    """Shingles of the texts that have at least ``size`` words."""
    keep = counts >= size
    g, number = shingles(h[np.repeat(keep, counts)], counts[keep], size)
    out = np.zeros(len(counts), number.dtype)
    out[keep] = number
    return g, out


def align(items: list[np.ndarray], windows: list[np.ndarray]) -> np.ndarray:
    """Smith-Waterman scores of pairs of word sequences (match 2, mismatch and gap -1), all pairs side by side."""
    scores = np.zeros(len(items))
    order = np.argsort([len(w) * len(i) for i, w in zip(items, windows, strict=True)], kind="stable")
    at = 0
    while at < len(order):
        width = len(windows[order[at]])
        stop = at
        while stop < len(order) and (stop - at + 1) * max(width, len(windows[order[stop]])) <= 1 << 18:
            width = max(width, len(windows[order[stop]]))
            stop += 1
        stop = max(stop, at + 1)
        group = order[at:stop]
        width = max(len(windows[i]) for i in group)
        length = max(len(items[i]) for i in group)
        win, item = np.zeros((len(group), width), np.uint64), np.ones((len(group), length), np.uint64)
        inside = np.zeros((len(group), width), bool)
        real = np.zeros((len(group), length), bool)
        for r, i in enumerate(group):
            win[r, : len(windows[i])] = windows[i]
            inside[r, : len(windows[i])] = True
            item[r, : len(items[i])] = items[i]
            real[r, : len(items[i])] = True
        ramp = np.arange(width + 1, dtype=np.int32)
        h, best = np.zeros((len(group), width + 1), np.int32), np.zeros(len(group), np.int32)
        for j in range(length):
            same = (win == item[:, j : j + 1]) & inside & real[:, j : j + 1]
            t = np.zeros_like(h)
            t[:, 1:] = np.maximum(h[:, :-1] + np.where(same, MATCH, MISS), h[:, 1:] + GAP)
            np.maximum(t, 0, out=t)
            h = np.maximum.accumulate(t - GAP * ramp, axis=1) + GAP * ramp
            best = np.maximum(best, h.max(axis=1))
        scores[group] = best
        at = stop
    return scores


def _score(seeds: Seeds, rare: np.ndarray, least: float):
    """rare: for each place of a gram in an item, whether it seeds that item."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict = {"_key": [], "_id": [], "item": [], "score": [], "seeds": []}
            items, windows, whose = [], [], []
            for r in range(batch.num_rows):
                row = {k: batch.column(k)[r].as_py() for k in ("gram", "place", "start", "words")}
                diagonals: dict[int, list[int]] = {}
                for g, p in zip(row["gram"], row["place"], strict=True):
                    for k in range(seeds.cuts[g], seeds.cuts[g + 1]):
                        if rare[k]:
                            diagonals.setdefault(int(seeds.post_item[k]), []).append(p - int(seeds.post_at[k]))
                for i, ds in diagonals.items():
                    length = len(seeds.words[i])
                    slack = int(_slack(length, least))
                    ds = sorted(ds)
                    group = [ds[0], ds[0]]
                    groups = [group]
                    for d in ds[1:]:
                        if d - group[1] > slack or d - group[0] > length:
                            group = [d, d]
                            groups.append(group)
                        group[1] = d
                    for lo, hi in groups:
                        lo, hi = lo - slack, hi + length + slack
                        for s, w in zip(row["start"], row["words"], strict=True):
                            a, b = max(lo - s, 0), min(hi - s, len(w))
                            if a < b:
                                items.append(seeds.words[i])
                                windows.append(np.array(w[a:b], np.int64).view(np.uint64))
                                whose.append((r, i, len(ds)))
            best: dict[tuple[int, int], tuple[float, int]] = {}
            for (r, i, n), s in zip(whose, align(items, windows), strict=True):
                share = float(s) / (MATCH * len(seeds.words[i]))
                if share >= least and share > best.get((r, i), (0.0, 0))[0]:
                    best[r, i] = (share, n)
            for (r, i), (share, n) in best.items():
                out["_key"].append(batch.column("_key")[r].as_py())
                out["_id"].append(batch.column("_id")[r].as_py())
                out["item"].append(seeds.ids[i])
                out["score"].append(share)
                out["seeds"].append(n)
            kinds = pa.schema([("_key", pa.string()), ("_id", batch.schema.field("_id").type), ("item", pa.int64()), ("score", pa.float64()), ("seeds", pa.int64())])
            yield pa.RecordBatch.from_pydict(out, kinds)

    return score


def leaks(
    docs: DataFrame, items: DataFrame, n: int = 4, rare_share: float = 0.75, least: float = 0.6, block_words: int = 200_000
) -> DataFrame:
    """(_key, doc_id, item_id, score, seeds): every document that holds an item of the benchmark, or an edited copy.

    Words are runs of non-blank bytes, A-Z lowered. Seeds are the n-grams of words of an item; of these
    the ``rare_share`` found in the fewest documents count (at least eight, and all ties), so an item
    that leaked into very many documents keeps its seeds. Where a document and an item share a rare
    seed, the stretch of the document around it, as far as gaps reach that leave a score of ``least``,
    is aligned with the item by Smith-Waterman (match 2, mismatch and gap -1); ``score`` is the best alignment over that of an exact copy, ``least`` and
    more are returned. Items of fewer than n words seed by their whole sequence.

    The benchmark is taken in blocks of about ``block_words`` words: only a block is ever sent to the
    tasks, and each block is a pass over all documents. Null and empty texts on either side match
    nothing; repeated documents are found again each, repeated rows of an item count once.
    ``item_id`` is taken as a long; items without one are searched like others, found with a null item_id.
    """
    named = items.select(F.col("item_id").cast("long").alias("item_id"), "text").dropDuplicates(["item_id", "text"])
    lists = stored(named.mapInArrow(_word_lists, "item_id long, words array<long>").where(F.size("words") > 0), "benchmark")
    total = lists.agg(F.sum(F.size("words")).alias("n")).first()["n"] or 0
    blocks = -(-total // block_words)
    texts = docs.select(row_key().alias("_key"), F.col("doc_id").alias("_id"), "text").where("text is not null")
    kind = docs.schema["doc_id"].dataType.simpleString()
    parts = []
    for block in range(blocks):
        rows = lists.where(F.pmod(F.xxhash64("item_id", "words"), F.lit(blocks)) == block).orderBy("item_id", "words").collect()
        if not rows:
            continue
        seeds = _seeds(rows, n)
        hits = stored(
            texts.mapInArrow(_scan(seeds, least), f"_key string, _id {kind}, gram array<int>, place array<int>, start array<int>, words array<array<long>>"),
            "seeds",
        )
        spread = np.zeros(len(seeds.grams), np.int64)
        for r in hits.select(F.explode(F.array_distinct("gram")).alias("g")).groupBy("g").agg(F.count(F.lit(1)).alias("n")).collect():
            spread[r["g"]] = r["n"]
        rare = np.zeros(len(seeds.post_item), bool)
        seen = spread[np.repeat(np.arange(len(seeds.grams)), np.diff(seeds.cuts))]
        by_item = np.argsort(seeds.post_item, kind="stable")
        ends = np.cumsum(np.bincount(seeds.post_item, minlength=len(seeds.ids)))
        for i, end in enumerate(ends):
            mine = by_item[ends[i - 1] if i else 0 : end]
            often = np.sort(seen[mine])
            rare[mine] = seen[mine] <= often[min(len(often), max(8, int(np.ceil(rare_share * len(often))))) - 1]
        parts.append(hits.mapInArrow(_score(seeds, rare, least), f"_key string, _id {kind}, item long, score double, seeds long"))
    if not parts:
        spark = docs.sparkSession
        return spark.createDataFrame([], f"_key string, doc_id {kind}, item_id long, score double, seeds long")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("_key", F.col("_id").alias("doc_id"), F.col("item").alias("item_id"), "score", "seeds")


def best_leak(found: DataFrame) -> DataFrame:
    """The item with the highest score of each document; of equal ones the smallest id."""
    order = Window.partitionBy("_key").orderBy(F.desc("score"), "item_id")
    return found.withColumn("_at", F.row_number().over(order)).where("_at = 1").drop("_at")
