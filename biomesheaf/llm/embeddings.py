"""Embedding near-dedup: an inverted multi-index over two vector halves, searched cell by cell, then verified."""

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import components
from .shared import stored

BLOCK, PARTS = 512, 64
LINKS = "node long, links long, tie long"


@dataclass
class MultiIndex:
    """A codebook for either half of a vector; a cell is a pair of codewords, numbered first * size + second."""

    first: np.ndarray
    second: np.ndarray
    visits: int = 0

    def distances(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = self.first.shape[1]
        far = lambda x, c: np.maximum((x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1)[None], 0)
        return far(unit[:, :h], self.first), far(unit[:, h:], self.second)

    def home(self, unit: np.ndarray) -> np.ndarray:
        a, b = self.distances(unit)
        return a.argmin(1) * len(self.second) + b.argmin(1)


def multi_sequence(a: np.ndarray, b: np.ndarray, visits: int) -> list[int]:
    """The ``visits`` nearest cells by the sum of the distances of the halves, nearest first."""
    i, j = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
    x, y, size = a[i].tolist(), b[j].tolist(), len(b)
    heap, pushed, out = [(x[0] + y[0], 0, 0)], {(0, 0)}, []
    while heap and len(out) < visits:
        _, p, q = heapq.heappop(heap)
        out.append(int(i[p]) * size + int(j[q]))
        for r, s in ((p + 1, q), (p, q + 1)):
            if r < len(x) and s < len(y) and (r, s) not in pushed:
                pushed.add((r, s))
                heapq.heappush(heap, (x[r] + y[s], r, s))
    return out


def _rank(a: np.ndarray, b: np.ndarray, cell: int) -> int:
    """How many cells come before ``cell`` in the traversal from these distances."""
    s = a[cell // len(b)] + b[cell % len(b)]
    return int(np.searchsorted(np.sort(b), s - a, "left").sum())


def _scaled(v: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled by a power of two first, so that no square overflows or vanishes."""
    if not len(v):
        return v
    v = np.ldexp(v, -np.frexp(np.abs(v).max(axis=1))[1][:, None])
    return v / np.linalg.norm(v, axis=1)[:, None]


def _units(column: pa.Array, dims: int) -> np.ndarray:
    return _scaled(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes: the driver holds them as numbers, not as objects."""
    for batch in batches:
        v = [np.asarray(x, np.float64).tobytes() for x in batch.column("v").to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(v, pa.binary())], ["v"])


def _codebook(x: np.ndarray, size: int, seed: int, rounds: int = 12) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(size, len(x)), replace=False)]
    for _ in range(rounds):
        own = (centres * centres).sum(1)[None]
        near = np.concatenate([(own - 2 * x[s : s + 4096] @ centres.T).argmin(1) for s in range(0, len(x), 4096)])
        count = np.bincount(near, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, near, x)
        centres = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centres)
    return centres


def fit(classes: DataFrame, dims: int, rows: int, least: float, per_cell: int = 16, most: int = 4096, queries: int = 256, target: float = 0.999) -> MultiIndex:
    """Codebooks and the number of cells to visit.

    Codebooks grow with the root of the number of vectors (``per_cell`` of them to a cell, at most
    ``most`` codewords) and are fitted by k-means on a hashed sample of at most 32 vectors a codeword. The
    number of visits is measured: the links of a bounded sample of ``queries`` vectors are found by
    brute force over all vectors in Spark, with the rank of each partner's cell in the traversal;
    visits are twice the least number that meets the share ``target`` of these links.
    """
    size = int(max(1, min(most, np.ceil(np.sqrt(rows / per_cell)))))

    def picked(seed, n):  # the same rows however they are partitioned
        key = F.pmod(F.xxhash64(F.lit(seed), "node"), F.lit(1 << 40))
        return classes.where(key < int(min(1.0, 1.2 * n / rows) * (1 << 40))).orderBy(key, "node").limit(n)

    packed = picked(3, 32 * size).select("v").mapInArrow(_packed, "v binary").collect()
    sample = np.frombuffer(b"".join(r["v"] for r in packed)).reshape(-1, dims)
    sample = _scaled(sample) if len(sample) else np.ones((1, dims)) / np.sqrt(dims)
    half = max(1, dims // 2)
    index = MultiIndex(_codebook(sample[:, :half], size, 1), _codebook(sample[:, half:], size, 2) if dims > 1 else np.zeros((1, 0)))
    asked = picked(9, queries).select("node", "v").collect()
    if not asked:
        index.visits = 1
        return index
    nodes = np.array([r["node"] for r in asked])
    q = _scaled(np.array([r["v"] for r in asked], np.float64))
    da, db = index.distances(q)

    def ranks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, own = _units(batch.column("v"), dims), batch.column("node").to_numpy()
            i, j = np.nonzero((q @ u.T >= least) & (nodes[:, None] != own[None]))
            if len(i):
                cells = index.home(u)
                seen, n = np.unique([_rank(da[a], db[a], int(cells[b])) for a, b in zip(i, j, strict=True)], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(n, pa.int64())], ["rank", "n"])

    found = classes.select("node", "v").mapInArrow(ranks, "rank long, n long").groupBy("rank").agg(F.sum("n").alias("n")).orderBy("rank").collect()
    total, so_far, need = sum(r["n"] for r in found), 0, 16
    for r in found:
        so_far += r["n"]
        need = max(need, r["rank"] + 1)
        if so_far >= target * total:
            break
    index.visits = int(min(2 * need, len(index.first) * len(index.second)))
    return index


def _placed(index: MultiIndex, dims: int):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                u = _units(part.column("v"), dims)
                a, b = index.distances(u)
                home = a.argmin(1) * len(index.second) + b.argmin(1)
                cells = [multi_sequence(x, y, index.visits) for x, y in zip(a, b, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("node"), part.column("copies"), part.column("v"), pa.array(home, pa.int64()), pa.array(cells, pa.list_(pa.int64()))],
                    ["node", "copies", "v", "home", "cells"],
                )

    return place


def _verified(dims: int, least: float):
    """Counts links of each vector and ties linked vectors to one of their group; a cell's own rows come first."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, own = None, None
        for batch in batches:
            cell, block = batch.column("cell").to_numpy(), batch.column("block").to_numpy()
            visitor = batch.column("visitor").to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((np.diff(cell) != 0) | (np.diff(block) != 0) | (np.diff(visitor.astype(int)) != 0)) + 1
            out = []
            for s, e in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                here = (cell[s], block[s])
                part = batch.slice(s, e - s)
                data = {k: part.column(k).to_numpy() for k in ("node", "copies", "home")} | {"unit": _units(part.column("v"), dims)}
                if not visitor[s]:
                    data["cells"] = part.column("cells").to_pylist()
                    if place == here:  # its own rows go on in this batch
                        data = {k: own[k] + data[k] if k == "cells" else np.concatenate([own[k], data[k]]) for k in data}
                    place, own = here, data
                elif place == here:
                    for at in range(0, e - s, 2048):
                        out += _links({k: v[at : at + 2048] for k, v in data.items()}, own, least)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in zip(*out, strict=True)], ["node", "links", "tie"])

    return verify


def _links(x: dict, y: dict, least: float):
    near = (x["unit"] @ y["unit"].T >= least) & (x["node"][:, None] != y["node"][None])
    if not near.any():
        return
    # A pair met from both sides counts on the visitor's side each time; otherwise for both here.
    met = np.array([np.isin(x["home"], cells) for cells in y["cells"]]).T
    gains = [(x["node"], near @ y["copies"]), (y["node"], (near & ~met).T @ x["copies"])]
    a, b = x["node"].copy(), y["node"].copy()
    top = np.iinfo(np.int64).max
    while True:  # the smallest node of each group of linked vectors
        new_a = np.minimum(a, np.where(near, b[None], top).min(1))
        new_b = np.minimum(b, np.where(near, new_a[:, None], top).min(0))
        if (new_a == a).all() and (new_b == b).all():
            break
        a, b = new_a, new_b
    for (node, links), tie in zip(gains, (a, b), strict=True):
        keep = (links > 0) | (tie != node)
        yield node[keep], links[keep], tie[keep]


def _searched(classes: DataFrame, dims: int, rows: int, kind: str, least: float, **options) -> DataFrame:
    """(node, links, tie) as the blocks counted them, of the classes of one vector length."""
    index = fit(classes, dims, rows, least, **options)
    placed = stored(
        classes.select("node", "copies", "v").mapInArrow(_placed(index, dims), f"node long, copies long, v {kind}, home long, cells array<long>"), "cells"
    )
    blocks = placed.groupBy(F.col("home").alias("cell")).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    owners = placed.select(F.col("home").alias("cell"), "node", "copies", "v", "home", "cells", F.lit(False).alias("visitor")).join(blocks, "cell")
    owners = owners.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    visitors = placed.select(F.explode("cells").alias("cell"), "node", "copies", "v", "home", F.lit(None).cast("array<long>").alias("cells"), F.lit(True).alias("visitor"))
    visitors = visitors.join(blocks, "cell").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    place = ["cell", "block"]
    met = owners.unionByName(visitors).repartition(*place).sortWithinPartitions(*place, "visitor")
    return stored(met.mapInArrow(_verified(dims, least), LINKS), "vector-links")


def near_duplicates(vectors: DataFrame, least: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding", **options) -> DataFrame:
    """(id, n_links, component_id, kept) of every row: links of cosine ``least`` or more, in double precision.

    Equal vectors are one class with a number of copies, so copies are never paired. Each class has a
    home cell in the product of two codebooks (one per half of the unit vector) and visits its
    nearest cells in the order of the multi-sequence algorithm; how many is fitted to a target
    recall (``fit``). Visitors meet a cell's own rows in blocks of about 512, and every pair's cosine
    is computed there, so no false link is counted. A pair is found if either visits the other.
    Tasks give back a count and one tie a vector, not pairs.

    n_links counts the other rows linked directly; component_id is the smallest id reachable, the
    row's own included; kept is true where that is its id. Vectors of different lengths have no cosine
    and never link: each length that has two classes or more gets an index and a search of its own.
    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing;
    such rows and rows of components without any id are kept. Ids are taken as longs.
    """
    v = F.col(vector_col).cast("array<double>")
    sound = (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    kind = "array<float>" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "array<double>"
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.when(sound, F.col(vector_col).cast(kind)).alias("v"))
    rows = rows.withColumn("node", F.when(F.col("v").isNotNull(), F.xxhash64("v")))
    named = stored(rows.select("id", "node"), "vector-nodes")
    alike = rows.where("node is not null").groupBy("node", "v").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"))
    classes = stored(alike, "vector-classes")
    lengths = classes.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").orderBy("d").collect()
    links = [_searched(classes.where(F.size("v") == r["d"]), r["d"], r["n"], kind, least, **options) for r in lengths]
    found = reduce(DataFrame.union, links, vectors.sparkSession.createDataFrame([], LINKS))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    ties = components(found.select(F.col("node").alias("a"), F.col("tie").alias("b"))).select(F.col("id").alias("node"), "component")
    whole = classes.select("node", "id", "copies").join(ties, "node", "left").join(counts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    # A component may hold a third of all vectors: its smallest id is looked up under PARTS keys.
    whole = whole.withColumn("part", F.pmod(F.xxhash64("node"), F.lit(PARTS)))
    parts = whole.groupBy("component", "part").agg(F.min("id").alias("least"))
    smallest = parts.groupBy("component").agg(F.min("least").alias("least"))
    told = whole.join(parts.drop("least").join(smallest, "component"), ["component", "part"]).select("node", "least", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    own = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("least"))
    return named.join(told, "node", "left").select(
        "id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        own.alias("component_id"),
        F.coalesce(F.col("id") == own, own.isNull()).alias("kept"),
    )
