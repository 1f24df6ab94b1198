"""LM scoring: a causal self-attention model over subword ids, trained in numpy inside Spark tasks."""

import base64
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import row_key, stored
from .words import hash_words, text_groups

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: how texts are split before byte pairs are merged, as that vocabulary expects.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Tokens with an embedding of their own, classes of the output, width; positions scored and kept as context in a window.
KNOWN, CLASSES, WIDTH, SCORED, CONTEXT = 4096, 160, 16, 32, 16
#: The most frequent tokens are classes of their own.
ALONE = 96
WINDOW = SCORED + CONTEXT
BUCKETS = 32
#: Places whose class scores are held at once; products of under a million multiplications were the fastest.
PLACES = 352
#: Class scores are raised as powers of two, which numpy does faster than powers of e.
BITS = float(np.log2(np.e))
END_WORD = np.uint64(0x5E5E5E5E5E5E5E5E)


@lru_cache(maxsize=2)
def _encoder(vocabulary: str):
    import tiktoken

    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("subwords", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), max(ranks.values()) + 2


def _subwords(vocabulary: str):
    """The subword ids of each text between two end ids, which begin and close it, as 16-bit numbers."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, size = _encoder(vocabulary)
        for batch in batches:
            for first, last, _, _ in text_groups(batch.column("text")):
                ids = []
                for text in batch.column("text").slice(first, last - first).to_pylist():
                    ids.append(np.array([size - 1, *(encoder.encode_ordinary(text) if text else ()), size - 1], np.uint16).tobytes())
                rest = [batch.column(c).slice(first, last - first) for c in ("_row", "doc_id", "learn")]
                yield pa.RecordBatch.from_arrays([*rest, pa.array(ids, pa.large_binary()).cast(pa.binary())], ["_row", "doc_id", "learn", "ids"])

    return cut


def _sequences(column: pa.Array, limit: int = 1 << 19) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, last, ids, offsets) of groups of texts: up to ``limit`` ids together, or one longer text."""
    sizes = pa.compute.binary_length(column).to_numpy(zero_copy_only=False) // 2
    ends = np.cumsum(sizes)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] - sizes[first] + limit, "right")))
        flat = np.frombuffer(b"".join(column.slice(first, last - first).to_pylist()), np.uint16).astype(np.int32)
        yield first, last, flat, np.concatenate([[0], np.cumsum(sizes[first:last])])
        first = last


def _windows(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, inside, text) of windows: each place but a text's last is among the last SCORED of one window exactly."""
    inputs = np.diff(offsets) - 1
    number = -(-inputs // SCORED)
    text = np.repeat(np.arange(len(inputs)), number)
    first = (np.arange(len(text)) - np.repeat(np.cumsum(number) - number, number)) * SCORED - CONTEXT
    places = (offsets[text] + first)[:, None] + np.arange(WINDOW)
    inside = np.ones(places.shape, bool)
    cut = np.flatnonzero((first < 0) | (first + WINDOW > inputs[text]))
    within = first[cut][:, None] + np.arange(WINDOW)
    inside[cut] = (within >= 0) & (within < inputs[text[cut]][:, None])
    places[~inside] = 0
    return places, inside, text


def _flat(a: np.ndarray) -> np.ndarray:
    return a.reshape(-1, a.shape[-1])


def _largest(a: np.ndarray) -> float:
    return max(a.max(), -a.min())


def _cut(inside: np.ndarray) -> np.ndarray:
    """The windows that reach beyond their text."""
    return np.flatnonzero(~inside.all(axis=1))


def _gathered(model: "SubwordModel", flat: np.ndarray, places: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The known tokens of all windows and the ids that follow their scored places (the first id where nothing is scored)."""
    nexts = places[:, CONTEXT:] + 1
    nexts[~inside[:, CONTEXT:]] = 0
    return model.place[flat].astype(np.uint16).take(places), flat.take(nexts)


@dataclass
class SubwordModel:
    """place: id -> known token; kind: id -> class; within: id -> log10 share in its class; the rest: weights."""

    place: np.ndarray
    kind: np.ndarray
    within: np.ndarray
    weights: dict[str, np.ndarray]
    squares: dict[str, np.ndarray] = field(default_factory=dict)

    @staticmethod
    def fresh(seed: int = 3) -> dict[str, np.ndarray]:
        rng = np.random.default_rng(seed)
        part = lambda *shape: rng.normal(0, 0.3 / np.sqrt(shape[0]), shape).astype(np.float32)
        return {
            "token": rng.normal(0, 0.3, (KNOWN, WIDTH)).astype(np.float32), "position": rng.normal(0, 0.1, (WINDOW, WIDTH)).astype(np.float32),
            "query": part(WIDTH, WIDTH), "key": part(WIDTH, WIDTH), "value": part(WIDTH, WIDTH),
            "out": part(WIDTH, CLASSES), "bias": np.zeros(CLASSES, np.float32),
        }

    def attend(self, tokens: np.ndarray, inside: np.ndarray) -> dict[str, np.ndarray]:
        """What each scored place knows (``h``) of itself and what stands before it in the window, and all else that a step needs.

        Keys and values are not made for all places of a window: ``q`` is the query in terms of the places themselves,
        and the values are taken of what has been ``seen``, both for the scored places only. The attention ``a`` is
        not yet divided by its ``total``; ``h`` ends with a one, for the bias.
        """
        w = self.weights
        x = w["token"].take(tokens, 0)
        x += w["position"]
        late = _flat(x[:, CONTEXT:])
        q = (late @ self._meets()).reshape(len(x), SCORED, WIDTH)
        s = q @ x.transpose(0, 2, 1)
        if _largest(s) > 40:
            np.clip(s, -40, 40, out=s)
        s *= s.dtype.type(BITS)
        np.exp2(s, out=s)
        s *= MASK
        cut = _cut(inside)
        if len(cut):
            s[cut] *= inside[cut][:, None, :]
        total = (_flat(s) @ np.ones(WINDOW, s.dtype))[:, None] + np.float32(1e-30)
        seen = _flat(s @ x)
        seen /= total
        h = np.ones((len(late), WIDTH + 1), late.dtype)
        np.add(seen @ w["value"], late, out=h[:, :WIDTH])
        return {"x": x, "late": late, "q": q, "a": s, "cut": cut, "total": total, "seen": seen, "h": h}

    def _meets(self) -> np.ndarray:
        """Query and key in one: how a place meets another."""
        w = self.weights
        return w["query"] @ w["key"].T * w["query"].dtype.type(1 / np.sqrt(WIDTH))

    def class_scores(self, h: np.ndarray, unit: float = 1.0) -> Iterator[tuple[slice, np.ndarray]]:
        """(places, their class scores) for PLACES places at a time, in one array that is used again and stays in the cache.

        If ``h`` ends with a one for the bias, the product adds it. The scores are ``unit`` times as large.
        """
        w, unit = self.weights, h.dtype.type(unit)
        both = np.concatenate([w["out"], w["bias"][None]]) * unit
        if h.shape[1] == WIDTH:
            h = np.concatenate([h, np.ones((len(h), 1), h.dtype)], 1)
        room = np.empty((min(PLACES, len(h)), CLASSES), h.dtype)
        wide = len(h) and np.einsum("ij,ij->i", h, h).max() * (both * both).sum(axis=0).max() > (80 * unit) ** 2
        for at in range(0, len(h), PLACES):
            part = h[at : at + PLACES]
            z = np.matmul(part, both, out=room[: len(part)])
            if wide:
                np.clip(z, -80 * unit, 80 * unit, out=z)
            yield slice(at, at + len(part)), z

    def forward(self, tokens: np.ndarray, inside: np.ndarray) -> dict[str, np.ndarray]:
        """All class scores (``z``) after each scored place."""
        h = self.attend(tokens, inside)["h"]
        return {"z": np.concatenate([z.copy() for _, z in self.class_scores(h)]).reshape(len(tokens), SCORED, CLASSES)}

    def step(self, tokens: np.ndarray, inside: np.ndarray, target: np.ndarray, rate: float) -> None:
        """One step of gradient descent (AdaGrad) on a batch of windows.

        The wide arrays, one number a place and class, are gone over as seldom as can be: the gradient of
        the class scores is ``e * share``, and only its narrow products are scaled.
        """
        w, f = self.weights, self.attend(tokens, inside)
        x, late, q, a, cut, total, seen, h = (f[k] for k in ("x", "late", "q", "a", "cut", "total", "seen", "h"))
        scored = inside[:, CONTEXT:].ravel()
        real = scored * h.dtype.type(1 / max(1, np.count_nonzero(scored)))
        wanted = target.ravel() + np.arange(0, len(h) * CLASSES, CLASSES)
        dh, both = np.empty_like(late), np.zeros((CLASSES, WIDTH + 1), h.dtype)
        ones, back = np.ones(CLASSES, h.dtype), np.ascontiguousarray(w["out"].T)
        for at, e in self.class_scores(h, BITS):
            np.exp2(e, out=e)
            sums = e @ ones
            e.reshape(-1)[wanted[at] - at.start * CLASSES] -= sums
            share = (real[at] / sums)[:, None]
            np.multiply(e @ back, share, out=dh[at])
            both += e.T @ (h[at] * share)
        du = dh @ w["value"].T
        grad = {"out": both[:, :WIDTH].T, "bias": both[:, WIDTH], "value": seen.T @ dh}
        # what the attention's gradient loses in each of its rows is taken off the narrow products instead
        deep = lambda narrow: narrow.reshape(q.shape)
        off, apart = np.einsum("ij,ij->i", du, seen)[:, None], du / total
        ds = deep(apart) @ x.transpose(0, 2, 1)
        ds *= a
        dq = _flat(ds @ x)
        dq -= off * seen
        dx = ds.transpose(0, 2, 1) @ q
        apart -= off / total * _flat(q)
        dx += a.transpose(0, 2, 1) @ deep(apart)
        dh += dq @ self._meets().T
        dx[:, CONTEXT:] += deep(dh)
        if len(cut):
            dx[cut] *= inside[cut][:, :, None]
        meets = late.T @ dq * h.dtype.type(1 / np.sqrt(WIDTH))
        grad |= {"query": meets @ w["key"], "key": meets.T @ w["query"], "position": dx.sum(0)}
        for name, g in grad.items():
            self._move(name, slice(None), g, rate)
        tokens = tokens.ravel()
        order = np.argsort(tokens.astype(np.uint16, copy=False), kind="stable")
        found = tokens[order]
        first = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
        self._move("token", found[first], np.add.reduceat(_flat(dx).take(order, 0), first, axis=0), rate)

    def _move(self, name, at, g, rate):
        if name not in self.squares:
            self.squares[name] = np.full_like(self.weights[name], 1e-8)
        square = self.squares[name][at]
        square += g * g
        self.squares[name][at] = square
        self.weights[name][at] -= rate * g / np.sqrt(square)


#: A scored place sees no place after it.
MASK = (np.arange(WINDOW)[None] <= (CONTEXT + np.arange(SCORED))[:, None]).astype(np.float32)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of the texts by hash, and one end a text, counted over two million at a time."""
    held, total = [], 0

    def counted():
        word, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n)], ["word", "n"])

    for batch in batches:
        for first, last, b, offsets in text_groups(batch.column("text")):
            h, _ = hash_words(b, offsets)
            held += [h, np.full(last - first, END_WORD)]
            total += len(h) + last - first
            if total >= 2_000_000:
                yield counted()
                held, total = [], 0
    if held:
        yield counted()


def _follows(size: int):
    """How often each subword id follows an id of each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = np.zeros(size * BUCKETS, np.int64)
        for batch in batches:
            for _, _, flat, offsets in _sequences(batch.column("ids")):
                real = np.ones(len(flat), bool)
                real[offsets[:-1]] = False
                at = np.flatnonzero(real)
                pairs += np.bincount(flat[at].astype(np.int64) * BUCKETS + flat[at - 1] % BUCKETS, minlength=len(pairs))
        found = np.flatnonzero(pairs)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(pairs[found])], ["id", "n"])

    return count


def _classes(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Known tokens by count, classes of tokens that follow alike tokens (k-means), and shares within the classes."""
    total = counts.sum(axis=1)
    order = np.lexsort((np.arange(len(total)), -total))[: KNOWN - 1]
    order = order[total[order] > 0]
    place = np.full(len(total), KNOWN - 1)
    place[order] = np.arange(len(order))
    kind = np.full(len(total), CLASSES - 1)
    alone = min(ALONE, len(order))
    kind[order[:alone]] = np.arange(alone)
    order = order[alone:]
    if len(order):
        x = np.sqrt(counts[order] / total[order][:, None])
        weight = total[order].astype(float)
        size = min(CLASSES - 1 - ALONE, len(order))
        centres = x[np.linspace(0, len(order) - 1, size).astype(int)]
        for _ in range(15):
            near = ((x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1)[None]).argmin(1)
            mass = np.bincount(near, weights=weight, minlength=size)
            moved = np.zeros_like(centres)
            np.add.at(moved, near, x * weight[:, None])
            centres = np.where(mass[:, None] > 0, moved / np.maximum(mass, 1)[:, None], centres)
        kind[order] = ALONE + near
    mass, members = np.bincount(kind, weights=total, minlength=CLASSES), np.bincount(kind, minlength=CLASSES)
    within = np.log10((total + 1) / (mass + members)[kind])
    return place, kind, within


def _train(model: SubwordModel, rate: float, batch_windows: int = 64):
    """The weights after a pass over a task's share of a round's texts, with the number of places it learned from."""

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = SubwordModel(model.place, model.kind, model.within, {k: v.copy() for k, v in model.weights.items()})
        rng, places_seen = np.random.default_rng(7), 0
        for batch in batches:
            for _, _, flat, offsets in _sequences(batch.column("ids")):
                places, inside, _ = _windows(offsets)
                known, nexts = _gathered(own, flat, places, inside)
                wanted, places_seen = own.kind.take(nexts), places_seen + int(inside[:, CONTEXT:].sum())
                order = rng.permutation(len(places))
                for at in range(0, len(order), batch_windows):
                    some = order[at : at + batch_windows]
                    own.step(known[some], inside[some], wanted[some], rate)
        if places_seen:
            values = np.concatenate([own.weights[k].ravel() for k in sorted(own.weights)]).astype(np.float64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values * places_seen), pa.array(np.full(len(values), float(places_seen)))], ["at", "value", "n"])

    return train


def train(sequences: DataFrame, size: int, rounds: int = 4, rate: float = 0.08) -> SubwordModel:
    """A model of the column ids of ``sequences``.

    All ids are counted, and every text is learned from once: each of ``rounds`` takes another share of
    them, by a hash, and together they are all. In a round every task descends from the same weights
    over its own part, and Spark averages the weights by the places each has seen. What is gathered
    grows with the texts; the driver gets the averaged weights and the counts of subwords, whose
    sizes are fixed.
    """
    counts = np.zeros(size * BUCKETS, np.int64)
    told = sequences.select("ids").mapInArrow(_follows(size), "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    counts[told["id"].to_numpy(np.int64)] = told["n"]
    counts = counts.reshape(size, BUCKETS)
    model = SubwordModel(*_classes(counts), SubwordModel.fresh())
    mass = np.bincount(model.kind, weights=counts.sum(axis=1), minlength=CLASSES)
    model.weights["bias"] = np.log((mass + 1) / (mass + 1).sum()).astype(np.float32)
    for i in range(rounds):
        part = sequences.where(F.pmod(F.xxhash64(F.lit(31), "_row"), F.lit(rounds)) == i).select("ids")
        mean = part.mapInArrow(_train(model, rate / (1 + i)), "at long, value double, n double").groupBy("at").agg((F.sum("value") / F.sum("n")).alias("value"))
        rows = mean.toPandas().sort_values("at")
        if not len(rows):
            continue
        flat, at = rows["value"].to_numpy(np.float32), 0
        for k in sorted(model.weights):
            shape = model.weights[k].shape
            model.weights[k] = flat[at : at + int(np.prod(shape))].reshape(shape)
            at += int(np.prod(shape))
    return model


def _probabilities(model: SubwordModel):
    """log10 of the probability of each whole text, its end included; windows of all texts are scored in batches."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ones = np.ones(CLASSES, model.weights["out"].dtype)
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for first, last, flat, offsets in _sequences(batch.column("ids")):
                places, inside, text = _windows(offsets)
                known, nexts = _gathered(model, flat, places, inside)
                kind, scores = model.kind.take(nexts), model.within.take(nexts)
                for at in range(0, len(places), 64):
                    h = model.attend(known[at : at + 64], inside[at : at + 64])["h"]
                    wanted = kind[at : at + 64].ravel() + np.arange(0, len(h) * CLASSES, CLASSES)
                    logs, sums = np.empty(len(h), h.dtype), np.empty(len(h), h.dtype)
                    for part, z in model.class_scores(h, BITS):
                        z.reshape(-1).take(wanted[part] - part.start * CLASSES, out=logs[part])
                        np.matmul(np.exp2(z, out=z), ones, out=sums[part])
                    logs *= h.dtype.type(np.log10(2))
                    logs -= np.log10(sums)
                    scores[at : at + 64] += logs.reshape(-1, SCORED)
                scores *= inside[:, CONTEXT:]
                out[first:last] = np.bincount(text, weights=scores.sum(axis=1), minlength=last - first)
            yield pa.RecordBatch.from_arrays([batch.column("_row"), batch.column("doc_id"), pa.array(out)], ["_row", "doc_id", "score"])

    return score


def _find(head: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(head):
        return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
    at = np.minimum(np.searchsorted(head, h), len(head) - 1)
    return at, head[at] == h


def _word_sums(head: np.ndarray, logs: np.ndarray):
    """Rows of two kinds, from one hashing: of each text its words and the sum of the log counts of those in the head, and each word outside.

    Rows of the first kind carry their ``_row`` as a word that occurs 0 times, so that the join spreads them.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("_row").to_numpy()
            for first, last, b, offsets in text_groups(batch.column("text")):
                h, counts = hash_words(b, offsets)
                own, place = np.unique(h, return_inverse=True)
                at, hit = _find(head, own)
                value = np.zeros(len(own))
                value[hit] = logs[at[hit]]
                owner, tail = np.repeat(np.arange(last - first), counts), ~hit[place]
                base = np.bincount(owner, weights=value[place], minlength=last - first)
                (text, word), times = _pairs(owner[tail], h[tail])
                row, more = rows[first:last], len(times)
                columns = [
                    pa.array(np.concatenate([row, row[text]])),
                    pa.array(np.concatenate([row, word.view(np.int64)])),
                    pa.array(np.concatenate([np.zeros(len(row), np.int64), times])),
                    pa.concat_arrays([pa.array(counts.astype(np.int64)), pa.nulls(more, pa.int64())]),
                    pa.concat_arrays([pa.array(base.astype(np.float64)), pa.nulls(more, pa.float64())]),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["_row", "word", "times", "words", "base"])

    return add


def _pairs(owner: np.ndarray, h: np.ndarray):
    if not len(h):
        return (owner, h), np.zeros(0, np.int64)
    order = np.lexsort((h, owner))
    owner, h = owner[order], h[order]
    new = np.flatnonzero(np.concatenate([[True], (np.diff(owner) != 0) | (h[1:] != h[:-1])]))
    return (owner[new], h[new]), np.diff(np.append(new, len(owner)))


def scores(docs: DataFrame, learn: Column, vocabulary: str = VOCABULARY, head_words: int = 65_536, **options) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every row of ``docs``, learned from those where ``learn`` holds.

    Words are runs of non-blank bytes, A-Z lowered; a text has its words and one end. base_score sums
    log10((c + 1) / (N + V + 1)) over them: c the count of a word in the texts learned from, N of all, V the
    number of distinct ones. score is the log10 probability of the text's subwords and its end under
    the attention model, with a two-level output: the class from the context, the subword within the
    class by its count. Windows of 48 places overlap by 16, so every subword is scored once.

    The counts of the ``head_words`` most frequent words, a fixed number, go to the tasks; all other
    words meet their counts in a join. Null texts are empty: one token, the end. With nothing to
    learn from all counts are 0. Equal rows get equal results. Words are told apart by 64-bit hashes.
    ``vocabulary`` is the path of a byte-pair vocabulary that every executor can open.
    """
    size = _encoder(vocabulary)[1]
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(F.xxhash64(row_key()).alias("_row"), "doc_id", F.coalesce(learn, F.lit(False)).alias("learn"), F.coalesce("text", F.lit("")).alias("text"))
    sequences = stored(rows.mapInArrow(_subwords(vocabulary), f"_row long, doc_id {kind}, learn boolean, ids binary"), "lm-subwords")
    model = train(sequences.where("learn"), size, **options)
    words = stored(rows.where("learn").select("text").mapInArrow(_word_counts, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "lm-words")
    sums = words.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    n, v = int(sums["n"] or 0), int(sums["v"] or 0)
    end = words.where(F.col("word") == int(END_WORD.view(np.int64))).first()
    ends = int(end["n"]) if end else 0
    top = words.orderBy(F.desc("n"), "word").limit(head_words).toPandas()
    head = top["word"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(head)
    head, count = head[order], top["n"].to_numpy(np.int64)[order]
    parts = rows.select("_row", "text").mapInArrow(_word_sums(head, np.log10(count + 1.0)), "_row long, word long, times long, words long, base double")
    parts = parts.join(words, "word", "left")
    c, copies = F.coalesce("n", F.lit(0)), F.count("words")  # of equal rows
    told = parts.groupBy("_row").agg(
        F.max("words").alias("n"),
        (F.max("words") - (F.sum(F.when(c > 0, 0).otherwise(F.col("times"))) / copies).cast("long")).alias("seen"),
        (F.max("base") + F.sum(F.col("times") * F.log10(c + 1)) / copies).alias("base"),
    )
    scored = stored(sequences.select("_row", "doc_id", "ids").mapInArrow(_probabilities(model), f"_row long, doc_id {kind}, score double"), "lm-scores")
    base = F.col("base") + float(np.log10(ends + 1.0)) - (F.col("n") + 1) * float(np.log10(n + v + 1.0))
    return scored.join(told, "_row").select(
        "doc_id",
        (F.col("n") + 1).alias("n_tokens"),
        (F.col("seen") + (1 if ends else 0)).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        "score",
    )
