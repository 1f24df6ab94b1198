"""k-mers as numbers: two bits a base, computed for whole Arrow batches at once.

A word of up to 32 bases is one bigint, a longer one (up to 64) a struct of two. Words compare for
equality only: the highest bit is a base like others, so their order as signed numbers means nothing.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import functions as F

#: k-mer starts of one piece of a sequence; bases handled at once, and where the numbers of each should stay in the cache.
PIECE, GROUP, CUT = 1024, 1 << 20, 1 << 16
BAD = 4
CODE = np.full(256, BAD, np.uint8)
for _i, _b in enumerate("ACGT"):
    CODE[[ord(_b), ord(_b.lower())]] = _i
ONE = 32


def _shifted(x: np.ndarray, by: int) -> np.ndarray:
    """x from ``by`` on, as long as before; what lies beyond the end does not count."""
    return np.concatenate([x[by:], np.zeros(min(by, len(x)), x.dtype)])


def _joined(x: np.ndarray, k: int, join) -> np.ndarray:
    """The value of every window of ``k``, from the values of single places, by doubling."""
    have, out = 1, x
    for bit in bin(k)[3:]:
        out, have = join(out, _shifted(out, have), have, have), 2 * have
        if bit == "1":
            out, have = join(out, _shifted(x, have), have, 1), have + 1
    return out


def _forward(code: np.ndarray, k: int) -> np.ndarray:
    return _joined(code, k, lambda a, b, na, nb: (a << np.uint64(2 * nb)) | b)


def _backward(code: np.ndarray, k: int) -> np.ndarray:
    """Of the opposite strand."""
    return _joined(np.uint64(3) - code, k, lambda a, b, na, nb: a | (b << np.uint64(2 * na)))


def window_words(code: np.ndarray, k: int, canonical: bool) -> tuple[np.ndarray, ...]:
    """The word of the window from each place: one array, or (high, low) for more than 32 bases."""
    c = (code & 3).astype(np.uint64)
    if k <= ONE:
        forward = _forward(c, k)
        return (np.minimum(forward, _backward(c, k)) if canonical else forward,)
    high, low = _forward(c, k - ONE), _shifted(_forward(c, ONE), k - ONE)
    if not canonical:
        return high, low
    back_high, back_low = _shifted(_backward(c, k - ONE), ONE), _backward(c, ONE)
    less = (back_high < high) | ((back_high == high) & (back_low < low))
    return np.where(less, back_high, high), np.where(less, back_low, low)


def spoilt(code: np.ndarray, k: int) -> np.ndarray:
    """Windows that hold something else than A, C, G, T (either case)."""
    bad = np.concatenate([[0], np.cumsum(code == BAD)])
    ends = np.minimum(np.arange(len(code)) + k, len(code))
    return bad[ends] != bad[:-1]


def batch_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column, and where each value begins; null is empty."""
    column = column.cast(pa.large_binary())
    column = column.fill_null(b"") if column.null_count else column
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _groups(offsets: np.ndarray, most: int = GROUP) -> Iterator[tuple[int, int]]:
    """Stretches of values with about ``most`` bytes together."""
    first = 0
    while first < len(offsets) - 1:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        yield first, last
        first = last


def word_lists(column: pa.Array, k: int, canonical: bool) -> pa.Array:
    """For each sequence the words of its k-mers in order; null where one is ambiguous."""
    data, offsets = batch_bytes(column)
    counts = np.maximum(np.diff(offsets) - k + 1, 0)
    parts, wrong = [], []
    for first, last in _groups(offsets, CUT):
        code = CODE[data[offsets[first] : offsets[last]]]
        n = counts[first:last]
        at = np.repeat(offsets[first:last] - offsets[first] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        parts.append([w[at].view(np.int64) for w in window_words(code, k, canonical)])
        wrong.append(spoilt(code, k)[at])
    wrong = np.concatenate(wrong) if wrong else np.zeros(0, bool)
    columns = [np.concatenate(p) for p in zip(*parts, strict=True)] if parts else [np.zeros(0, np.int64)] * (1 if k <= ONE else 2)
    if k <= ONE:
        values = pa.array(columns[0], mask=wrong)
    else:
        values = pa.StructArray.from_arrays([pa.array(c) for c in columns], ["hi", "lo"], mask=pa.array(wrong))
    ends = np.concatenate([[0], np.cumsum(counts)])
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), values)


def _check(k: int):
    if not 1 <= k <= 2 * ONE:
        raise ValueError(f"k-mers have 1 to {2 * ONE} bases, not {k}")


def word_type(k: int) -> str:
    _check(k)
    return "bigint" if k <= ONE else "struct<hi:bigint,lo:bigint>"


def words_of(seq, k: int, canonical: bool = False):
    """array of the packed k-mers of a sequence (string or binary), null where ambiguous."""

    @F.arrow_udf(f"array<{word_type(k)}>")
    def words(column: pa.Array) -> pa.Array:
        return word_lists(column, k, canonical)

    return words(F.col(seq) if isinstance(seq, str) else seq)


def word_values(column: pa.Array, k: int, canonical: bool) -> pa.Array:
    """The word of each sequence of k bases; null for another length or ambiguous bases."""
    lists = word_lists(column, k, canonical)
    starts = lists.offsets.to_numpy()
    return lists.values.take(pa.array(starts[:-1], mask=np.diff(starts) != 1))


def packed(kmer, k: int, canonical: bool = False):
    """The packed form of k-mers written as text; null for another length or ambiguous bases."""

    @F.arrow_udf(word_type(k))
    def word(column: pa.Array) -> pa.Array:
        return word_values(column, k, canonical)

    return word(F.col(kmer) if isinstance(kmer, str) else kmer)


def packed_rows(k: int, kmer: str):
    """Batches with the column ``kmer`` -> the canonical ``word`` in its place; rows of another length or ambiguous bases are dropped."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word = word_values(batch.column(kmer), k, True)
            rest = [c for c in batch.schema.names if c != kmer]
            yield pa.RecordBatch.from_arrays([word, *[batch.column(c) for c in rest]], ["word", *rest]).filter(word.is_valid())

    return pack


def unpacked(word, k: int):
    """The text of a packed k-mer of up to 32 bases."""
    word = F.col(word) if isinstance(word, str) else word
    digits = F.lpad(F.conv(F.conv(word.cast("string"), 10, 16), 16, 4), k, "0")
    return F.translate(digits, "0123", "ACGT")


def pieces(df, k: int, *keep, seq="seq"):
    """(kept columns, ``piece``, ``bases``): sequences as overlapping stretches of PIECE k-mer starts, at least one each.

    They are cut as bytes, so that cutting takes time in proportion to the length and no chromosome
    becomes one array.
    """
    seq = F.col(seq) if isinstance(seq, str) else seq
    number = F.greatest(F.lit(1), F.ceil((F.length(seq) - k + 1) / PIECE).cast("int"))
    whole = df.select(*keep, seq.cast("binary").alias("_bases"), number.alias("_n"))
    cut = F.transform(F.sequence(F.lit(0), F.col("_n") - 1), lambda i: F.substring(F.col("_bases"), i * PIECE + 1, F.lit(PIECE + k - 1)))
    return whole.select(*[c for c in whole.columns if c not in ("_bases", "_n")], F.posexplode(cut).alias("piece", "bases"))


def explode_words(df, k: int, *keep, seq="seq", canonical=False):
    """One row per unambiguous k-mer: the kept columns, ``pos`` (0-based) and ``word``. Soft-masked bases count like others."""
    cut = pieces(df, k, *keep, seq=seq)
    kept = [c for c in cut.columns if c not in ("piece", "bases")]
    placed = cut.select(*kept, "piece", F.posexplode(words_of("bases", k, canonical)).alias("_at", "word"))
    return placed.filter(F.col("word").isNotNull()).select(*kept, (F.col("piece") * PIECE + F.col("_at")).alias("pos"), "word")


def halves(word, k: int):
    """A packed word as two numbers, of about half the bases each."""
    word = F.col(word) if isinstance(word, str) else word
    if k > ONE:
        return word["hi"], word["lo"]
    low = 2 * (k // 2)
    return F.shiftrightunsigned(word, low), word.bitwiseAND(F.lit((1 << low) - 1))


def differing_bases(a, b):
    """Bases in which two packed words of up to 32 bases differ."""
    x = a.bitwiseXOR(b)
    return F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x5555555555555555)))


def hit_runs(column: pa.Array, places: pa.Array, taxa: pa.Array, k: int, many: pa.Array | None = None, length: pa.Array | None = None) -> pa.Array:
    """``taxon:count`` for each run of equal labels over the k-mers of each sequence, in order.

    ``places`` and ``taxa`` are lists of the k-mers found, or of the first of ``many``; the others are 0, ambiguous
    ones A. Sequences without ambiguous bases may be null where their ``length`` is given. The labels of all sequences
    are one array, filled by place, so the work is in proportion to the bases.
    """
    data, offsets = batch_bytes(column)
    own = np.maximum(np.diff(offsets) - k + 1, 0)
    counts = own if length is None else np.maximum(own, length.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) - k + 1)
    first = np.concatenate([[0], np.cumsum(counts)])
    label = np.zeros(first[-1], np.int64)
    inside = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
    if len(data):
        label[np.repeat(first[:-1], own) + inside] = np.where(spoilt(CODE[data], k)[np.repeat(offsets[:-1], own) + inside], -1, 0)
    number = places.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    place, taxon = np.repeat(first[:-1], number) + places.flatten().to_numpy(zero_copy_only=False), taxa.flatten().to_numpy(zero_copy_only=False)
    if many is not None:
        n = many.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        place, taxon = np.repeat(place - (np.cumsum(n) - n), n) + np.arange(n.sum()), np.repeat(taxon, n)
    label[place] = taxon
    new = np.ones(len(label), bool)
    new[1:] = label[1:] != label[:-1]
    new[first[:-1][counts > 0]] = True
    begin = np.flatnonzero(new)
    named = pa.array(label[begin]).cast(pa.string())
    named = pa.compute.if_else(pa.array(label[begin] < 0), "A", named)
    sizes = pa.array(np.diff(np.append(begin, len(label)))).cast(pa.string())
    runs = pa.compute.binary_join_element_wise(named, sizes, ":")
    return pa.compute.binary_join(pa.ListArray.from_arrays(pa.array(np.searchsorted(begin, first).astype(np.int32)), runs), " ")


# ---------------------------------------------------------------- runs of k-mers with one minimizer

MIXER = np.uint64(0xD6E8FEB86659FD93)


def _spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * MIXER
    return x ^ (x >> np.uint64(29))


def minimizers(code: np.ndarray, k: int, m: int) -> np.ndarray:
    """The minimizer of every window: the least of its canonical m-mers in a shuffled order, strand aside."""
    order = _spread(window_words(code, m, True)[0])
    return _joined(order, k - m + 1, lambda a, b, na, nb: np.minimum(a, b))


def _packed_slices(code: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """The given slices as binary values, four bases a byte."""
    padded = -(-sizes // 4) * 4
    first = np.concatenate([[0], np.cumsum(padded)])
    inside = np.arange(first[-1]) - np.repeat(first[:-1], padded)
    at = np.repeat(starts, padded) + inside
    quads = np.where(inside < np.repeat(sizes, padded), code[np.minimum(at, len(code) - 1)] & 3, 0).astype(np.uint8).reshape(-1, 4)
    data = (quads[:, 0] << 6) | (quads[:, 1] << 4) | (quads[:, 2] << 2) | quads[:, 3]
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer((first // 4).astype(np.int32)), pa.py_buffer(data)])


def _unpacked_slices(column: pa.Array, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The codes of packed slices one after the other, each still padded to whole bytes, and where each begins."""
    data, offsets = batch_bytes(column)
    code = np.empty((len(data), 4), np.uint8)
    for i in range(4):
        code[:, i] = (data >> np.uint8(6 - 2 * i)) & np.uint8(3)
    return code.reshape(-1), offsets * 4


def folded(t: pa.Table, most: int) -> pa.Table:
    """Rows of equal runs (sample, bases, size) that stand for more than ``most`` together become one without an owner.

    All words of such a run are seen more than ``most`` times, so it does not matter any more where.
    """
    if not t.num_rows:
        return t
    t = t.combine_chunks()
    code = lambda c: t.column(c).combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    sample, size, n = code("sample"), t.column("size").to_numpy().astype(np.int64), t.column("n").to_numpy()
    key = (code("bases") * (size.max() + 1) + size) * (sample.max() + 2) + sample + 1
    _, first, of = np.unique(key, return_index=True, return_inverse=True)
    total = np.bincount(of, n).astype(np.int64)
    many = total > most
    if not many.any():
        return t
    lone = np.flatnonzero(~many[of])
    heads = first[many]
    rows = np.concatenate([lone, heads])
    out = t.take(pa.array(rows))
    own = np.concatenate([np.ones(len(lone), bool), np.zeros(len(heads), bool)])
    owner = out.column("owner").combine_chunks()
    owner = pa.compute.if_else(pa.array(own), owner, pa.nulls(len(owner), owner.type))
    counted = np.concatenate([n[lone], total[many]])
    for name, values in (("owner", owner), ("n", pa.array(counted, pa.int64()))):
        at = out.schema.get_field_index(name)
        out = out.set_column(at, out.schema.field(at), values)
    return out


def _cut_runs(data: np.ndarray, offsets: np.ndarray, first: int, last: int, k: int, m: int) -> tuple[np.ndarray, ...]:
    """Codes of the sequences from ``first`` to ``last``, the sequence of each base, and begin, size and minimizer of the runs."""
    code = CODE[data[offsets[first] : offsets[last]]]
    ends = offsets[first + 1 : last + 1] - offsets[first]
    read = np.repeat(np.arange(first, last), np.diff(offsets[first : last + 1]))
    room = ends[read - first] - np.arange(len(code))
    good = (room >= k) & ~spoilt(code, k)
    least = minimizers(code, k, m)
    same = np.zeros(len(code), bool)
    same[1:] = good[1:] & good[:-1] & (read[1:] == read[:-1]) & (least[1:] == least[:-1])
    begin = np.flatnonzero(good & ~same)
    stop = np.flatnonzero(good & ~np.append(same[1:], False))
    return code, read, begin, stop - begin + k, least[begin]


def run_batches(k: int, m: int, most: int):
    """Batches of (sample, owner, seq) -> (sample, owner, minimizer, size, bases, n): the runs of their k-mers."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = batch_bytes(batch.column("seq"))
            for first, last in _groups(offsets):
                if offsets[last] - offsets[first] < k:
                    continue
                code, read, begin, sizes, least = _cut_runs(data, offsets, first, last, k, m)
                rows = pa.array(read[begin])
                t = pa.table(
                    {
                        "sample": batch.column("sample").take(rows),
                        "owner": batch.column("owner").take(rows),
                        "minimizer": pa.array(least.view(np.int64)),
                        "size": pa.array(sizes.astype(np.int32)),
                        "bases": _packed_slices(code, begin, sizes),
                        "n": pa.array(np.ones(len(begin), np.int64)),
                    }
                )
                yield from folded(t, most).combine_chunks().to_batches()

    return runs


def rare_owners(k: int, most: int):
    """Runs sorted by (sample, minimizer) -> (sample, owner) of those with a word seen at most ``most`` times in the sample.

    A word has one minimizer, so all its runs are in one group. Groups are counted as many at a time as
    a batch holds; of one that goes on over batches the rows that do not tell anything new are folded.
    """

    def count(t: pa.Table) -> pa.Table:
        sizes = t.column("size").to_numpy().astype(np.int64)
        code, begin = _unpacked_slices(t.column("bases").combine_chunks(), sizes)
        n = sizes - k + 1
        row = np.repeat(np.arange(len(sizes)), n)
        at = begin[:-1][row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        words = [w[at] for w in window_words(code, k, True)]
        sample = t.column("sample").combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)[row]
        order = np.lexsort((*words, sample))
        new = np.zeros(len(order), bool)
        new[:1] = True
        for x in (*words, sample):
            new[1:] |= x[order][1:] != x[order][:-1]
        heads = np.flatnonzero(new)
        total = np.add.reduceat(t.column("n").to_numpy()[row[order]], heads)
        rare = np.repeat(total <= most, np.diff(np.append(heads, len(order))))
        return t.select(["sample", "owner"]).take(pa.array(np.unique(row[order[rare]]))).combine_chunks()

    def owners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, limit = None, 1 << 16
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            t = (pa.concat_tables([held, t]) if held is not None else t).combine_chunks()
            last = t.slice(t.num_rows - 1)
            same = pa.compute.equal(t.column("minimizer"), last.column("minimizer")[0]).to_numpy(zero_copy_only=False)
            named = t.column("sample").combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
            other = np.flatnonzero(~(same & (named == named[-1])))
            cut = int(other[-1]) + 1 if len(other) else 0
            if cut:
                yield from count(t.slice(0, cut)).to_batches()
            held = t.slice(cut)
            if held.num_rows > limit:
                held = folded(held, most)
                limit = max(1 << 16, 2 * held.num_rows)
        if held is not None:
            yield from count(held).to_batches()

    return owners


# ---------------------------------------------------------------- runs of reads that meet a table of words

#: Bins of minimizers; runs or words dealt at once; runs looked up at once, few enough for the cache; bases of a list.
BINS, DEAL, MEET, LIST = 4096, 1 << 20, 1 << 13, 1 << 18


def _bin_of(least: np.ndarray) -> np.ndarray:
    return (least & np.uint64(BINS - 1)).astype(np.int32)


def _dealt(tables: list[pa.Table], by: list[str], then: tuple[str, ...]) -> pa.RecordBatch:
    """One row for all rows with the same ``by``: the other columns become lists, packed bases one value after the other.

    Rows with the same ``then`` are next to each other in the lists, so that these are few bytes when compressed.
    Lists of runs end where they have LIST bases, since sequences of few kinds of words fall into one bin.
    """
    t = pa.concat_tables(tables).combine_chunks()

    def numbered(key: np.ndarray, names) -> np.ndarray:
        for name in names:
            code = t.column(name).combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64) + 1
            key = key * (code.max(initial=0) + 1) + code
        return key

    key = numbered(np.zeros(t.num_rows, np.int64), by)
    order = np.argsort(numbered(key, then), kind="stable")
    rows, key = t.take(pa.array(order)).combine_chunks(), key[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    if "size" in rows.column_names:
        size = rows.column("size").to_numpy().astype(np.int64)
        before, first = np.cumsum(size) - size, np.flatnonzero(new)
        part = (before - np.repeat(before[first], np.diff(np.append(first, len(key))))) // LIST
        new[1:] |= part[1:] != part[:-1]
    first = np.flatnonzero(new)
    ends = np.append(first, len(key)).astype(np.int32)
    columns = {}
    for name in rows.column_names:
        values = rows.column(name).combine_chunks()
        if name in by:
            columns[name] = values.take(pa.array(first))
        elif name == "bases":
            data, offsets = batch_bytes(values)
            columns[name] = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets[ends].astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])
        else:
            columns[name] = pa.ListArray.from_arrays(pa.array(ends), values)
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _in_deals(tables: Iterator[pa.Table], by: list[str], then: tuple[str, ...] = ()) -> Iterator[pa.RecordBatch]:
    held, total = [], 0
    for t in tables:
        held.append(t)
        total += t.num_rows
        if total >= DEAL:
            yield _dealt(held, by, then)
            held, total = [], 0
    if total:
        yield _dealt(held, by, then)


def run_bins(k: int, m: int):
    """Batches of (sample, owner, length, bases) -> (bin, sample, owner, length, size, bases): runs, in lists by bin and sample.

    A length that is not null comes out once: with the first run of its sequence, or with a run of no bases if it has none.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        for batch in batches:
            data, offsets = batch_bytes(batch.column("bases"))
            known = batch.column("length").is_valid().to_numpy(zero_copy_only=False)
            for first, last in _groups(offsets, CUT):
                code, read, begin, sizes, least = _cut_runs(data, offsets, first, last, k, m)
                row = read[begin]
                bare = np.ones(last - first, bool)
                bare[row - first] = False
                bare = first + np.flatnonzero(bare & known[first:last])
                again = np.concatenate([np.zeros(1, bool), row[1:] == row[:-1]])[: len(row)]
                rows, none = pa.array(np.concatenate([row, bare])), np.zeros(len(bare), np.int64)
                length = batch.column("length").take(pa.array(np.concatenate([row, bare]), mask=np.concatenate([again, none > 0])))
                yield pa.table(
                    {
                        "bin": pa.array(np.concatenate([_bin_of(least), (bare % BINS).astype(np.int32)])),
                        "sample": batch.column("sample").take(rows),
                        "owner": batch.column("owner").take(rows),
                        "length": length,
                        "size": pa.array(np.concatenate([sizes, none]).astype(np.int32)),
                        "bases": _packed_slices(code if len(code) else np.zeros(1, np.uint8), np.concatenate([begin, none]), np.concatenate([sizes, none])),
                    }
                )

    return lambda batches: _in_deals(cut(batches), ["bin", "sample"])


def run_places(k: int, m: int):
    """Batches of (sample, pair_id, mate, piece, bases) -> (bin, sample, pair_id, mate, start, size, bases): runs, in lists by bin and sample.

    ``start`` is the run's first place in the sequence of which the bases are a piece; a run's ``size`` is below that of a piece.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        for batch in batches:
            data, offsets = batch_bytes(batch.column("bases"))
            piece = batch.column("piece").to_numpy(zero_copy_only=False).astype(np.int64)
            for first, last in _groups(offsets, CUT):
                code, read, begin, sizes, least = _cut_runs(data, offsets, first, last, k, m)
                row = read[begin]
                start = piece[row] * PIECE + begin + offsets[first] - offsets[row]
                yield pa.table(
                    {
                        "bin": pa.array(_bin_of(least)),
                        **{c: batch.column(c).take(pa.array(row)) for c in ("sample", "pair_id", "mate")},
                        "start": pa.array(start.astype(np.int32)),
                        "size": pa.array(sizes.astype(np.int16)),
                        "bases": _packed_slices(code, begin, sizes),
                    }
                )

    return lambda batches: _in_deals(cut(batches), ["bin", "sample"], ("mate",))


def _numbers(words: pa.Array) -> tuple[np.ndarray, ...]:
    """Packed words as one array, or as (high, low)."""
    parts = words.flatten() if pa.types.is_struct(words.type) else [words]
    return tuple(p.to_numpy(zero_copy_only=False).view(np.uint64) for p in parts)


def word_bins(k: int, m: int):
    """Batches of (word, ...) -> (bin, word, ...): the words, and all else that comes with them, in lists by the bin of their minimizer."""
    shifts = [(part, 2 * i) for part, n in enumerate([k] if k <= ONE else [k - ONE, ONE]) for i in reversed(range(n))]

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        for batch in batches:
            for at in range(0, batch.num_rows, CUT // k):
                part = batch.slice(at, CUT // k)
                words = _numbers(part.column("word"))
                code = np.empty((part.num_rows, k), np.uint8)
                for i, (of, by) in enumerate(shifts):
                    code[:, i] = (words[of] >> np.uint64(by)).astype(np.uint8) & np.uint8(3)
                least = minimizers(code.reshape(-1), k, m)[::k]
                yield pa.table({"bin": pa.array(_bin_of(least)), **{c: part.column(c) for c in part.schema.names}})

    return lambda batches: _in_deals(binned(batches), ["bin"])


def _search_key(words: tuple[np.ndarray, ...]) -> np.ndarray:
    return words[0] if len(words) == 1 else _spread(words[0] ^ MIXER) ^ words[1]


def _meet(columns: list[str], met):
    """Rows of word_bins and of runs, sorted by bin and words first -> ``met`` of some rows and the words of their bins.

    All words of a bin, with the named columns, are held at once, of the runs MEET (fewer if they are long) or one list at a time.
    """

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            words, sizes = (batch.column(c).value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("word", "size"))
            packed_bytes = pa.compute.binary_length(batch.column("bases")).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            number = words + np.maximum(sizes, packed_bytes // 8)
            ends = np.cumsum(number)
            first = 0
            while first < batch.num_rows:
                last = max(first + 1, int(np.searchsorted(ends, ends[first] - number[first] + MEET, "right")))
                part = batch.slice(first, last - first)
                first = last
                bins = part.column("bin").to_numpy()
                counts = part.column("word").value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                own = pa.table({"bin": pa.array(np.repeat(bins, counts)), **{c: part.column(c).flatten() for c in ("word", *columns)}})
                table = pa.concat_tables([held, own]).combine_chunks() if held is not None else own
                held = table.filter(pa.array(table.column("bin").to_numpy() == bins[-1]))
                yield met(part, table)

    return meet


def meet_words(k: int, taxon: list[str]):
    """Rows of word_bins and run_bins, sorted by bin and words first -> (sample, owner, *taxon, hits, length).

    Every run is cut into its words; of those in the table the hits are counted per run and taxon.
    """
    return _meet(taxon, lambda part, table: _met(part, table, k, taxon))


def meet_places(k: int):
    """Rows of word_bins (word, taxon) and run_places, sorted by bin and words first -> (sample, pair_id, mate, pos, taxon, n).

    Every run is cut into its words; of those in the table one row tells each stretch with the same taxon. Of a
    word that the table has more than once the smallest taxon counts.
    """
    return _meet(["taxon"], lambda part, table: _met_places(part, table, k))


def _looked_up(part: pa.RecordBatch, table: pa.Table, k: int) -> tuple[np.ndarray, ...]:
    """The words of the runs that the table has: the run of each, its place in the run, and its row in the table."""
    sizes = part.column("size").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    data, _ = batch_bytes(part.column("bases"))
    code = np.empty((len(data), 4), np.uint8)
    for i in range(4):
        code[:, i] = (data >> np.uint8(6 - 2 * i)) & np.uint8(3)
    padded = -(-sizes // 4) * 4
    n = np.maximum(sizes - k + 1, 0)
    run = np.repeat(np.arange(len(sizes)), n)
    inside = np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n)
    at = np.repeat(np.cumsum(padded) - padded, n) + inside
    asked = tuple(w[at] for w in window_words(code.reshape(-1), k, True))
    known = _numbers(table.column("word").combine_chunks())
    key = _search_key(known)
    order = np.argsort(key)
    key, known = key[order], tuple(w[order] for w in known)
    if not (len(key) and len(run)):
        return (np.zeros(0, np.int64),) * 3
    heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    of, times = key[heads], np.diff(np.append(heads, len(key)))
    wanted = _search_key(asked)
    # Most words that are not in the table fall on a place that none of it has.
    bits = np.uint64(64 - max(16, (8 * len(of)).bit_length()))
    taken = np.zeros(1 << (64 - int(bits)), bool)
    taken[_spread(of) >> bits] = True
    hit = np.flatnonzero(taken[_spread(wanted) >> bits])
    place = np.minimum(np.searchsorted(of, wanted[hit]), len(of) - 1)
    here = of[place] == wanted[hit]
    hit, place = hit[here], place[here]
    # A word that repeats in the table counts each time; of two numbers only the whole word counts.
    again = times[place]
    hit, start = np.repeat(hit, again), np.repeat(heads[place] - (np.cumsum(again) - again), again)
    found = start + np.arange(len(start))
    same = np.logical_and.reduce([a[hit] == b[found] for a, b in zip(asked, known, strict=True)])
    hit = hit[same]
    return run[hit], inside[hit], order[found[same]]


def _block(part: pa.RecordBatch) -> np.ndarray:
    """The row of each run."""
    return np.repeat(np.arange(part.num_rows), part.column("size").value_lengths().fill_null(0).to_numpy(zero_copy_only=False))


def _met(part: pa.RecordBatch, table: pa.Table, k: int, taxon: list[str]) -> pa.RecordBatch:
    owner, length = part.column("owner").flatten(), part.column("length").flatten()
    block = _block(part)
    run, _, found = _looked_up(part, table, k)
    values = [table.column(c).combine_chunks() for c in taxon]
    labels = [v.to_numpy(zero_copy_only=False)[found] for v in values]
    order = np.lexsort((*labels, run))
    run, found, labels = run[order], found[order], [x[order] for x in labels]
    new = np.ones(len(run), bool)
    if len(run):
        new[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in (run, *labels)])
    first = np.flatnonzero(new)
    told = np.flatnonzero(length.is_valid().to_numpy(zero_copy_only=False))
    rows = np.concatenate([run[first], told])
    none = np.concatenate([np.zeros(len(first), bool), np.ones(len(told), bool)])
    picked = pa.array(np.concatenate([found[first], told]), mask=none)
    hits = np.concatenate([np.diff(np.append(first, len(run))), np.zeros(len(told), np.int64)])
    columns = {"sample": part.column("sample").take(pa.array(block[rows])), "owner": owner.take(pa.array(rows))}
    columns |= {c: v.take(picked) for c, v in zip(taxon, values, strict=True)}
    columns |= {"hits": pa.array(hits, mask=none), "length": length.take(pa.array(rows, mask=~none))}
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _met_places(part: pa.RecordBatch, table: pa.Table, k: int) -> pa.RecordBatch:
    run, pos, found = _looked_up(part, table, k)
    taxon = table.column("taxon").combine_chunks().to_numpy(zero_copy_only=False)[found]
    order = np.lexsort((taxon, pos, run))
    run, pos, taxon = run[order], pos[order], taxon[order]
    one = np.ones(len(run), bool)
    one[1:] = (run[1:] != run[:-1]) | (pos[1:] != pos[:-1])
    run, pos, taxon = run[one], pos[one], taxon[one]
    new = np.ones(len(run), bool)
    new[1:] = (run[1:] != run[:-1]) | (pos[1:] != pos[:-1] + 1) | (taxon[1:] != taxon[:-1])
    first = np.flatnonzero(new)
    rows = pa.array(run[first])
    columns = {"sample": part.column("sample").take(pa.array(_block(part)[run[first]])), **{c: part.column(c).flatten().take(rows) for c in ("pair_id", "mate")}}
    start = part.column("start").flatten().to_numpy(zero_copy_only=False)[run[first]]
    columns |= {"pos": pa.array((start + pos[first]).astype(np.int32)), "taxon": pa.array(taxon[first]), "n": pa.array(np.diff(np.append(first, len(run))).astype(np.int32))}
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))
