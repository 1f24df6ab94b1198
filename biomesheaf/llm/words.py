"""Words, shingles and byte n-grams of whole texts as numpy arrays, for use inside Arrow batches.

A word is a run of bytes other than blank and 0x09-0x0D, with A-Z lowered; it is known by a 64-bit
hash. Hashes of all words of a piece of text come from one running sum of weighted bytes, so nothing
loops over words. Texts are taken in groups of bounded size; one longer than that is cut at blanks.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: All of ASCII but letters and digits.
NOT_TERM = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BASE = 0x9E3779B97F4A7C15
CODE = np.random.default_rng(20_111).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
PIECE = 1 << 18

_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _weights(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base modulo 2**64 and their inverses."""
    if len(_powers[0]) < n:
        size = max(n, 2 * PIECE + 8192)
        for k, base in enumerate((BASE, pow(BASE, -1, 2**64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and where each text begins; nulls are empty texts."""
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), offsets


def text_groups(column: pa.Array, limit: int = 2 * PIECE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, last, bytes, offsets) of consecutive texts: up to ``limit`` bytes together, or one longer text."""
    data, offsets = text_bytes(column)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        last = min(last, len(column))
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last
    pa.default_memory_pool().release_unused()


def _hash_piece(b: np.ndarray, cuts: np.ndarray, blank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and hash of the words of ``b``; no word crosses a cut."""
    n = len(b)
    power, inverse = _weights(n + 1)
    space = blank[b]
    begin, end = np.ones(n, bool), np.ones(n, bool)
    begin[1:], end[:-1] = space[:-1], space[1:]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    begin[cuts] = True
    end[cuts - 1] = True
    begin &= ~space
    end &= ~space
    s, e = np.flatnonzero(begin), np.flatnonzero(end) + 1
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(CODE[LOWER[b]] * power[:n], out=total[1:])
    return s, e, mixed((total[e] - total[s]) * inverse[s])


def _pieces(b: np.ndarray, limit: int = 2 * PIECE) -> Iterator[tuple[int, int]]:
    at = 0
    while len(b) - at > limit:
        stop = at + limit
        while stop < len(b):  # to the next blank
            blanks = np.flatnonzero(SPACE[b[stop : stop + 4096]])
            if len(blanks):
                stop += int(blanks[0])
                break
            stop += 4096
        stop = min(stop, len(b))
        yield at, stop
        at = stop
    if at < len(b):
        yield at, len(b)


def hash_words(b: np.ndarray, offsets: np.ndarray, blank: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a group of texts in order, and the number of words of each text.

    ``blank`` marks the bytes between words.
    """
    starts, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for s, e in _pieces(b):
        begin, _, h = _hash_piece(b[s:e], offsets - s, blank)
        starts.append(begin + s)
        hashes.append(h)
    return np.concatenate(hashes), np.diff(np.searchsorted(np.concatenate(starts), offsets))


def term_hashes(b: np.ndarray, offsets: np.ndarray, prefixes: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the terms of a group of texts, and the text of each: runs of letters and digits, and their beginnings.

    A word longer than one of ``prefixes`` (in bytes) also counts with so much of its beginning.
    """
    hashes, texts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for at, stop in _pieces(b):
        part = b[at:stop]
        s, e, h = _hash_piece(part, offsets - at, NOT_TERM)
        power, inverse = _weights(len(part) + 1)
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(CODE[LOWER[part]] * power[: len(part)], out=total[1:])
        owner = np.searchsorted(offsets, s + at, "right") - 1
        hashes.append(h)
        texts.append(owner)
        for size in prefixes:
            long = e - s > size
            hashes.append(mixed((total[s[long] + size] - total[s[long]]) * inverse[s[long]]))
            texts.append(owner[long])
    return np.concatenate(hashes), np.concatenate(texts)


def shingles(h: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of ``k`` words, in order, and how many each text has.

    A text of fewer than ``k`` words, but at least one, has its whole sequence as its only shingle.
    """
    step = np.uint64(0xC2B2AE3D27D4EB4F)
    ends = np.cumsum(counts)
    short = (counts > 0) & (counts < k)
    number = np.where(counts >= k, counts - k + 1, short.astype(counts.dtype))
    if not len(h):
        return np.zeros(0, np.uint64), number
    left = np.repeat(ends, counts) - np.arange(len(h))
    here = left >= k
    lone = (ends - counts)[short]
    here[lone] = True
    at = np.flatnonzero(here)
    padded = np.concatenate([h, np.zeros(k, np.uint64)])
    total, factor = np.zeros(len(at), np.uint64), np.uint64(1)
    room = left[at]
    for j in range(k):
        total += np.where(room > j, padded[at + j] * factor, np.uint64(0))
        factor = np.uint64(int(factor) * int(step) % 2**64)
    if short.any():
        total += (np.maximum(k - room, 0)).astype(np.uint64) * np.uint64(0xA24BAED4963EE407)
    return mixed(total), number


def byte_grams(b: np.ndarray, offsets: np.ndarray, sizes: tuple[int, ...], bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets of the byte n-grams within each text (A-Z lowered, all blanks alike), with the text each belongs to."""
    low = LOWER[b]
    low[SPACE[b]] = 32
    low = low.astype(np.uint32)
    n = len(low)
    text = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    for size in sizes:
        if n < size:
            continue
        g = low[: n - size + 1].copy()
        for j in range(1, size):
            g ^= low[j : n - size + 1 + j] << np.uint32(8 * j)
        g = (g + np.uint32(size)) * np.uint32(2654435761)
        inside = text[: n - size + 1] == text[size - 1 :]
        yield (g >> np.uint32(32 - bits))[inside], text[: n - size + 1][inside]
