"""Panels of adapters as tables of seeds.

A match of n bases with at most m mismatches leaves one of m + 1 disjoint parts of the adapter
unchanged. The parts of all adapters are kept as sorted numbers; a read's words are looked up there and
bases are compared at hits only, so a longer panel costs a longer binary search, not more passes.
"""

from functools import lru_cache

import numpy as np

# Any odd number does; words that collide are told apart when their bases are compared.
BASE = 0x9E3779B97F4A7C15
CELLS = 1 << 22


def _powers(base, n):
    factors = np.full(n + 1, base, dtype=np.uint64)
    factors[0] = 1
    return np.multiply.accumulate(factors)


def running_words(cells):
    """Column i: the number of the first i bytes of each row; differences number any part of a row."""
    sums = np.zeros((cells.shape[0], cells.shape[1] + 1), dtype=np.uint64)
    np.cumsum(cells * _powers(BASE, cells.shape[1])[: cells.shape[1]], axis=1, out=sums[:, 1:])
    return sums


def _parts(size, mistakes):
    """(offset, width) of the parts of which one is unchanged."""
    width = size // (mistakes + 1)
    return [(i * width, width) for i in range(mistakes + 1)]


class SeedTable:
    def __init__(self, words, owners):
        order = np.argsort(words, kind="stable")
        self.words, self.owners = words[order], owners[order]

    def hits(self, words, at_once):
        """(index of a word, owner of an equal seed), at most about ``at_once`` at a time."""
        low = np.searchsorted(self.words, words)
        found = np.flatnonzero(self.words[np.minimum(low, len(self.words) - 1)] == words)
        low = low[found]
        counts = np.searchsorted(self.words, words[found], "right") - low
        ends, begin = np.cumsum(counts), 0
        while begin < len(found):
            done = ends[begin - 1] if begin else 0
            stop = max(begin + 1, int(np.searchsorted(ends, done + at_once, "right")))
            n = counts[begin:stop]
            nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            yield np.repeat(found[begin:stop], n), self.owners[np.repeat(low[begin:stop], n) + nth]
            begin = stop


class AdapterPanel:
    """Seeds of whole adapters by width, and of adapter starts by the number of bases that are left."""

    def __init__(self, adapters, error_rate, min_overlap):
        if not 0 <= error_rate < 1:
            raise ValueError("error_rate is at least 0 and below 1")
        self.allowed = lambda size: int(np.floor(error_rate * size))
        texts = sorted({a for a in adapters if len(a) >= min_overlap})
        self.sizes = np.array([len(a) for a in texts], dtype=np.int64)
        self.longest = int(self.sizes.max()) if len(texts) else 0
        if not texts:
            return
        self.cells = np.array(texts, dtype=f"S{self.longest}").view(np.uint8).reshape(len(texts), self.longest)
        self.mistakes = np.array([self.allowed(n) for n in self.sizes])
        sums, inverse = running_words(self.cells), _powers(pow(BASE, -1, 1 << 64), self.longest)
        by_width = {}
        for i, size in enumerate(self.sizes):
            for offset, width in _parts(int(size), self.mistakes[i]):
                by_width.setdefault(width, []).append((i, offset))
        self.whole = []
        for width, seeds in sorted(by_width.items()):
            owner, offset = np.array(seeds).T
            words = (sums[owner, offset + width] - sums[owner, offset]) * inverse[offset]
            self.whole.append((width, SeedTable(words, np.arange(len(words))), owner, offset))
        self.starts = []
        for size in range(self.longest - 1, min_overlap - 1, -1):
            longer = np.flatnonzero(self.sizes > size)
            _, one_each = np.unique(self.cells[longer, :size], axis=0, return_index=True)
            which = longer[one_each]
            parts = _parts(size, self.allowed(size))
            self.starts.append(
                (size, [(o, w, SeedTable((sums[which, o + w] - sums[which, o]) * inverse[o], which)) for o, w in parts])
            )

    def _matching(self, cells, rows, begins, adapters, sizes, mistakes):
        """Which of the placements have no more than the allowed mismatches over ``sizes`` bases."""
        across = np.arange(int(sizes.max()))
        differ = cells[rows[:, None], begins[:, None] + across] != self.cells[adapters][:, across]
        return (differ & (across < sizes[:, None])).sum(axis=1) <= mistakes

    def cuts(self, cells, sizes):
        """Leftmost start of a match in each row; ``sizes`` where there is none.

        ``cells`` has at least ``longest`` zero columns behind the longest row.
        """
        best = sizes.copy()
        if not self.longest or not len(sizes):
            return best
        width, at_once = int(sizes.max()), max(1, CELLS // self.longest)
        sums, inverse = running_words(cells[:, :width]), _powers(pow(BASE, -1, 1 << 64), width)

        def keep_leftmost(rows, begins, adapters, lengths, mistakes):
            if len(rows):
                good = self._matching(cells, rows, begins, adapters, lengths, mistakes)
                np.minimum.at(best, rows[good], begins[good])

        for seed, table, owner, offset in self.whole:
            places = width - seed + 1
            if places <= 0:
                continue
            words = (sums[:, seed:] - sums[:, :places]) * inverse[:places]
            for at, found in table.hits(words.ravel(), at_once):
                rows, adapters = at // places, owner[found]
                begins = at % places - offset[found]
                fits = (begins >= 0) & (begins < best[rows]) & (begins + self.sizes[adapters] <= sizes[rows])
                rows, begins, adapters = rows[fits], begins[fits], adapters[fits]
                keep_leftmost(rows, begins, adapters, self.sizes[adapters], self.mistakes[adapters])
        for size, seeds in self.starts:
            open_rows = np.flatnonzero((sizes >= size) & (sizes - size < best))
            if not len(open_rows):
                continue
            for offset, seed, table in seeds:
                place = sizes[open_rows] - size + offset
                words = (sums[open_rows, place + seed] - sums[open_rows, place]) * inverse[place]
                for at, adapters in table.hits(words, at_once):
                    rows = open_rows[at]
                    keep_leftmost(rows, sizes[rows] - size, adapters, np.full(len(rows), size), self.allowed(size))
        return best


@lru_cache(maxsize=4)
def adapter_panel(adapters, error_rate, min_overlap):
    """The panel's tables, made once in a worker."""
    return AdapterPanel(adapters, error_rate, min_overlap)
