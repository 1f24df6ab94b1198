"""Batch kernels against plain loops."""

import math
import random

import numpy as np

from biomesheaf.functions import kernels as kn


def _texts(n, alphabet, top, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, top))) for _ in range(n)]


def test_quality_cuts():
    quals = _texts(600, "#$%&'()*+,-./0123456789:;<=>?@ABI", 70, 1) + ["", "#", "I", "####"]

    def loop(qual, cutoff=10):
        total = best = drop = 0
        for seen, ch in enumerate(reversed(qual), 1):
            total += cutoff - (ord(ch) - 33)
            if total < 0:
                break
            if total > best:
                best, drop = total, seen
        return len(qual) - drop

    assert kn.quality_cuts(quals, 10).tolist() == [loop(q) for q in quals]


def test_adapter_cuts():
    adapters = ["ACGTACGTAA", "TTTTGGGGCCCCAAAA"]
    rng = random.Random(2)
    seqs = _texts(300, "ACGTN", 60, 3)
    seqs += [s[:20] + rng.choice(adapters)[: rng.randint(3, 16)] for s in seqs]

    def loop(seq):
        for start in range(len(seq) - 2):
            for adapter in adapters:
                size = min(len(adapter), len(seq) - start)
                wrong = sum(a != b for a, b in zip(seq[start : start + size], adapter))
                if size >= 3 and wrong <= math.floor(0.1 * size):
                    return start
        return len(seq)

    assert kn.adapter_cuts(seqs, adapters, 0.1, 3).tolist() == [loop(s) for s in seqs]
    kept = [max(len(s) - 5, 0) for s in seqs]
    both = kn.adapter_cuts(seqs, adapters, 0.1, 3, np.array(kept))
    assert both.tolist() == [loop(s[:n]) for s, n in zip(seqs, kept)]


def test_longest_overlaps():
    left = _texts(400, "ACGT", 50, 4)
    right = [a[-15:] + b for a, b in zip(left, _texts(400, "ACGT", 20, 5))]

    def loop(a, b):
        for size in range(min(len(a), len(b)), 11, -1):
            wrong = sum(x != y for x, y in zip(a[-size:], b[:size]))
            if wrong <= math.floor(0.05 * size):
                return size
        return 0

    assert kn.longest_overlaps(left, right, 0.05, 12).tolist() == [loop(a, b) for a, b in zip(left, right)]


def test_small_matrix_blocks(monkeypatch):
    seqs = _texts(50, "ACGT", 40, 6) + ["ACGT" * 100]
    whole = kn.adapter_cuts(seqs, ["ACGTAC"], 0.1, 3).tolist()
    monkeypatch.setattr(kn, "MATRIX_CELLS", 64)
    assert kn.adapter_cuts(seqs, ["ACGTAC"], 0.1, 3).tolist() == whole


def test_large_panels_are_found_by_seeds():
    rng = random.Random(8)
    adapters = ["".join(rng.choice("ACGT") for _ in range(rng.randint(4, 40))) for _ in range(120)]
    seqs = _texts(120, "ACGTN", 70, 9)
    for s in seqs[:60]:
        a = list(rng.choice(adapters))
        for i in rng.sample(range(len(a)), len(a) // 8):
            a[i] = rng.choice("ACGTN")
        seqs.append(s[:25] + "".join(a)[: rng.randint(3, 40)] + s[25 : rng.randint(25, 40)])

    def loop(seq, rate, least):
        for start in range(len(seq) - least + 1):
            for adapter in adapters:
                size = min(len(adapter), len(seq) - start)
                if size >= least and sum(a != b for a, b in zip(seq[start : start + size], adapter)) <= math.floor(rate * size):
                    return start
        return len(seq)

    for rate, least in ((0.1, 8), (0.2, 6), (0.0, 4)):
        assert kn.adapter_cuts(seqs, adapters, rate, least).tolist() == [loop(s, rate, least) for s in seqs]
