"""Batch comparisons of bases that Spark has no expression for (Hamming distance at an offset).

Spark partitions the reads; each Arrow batch is compared as a byte matrix.
"""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .adapters import adapter_panel

# Cells of one byte matrix; longer batches are cut so that a few very long reads stay cheap.
MATRIX_CELLS = 1 << 24


def _blocks(lengths, cells=None):
    """Row index blocks of similar length, each within MATRIX_CELLS (or ``cells``)."""
    cells = cells or MATRIX_CELLS
    order = np.argsort(lengths, kind="stable")
    end = len(order)
    while end > 0:
        width = max(int(lengths[order[end - 1]]), 1)
        start = max(0, end - max(1, cells // width))
        yield order[start:end]
        end = start


def _matrix(texts, width, right=False):
    rows = [t.rjust(width, "\0") for t in texts] if right else list(texts)
    return np.array(rows, dtype=f"S{width}").view(np.uint8).reshape(len(rows), width)


def _texts(series):
    texts = np.array(["" if t is None else t for t in series], dtype=object)
    return texts, np.array([len(t) for t in texts], dtype=np.int64)


def quality_cuts(quals, cutoff, offset=33):
    """Bases kept by the running-sum rule from the 3' end.

    Walking from the last base, ``cutoff - q`` is added up; the walk ends when the sum turns
    negative and the read is cut where the sum was largest.
    """
    texts, lengths = _texts(quals)
    kept = lengths.copy()
    for rows in _blocks(lengths):
        width = int(lengths[rows].max()) if len(rows) else 0
        if width == 0:
            continue
        # The 3' end first; padding ends the walk of a shorter read.
        codes = _matrix(texts[rows], width, right=True)[:, ::-1].astype(np.int64)
        gain = np.where(codes == 0, -(1 << 40), cutoff + offset - codes)
        total = np.cumsum(gain, axis=1)
        walked = np.cumsum(total < 0, axis=1) == 0
        reached = np.where(walked, total, 0)
        best = reached.argmax(axis=1)
        top = np.take_along_axis(reached, best[:, None], axis=1)[:, 0]
        kept[rows] = lengths[rows] - np.where(top > 0, best + 1, 0)
    return kept


def adapter_cuts(seqs, adapters, error_rate, min_overlap, lengths=None):
    """Leftmost start of an adapter (whole or running off the end) in each sequence.

    ``lengths`` are the bases to look at (all by default); they stand for "none found".
    """
    texts, full = _texts(seqs)
    lengths = full if lengths is None else np.minimum(lengths, full)
    cuts = lengths.copy()
    panel = adapter_panel(tuple(adapters), error_rate, min_overlap)
    # A cell costs nine bytes more here, for the running words.
    for rows in _blocks(lengths, MATRIX_CELLS // 8):
        size = lengths[rows]
        width = int(size.max()) if len(rows) else 0
        if width < min_overlap:
            continue
        cells = np.zeros((len(rows), width + panel.longest), dtype=np.uint8)
        cells[:, :width] = _matrix([t[:n] for t, n in zip(texts[rows], size)], width)
        cuts[rows] = panel.cuts(cells, size)
    return cuts


def quality_cut_udf(cutoff):
    @F.pandas_udf(T.IntegerType())
    def cut(qual: pd.Series) -> pd.Series:
        return pd.Series(quality_cuts(qual, cutoff), dtype="int32")

    return cut


def adapter_cut_udf(adapters, error_rate, min_overlap):
    adapters = list(adapters)

    @F.pandas_udf(T.IntegerType())
    def cut(seq: pd.Series) -> pd.Series:
        return pd.Series(adapter_cuts(seq, adapters, error_rate, min_overlap), dtype="int32")

    return cut


def quality_adapter_cut_udf(cutoff, adapters, error_rate, min_overlap):
    """Both cuts in one pass: the adapters are looked for in what the quality cut leaves."""
    adapters = list(adapters)

    @F.pandas_udf(T.IntegerType())
    def cut(seq: pd.Series, qual: pd.Series) -> pd.Series:
        kept = quality_cuts(qual, cutoff)
        return pd.Series(adapter_cuts(seq, adapters, error_rate, min_overlap, kept), dtype="int32")

    return cut


def longest_overlaps(left, right, error_rate, min_overlap):
    """Longest suffix of ``left`` that matches a prefix of ``right``; 0 when there is none."""
    (lefts, left_sizes), (rights, right_sizes) = _texts(left), _texts(right)
    limit = np.minimum(left_sizes, right_sizes)
    found = np.zeros(len(limit), dtype=np.int64)
    for rows in _blocks(limit):
        width = int(limit[rows].max()) if len(rows) else 0
        if width < min_overlap:
            continue
        tails = _matrix([t[-width:] for t in lefts[rows]], width, right=True)
        heads = _matrix([t[:width] for t in rights[rows]], width)
        best = np.zeros(len(rows), dtype=np.int64)
        for overlap in range(width, min_overlap - 1, -1):
            open_rows = np.flatnonzero((best == 0) & (limit[rows] >= overlap))
            if not len(open_rows):
                continue
            differing = (tails[open_rows, width - overlap :] != heads[open_rows, :overlap]).sum(axis=1)
            best[open_rows[differing <= np.floor(error_rate * overlap)]] = overlap
        found[rows] = best
    return found


def longest_overlap_udf(error_rate, min_overlap):
    @F.pandas_udf(T.IntegerType())
    def overlap(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series(longest_overlaps(left, right, error_rate, min_overlap), dtype="int32")

    return overlap
