"""Hashes of word shingles, and the multiply-shift functions that permute them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from docflow.llm.common import TextBlock, gram_hashes, mix64, runs, span_hashes, text_blocks
from docflow.llm.winnow import _lower

PERMUTATIONS = 128
SHINGLE = 5
#: Functions drawn in all; signatures take the first PERMUTATIONS of them.
DRAWN = 160
_draw = np.random.default_rng(20240101)
_FACTORS = _draw.integers(1, 1 << 63, DRAWN, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TERMS = _draw.integers(0, 1 << 63, DRAWN, dtype=np.uint64)

_space = np.zeros(256, bool)
_space[[32, 9, 10, 11, 12, 13]] = True


def shingles(block: TextBlock) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of the block's rows in order, and how many each row has."""
    if not len(block.data):
        return np.zeros(0, np.uint64), np.zeros(block.rows, np.int64)
    data = _lower[block.data]
    starts, ends = runs(~_space[data], block.offsets)
    words = span_hashes(data, starts, ends)
    first = np.searchsorted(starts, block.offsets)
    counts = np.diff(first)
    n = np.maximum(counts - SHINGLE + 1, np.minimum(counts, 1))
    out = np.zeros(int(n.sum()), np.uint64)
    place = np.cumsum(n) - n
    rows = np.repeat(np.arange(block.rows), n)
    lead = first[:-1][rows] + np.arange(len(out)) - place[rows]
    full = counts[rows] >= SHINGLE
    out[full] = gram_hashes(words, SHINGLE)[lead[full]] if full.any() else 0
    for k in range(1, SHINGLE):
        short = np.flatnonzero(counts == k)
        if len(short):
            out[place[short]] = gram_hashes(words, k)[first[:-1][short]]
    return out, n


def distinct_shingles(block: TextBlock) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each row of the block, ascending, and how many each row has."""
    grams, n = shingles(block)
    rows = np.repeat(np.arange(block.rows), n)
    order = np.lexsort((grams, rows))
    grams, rows = grams[order], rows[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (rows[1:] != rows[:-1])
    return grams[new], np.bincount(rows[new], minlength=block.rows)


def set_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """For each text a hash of its shingle set, zero without words, and the set's size."""
    nodes, sizes = np.zeros(len(column), np.uint64), np.zeros(len(column), np.int64)
    for block in text_blocks(column):
        grams, n = distinct_shingles(block)
        sizes[block.lo : block.hi] = n
        full = np.flatnonzero(n)
        if len(full):
            nodes[block.lo + full] = mix64(np.add.reduceat(mix64(grams), (np.cumsum(n) - n)[full]))
    return nodes, sizes


def set_of(text: str) -> np.ndarray:
    """The distinct shingle hashes of one text, ascending."""
    found = [distinct_shingles(block)[0] for block in text_blocks(pa.array([text], pa.large_string()))]
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def reach(x: np.ndarray, y: np.ndarray, least: float) -> bool:
    """Whether two sets of shingles, each without repeats, reach a Jaccard similarity."""
    if min(len(x), len(y)) < least * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both >= least * (len(x) + len(y) - both)
