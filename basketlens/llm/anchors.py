"""Anchors: positions in sequences that equal passages choose alike.

Every window of ``length`` units has one anchor, the m-gram of least (scrambled) hash in
it, the leftmost of equal ones. The choice depends on the window's content alone, so
equal windows anywhere have equal anchors at the same offset; consecutive windows mostly
share theirs, so there are about 2 / (length - m + 2) runs of windows per unit.
"""

from __future__ import annotations

import numpy as np

from basketlens.llm.common import mix64

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        factors = np.full(max(n, 1 << 16), base, np.uint64)
        factors[0] = 1
        known = _powers[base] = np.multiply.accumulate(factors)
    return known[:n]


class Rolling:
    """Hashes of all runs of units of any length, from one running sum (polynomial, modulo 2 ** 64)."""

    def __init__(self, units: np.ndarray) -> None:
        n = len(units)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(units * _power(_BASE, n), out=self.sums[1:])

    def of_length(self, m: int) -> np.ndarray:
        """Of the m units from each place on, as long as there are as many."""
        n = len(self.sums) - 1
        if n < m:
            return np.zeros(0, np.uint64)
        return mix64((self.sums[m:] - self.sums[: n - m + 1]) * _power(_INVERSE, n - m + 1))

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Of the runs from each start up to its end."""
        return mix64((self.sums[ends] - self.sums[starts]) * _power(_INVERSE, len(self.sums))[starts])


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Least of each w consecutive values: running minima from both ends of blocks of w."""
    n = len(x) - w + 1
    padded = np.full(-(-len(x) // w) * w, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.ascontiguousarray(np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1]).ravel()
    return np.minimum(behind[:n], ahead[w - 1 : w - 1 + n])


def runs(units: np.ndarray, bounds: np.ndarray, length: int, m: int):
    """Runs of windows with one anchor, in a row of sequences (``bounds``: their starts, and the end of all).

    Returns, one entry per run: the place of the anchor, the first and the last window's
    start, the number of the sequence, and the anchor's hash; and the Rolling hashes.
    """
    rolling = Rolling(units)
    none = np.zeros(0, np.int64)
    if len(units) < length:
        return none, none, none, none, none.astype(np.uint64), rolling
    grams = rolling.of_length(m)
    order = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    at = (_sliding_min(order, length - m + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    # only windows inside one sequence
    inside = np.zeros(len(at) + 1, np.int32)
    starts, ends = bounds[:-1], bounds[1:]
    real = ends - starts >= length
    np.add.at(inside, starts[real], 1)
    np.add.at(inside, ends[real] - length + 1, -1)
    places = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
    at = at[places]
    if not len(at):
        return none, none, none, none, none.astype(np.uint64), rolling
    new = np.flatnonzero(np.append(True, (at[1:] != at[:-1]) | (places[1:] != places[:-1] + 1)))
    anchor, first = at[new], places[new]
    last = places[np.append(new[1:], len(places)) - 1]
    owner = np.searchsorted(bounds, first, side="right") - 1
    return anchor, first, last, owner, grams[anchor], rolling
