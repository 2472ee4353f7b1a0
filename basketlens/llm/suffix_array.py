"""Suffix-array dedup: maximal repeats from the common-prefix interval tree.

The suffixes of all spans of a bucket are sorted (an enhanced suffix array: order and
common-prefix lengths). A scan with a stack visits every interval of suffixes that share
at least ``length`` units; an interval whose suffixes have different units to their left
(or none) is a maximal repeat, and all its occurrences are given out, not just
neighbours. An interval without that diversity lies inside the repeat one unit to the
left. A window of ``length`` units that recurs is inside the maximal repeat with the same
occurrences, so marking maximal repeats against their least doc_id marks exactly the
windows that stand in a document of smaller id.

Rows: null and empty texts and texts shorter than the window stay as they are. Copies
and repeated rows of one doc_id are not compared with each other, but with all smaller
ids. A null doc_id counts as larger than any. An empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from basketlens.llm.repeats import Units, without_repeats

LENGTH = 50
GRAM = 24
#: Units in the sort table of suffixes at a time.
TABLE_UNITS = 1 << 23


def sort_suffixes(units: np.ndarray, bounds: np.ndarray, group: np.ndarray, length: int):
    """The suffixes of at least ``length`` units in order of (group, content, size), with common prefixes.

    ``units``: all spans in a row, uint32; ``bounds``: where each begins, and the end.
    Returns span, start, size and place in ``units`` of each suffix in order; and the common
    prefix of each with the one before (0 across groups and for the first).
    """
    sizes = np.diff(bounds)
    n = np.maximum(sizes - length + 1, 0)
    span = np.repeat(np.arange(len(n)), n)
    start = np.arange(len(span)) - np.repeat(np.cumsum(n) - n, n)
    place, size = bounds[span] + start, sizes[span] - start
    if not len(span):
        return span, start, size, place, np.zeros(0, np.int64)
    width = int(size.max())
    width += width % 2
    padded = np.append(units, np.zeros(width, np.uint32))
    table = padded[place[:, None] + np.arange(width)]
    table[np.arange(width) >= size[:, None]] = 0
    pairs = (table[:, ::2].astype(np.uint64) << np.uint64(32)) | table[:, 1::2]
    order = np.lexsort((size, *pairs.T[::-1], group[span]))
    span, start, size, place, table = span[order], start[order], size[order], place[order], table[order]
    differ = table[1:] != table[:-1]
    prefix = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    prefix = np.minimum(prefix, np.minimum(size[1:], size[:-1]))
    prefix[group[span[1:]] != group[span[:-1]]] = 0
    return span, start, size, place, np.append(0, prefix)


def intervals(prefix: np.ndarray, length: int) -> list[tuple[int, int, int]]:
    """(first, last, depth) of every interval of the tree with a depth of at least ``length``, by a stack scan."""
    out = []
    deep = prefix >= length
    for begin in np.flatnonzero(deep & ~np.append(False, deep[:-1])).tolist():
        stack: list[tuple[int, int]] = []
        i = begin
        while True:
            depth = int(prefix[i]) if i < len(prefix) and deep[i] else 0
            left = i - 1
            while stack and stack[-1][1] > depth:
                left, closed = stack.pop()
                out.append((left, i - 1, closed))
            if depth == 0:
                break
            if not stack or stack[-1][1] < depth:
                stack.append((left, depth))
            i += 1
    return out


def occurrences(nodes, span, start, place, units, least):
    """Of the nodes that are left-diverse: each occurrence as (span, start, end, least doc_id of the repeat)."""
    left = np.where(start > 0, units[place - 1].astype(np.int64), -1 - span)
    change = np.append(0, np.cumsum(left[1:] != left[:-1])) if len(left) else np.zeros(0, np.int64)
    none = np.zeros(0, np.int64)
    if not nodes:
        return none, none, none, none
    first, last, depth = np.array(nodes, np.int64).T
    diverse = (change[first] != change[last]) | (left[first] < 0)
    first, last, depth = first[diverse], last[diverse], depth[diverse]
    if not len(first):
        return none, none, none, none
    n = last - first + 1
    at = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    low = np.repeat(np.minimum.reduceat(least[span[at]], np.cumsum(n) - n), n)
    return span[at], start[at], start[at] + np.repeat(depth, n), low


def batches(bounds: np.ndarray, group: np.ndarray, length: int):
    """Runs of spans, whole groups each, of about TABLE_UNITS units in the sort table (or one group)."""
    sizes = np.diff(bounds)
    cost = np.maximum(sizes - length + 1, 0) * sizes
    cuts = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else np.zeros(0, np.int64)
    total = np.append(0, np.cumsum(cost))
    i = 0
    while i < len(cuts):
        j = i + 1
        while j < len(cuts) and total[cuts[j]] - total[cuts[i]] < TABLE_UNITS:
            j += 1
        yield cuts[i], (cuts[j] if j < len(cuts) else len(group))
        i = j


def solve(contents: list[bytes], group: np.ndarray, least: np.ndarray, length: int = LENGTH):
    """The parts of spans that recur, with the least doc_id of each repeat. Spans of a group are next to each other."""
    bounds = np.append(0, np.cumsum([len(c) for c in contents])).astype(np.int64)
    units = np.frombuffer(b"".join(contents), np.uint8).astype(np.uint32) + 1
    out = [(np.zeros(0, np.int64),) * 4]
    for a, b in batches(bounds, group, length):
        part = units[bounds[a] : bounds[b]]
        span, start, _, place, prefix = sort_suffixes(part, bounds[a : b + 1] - bounds[a], group[a:b], length)
        found = occurrences(intervals(prefix, length), span, start, place, part, least[a:b])
        out.append((found[0] + a, *found[1:]))
    return tuple(np.concatenate(x) for x in zip(*out))


def deduplicate(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Without each byte that a window of ``length`` bytes covers which also starts in a document of smaller id.

    Per row: doc_id, n_units (bytes), n_removed, n_spans (maximal removed runs), kept (bytes).
    """
    gram = max(1, min(GRAM, length // 2))

    def solver(contents, group, least):
        return solve(contents, group, least, length)

    return without_repeats(docs, Units("bytes", length, gram), solver)
