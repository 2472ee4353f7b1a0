"""Substring dedup: prefix-partitioned suffix trees over words.

Suffixes are split by prefixes of variable length: first by the anchor of their window
(a group of words that all its copies choose alike, which also decides the bucket that
sees them), then, where a group still holds more than GROUP suffixes, word by word, until
each part fits the sort table. Every part becomes a subtree. Its deep internal nodes (at
least ``length`` words) are the repeats; a node whose suffixes have different words to
their left is a maximal repeat. Marking the occurrences of maximal repeats against their
least doc_id marks exactly the windows that also stand in a document of smaller id.

Words are runs of other than white space, unchanged. Rows: as in suffix_array.py; null
and empty texts have no words. What is kept is joined by one space.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from basketlens.llm.repeats import Units, without_repeats
from basketlens.llm.suffix_array import occurrences

LENGTH = 50
GRAM = 10
#: Suffixes of a subtree that is built at once.
GROUP = 4096
#: Suffixes that are collected for a common sort.
BATCH = 1 << 15


def number_words(contents: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All words of the spans as numbers from 1, and the bounds of the spans."""
    rows = [c.split(b" ") for c in contents]
    known: dict[bytes, int] = {}
    flat = [known.setdefault(w, len(known) + 1) for row in rows for w in row]
    return np.array(flat, np.int64), np.append(0, np.cumsum([len(r) for r in rows])).astype(np.int64)


def partition(place: np.ndarray, size: np.ndarray, units: np.ndarray, length: int):
    """Split the suffixes of one anchor by prefixes until parts have at most GROUP.

    Yields ("part", indices) and, for prefixes of at least ``length`` words that branch on
    the way, ("node", indices, depth).
    """
    stack = [(np.arange(len(place)), 0)]
    while stack:
        own, depth = stack.pop()
        if len(own) <= GROUP:
            yield "part", own, depth
            continue
        ends = size[own] <= depth
        word = np.where(ends, 0, units[np.minimum(place[own] + depth, len(units) - 1)])
        order = np.argsort(word, kind="stable")
        own, word = own[order], word[order]
        cuts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        if depth >= length and (len(cuts) > 1 or word[0] == 0):
            yield "node", own, depth
        for a, b in zip(cuts, np.append(cuts[1:], len(own))):
            if word[a] != 0 and b - a > 1:
                stack.append((own[a:b], depth + 1))


def subtree_nodes(place: np.ndarray, size: np.ndarray, part: np.ndarray, units: np.ndarray, length: int):
    """Suffixes sorted by (part, words), and the deep internal nodes of all subtrees: (first, last, depth)."""
    width = int(size.max())
    padded = np.append(units, np.zeros(width, units.dtype))
    table = padded[place[:, None] + np.arange(width)]
    table[np.arange(width) >= size[:, None]] = 0
    order = np.lexsort((*table.T[::-1], part))
    table, size, part = table[order], size[order], part[order]
    differ = table[1:] != table[:-1]
    shared = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    shared = np.minimum(shared, np.minimum(size[1:], size[:-1]))
    shared[part[1:] != part[:-1]] = 0
    # insert the suffixes in order: the open path from the root is (first suffix, depth) of its nodes
    nodes, path, last = [], [], 0
    for i, depth in zip((np.flatnonzero(shared >= length) + 1).tolist(), shared[shared >= length].tolist()):
        if i != last + 1:
            nodes += [(first, last, deep) for first, deep in path]
            path = []
        first = i - 1
        while path and path[-1][1] > depth:
            first, deep = path.pop()
            nodes.append((first, i - 1, deep))
        if not path or path[-1][1] < depth:
            path.append((first, depth))
        last = i
    nodes += [(first, last, deep) for first, deep in path]
    return order, nodes


def solve(contents: list[bytes], group: np.ndarray, least: np.ndarray, length: int = LENGTH):
    """The parts of spans that recur, with the least doc_id of each repeat. Spans of a group are next to each other."""
    units, bounds = number_words(contents)
    sizes = np.diff(bounds)
    n = np.maximum(sizes - length + 1, 0)
    span = np.repeat(np.arange(len(n)), n)
    start = np.arange(len(span)) - np.repeat(np.cumsum(n) - n, n)
    place, size = bounds[span] + start, sizes[span] - start
    out = [(np.zeros(0, np.int64),) * 4]
    if not len(span):
        return out[0]
    anchor = group[span]
    cuts = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
    held, parts, count, number = [], [], 0, 0

    def build():
        own = np.concatenate(held)
        order, nodes = subtree_nodes(place[own], size[own], np.concatenate(parts), units, length)
        own = own[order]
        out.append(occurrences(nodes, span[own], start[own], place[own], units, least))

    for a, b in zip(cuts, np.append(cuts[1:], len(span))):
        for what, own, depth in partition(place[a:b], size[a:b], units, length):
            own = own + a
            if what == "node":
                out.append(occurrences([(0, len(own) - 1, depth)], span[own], start[own], place[own], units, least))
                continue
            held.append(own)
            parts.append(np.full(len(own), number))
            number, count = number + 1, count + len(own)
            if count >= BATCH:
                build()
                held, parts, count = [], [], 0
    if held:
        build()
    return tuple(np.concatenate(x) for x in zip(*out))


def deduplicate(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Without each word that a window of ``length`` words covers which also starts in a document of smaller id.

    Per row: doc_id, n_units (words), n_removed, n_spans (maximal removed runs), kept (UTF-8).
    """
    gram = max(1, min(GRAM, length // 2))

    def solver(contents, group, least):
        return solve(contents, group, least, length)

    return without_repeats(docs, Units("words", length, gram), solver)
