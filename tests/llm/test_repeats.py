"""Substring and suffix-array dedup against their definition, window by window."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketlens.llm import suffix_array, suffix_tree
from basketlens.llm.common import word_bytes

TOP = float("inf")


def removed_by_definition(rows, split, length):
    """Per row: flags of units, windows judged on the input."""
    least = {}
    units = [split(text) for _, text in rows]
    for (doc, _), u in zip(rows, units):
        for i in range(len(u) - length + 1):
            w = tuple(u[i : i + length])
            least[w] = min(least.get(w, TOP), TOP if doc is None else doc)
    out = []
    for (doc, _), u in zip(rows, units):
        gone = [False] * len(u)
        for i in range(len(u) - length + 1):
            if least[tuple(u[i : i + length])] < (TOP if doc is None else doc):
                gone[i : i + length] = [True] * length
        out.append((u, gone))
    return out


def corpus(seed=3):
    rng = random.Random(seed)
    vocab = ["".join(rng.choices("abcdeé漢", k=rng.randint(1, 6))) for _ in range(40)]
    passage = [rng.choices(vocab, k=rng.randint(45, 70)) for _ in range(6)]
    rows = [(None, None), (1, ""), (2, " \n\t "), (3, "a" * 400), (4, "a" * 130), (9, "ab " * 300), (8, "ab " * 80)]
    for doc in range(10, 90):
        words = []
        for _ in range(rng.randint(0, 4)):
            words += rng.choices(vocab, k=rng.randint(0, 60))
            p = rng.choice(passage)
            words += p[rng.randint(0, 10) :] if rng.random() < 0.5 else p
        rows.append((doc, rng.choice([" ", "  ", "\n"]).join(words)))
    rows += [(100 + i, rows[20][1]) for i in range(5)]  # copies
    rows += [rows[30], rows[30], (None, rows[31][1]), (200, rows[40][1][:200] + "\x00\x1f " + rows[40][1])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("length", [50, 12])
@pytest.mark.parametrize("kind", ["words", "bytes"])
def test_equals_definition(spark, kind, length):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("grp", F.lit("clash")).withColumn("kept", F.lit(1))
    if kind == "words":
        got, split, glue = suffix_tree.deduplicate(docs, length), word_bytes, b" "
    else:
        got, split, glue = suffix_array.deduplicate(docs, length), lambda t: [bytes([b]) for b in (t or "").encode()], b""
    expected = []
    for (doc, _), (units, gone) in zip(rows, removed_by_definition(rows, split, length)):
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = glue.join(u for u, g in zip(units, gone) if not g)
        expected.append((doc, len(units), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    found = [(r.doc_id, r.n_units, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in got.collect()]
    order = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(found, key=order) == sorted(expected, key=order)
    assert sum(r[2] for r in expected) > 500


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_tree.deduplicate(docs).count() == 0
    assert suffix_array.deduplicate(docs).count() == 0


def test_long_document_in_pieces(spark, monkeypatch):
    from basketlens.llm import repeats

    monkeypatch.setattr(repeats, "PIECE", 64)
    units = repeats.Units("bytes", 12, 6)
    rng = random.Random(1)
    texts = ["".join(rng.choices("ab", k=300)), "", "".join(rng.choices("ab", k=5)), "".join(rng.choices("ab", k=200))]
    code, key, first, last = units.sequences(texts).runs()
    windows = sorted(w for a, b in zip(first, last) for w in range(a, b + 1))
    bounds = np.cumsum([0, *map(len, texts)])
    assert windows == [w for i, t in enumerate(texts) for w in range(bounds[i], bounds[i] + max(0, len(t) - 11))]


def test_big_groups_are_partitioned(monkeypatch):
    """Prefix partitioning below the sort table gives the same marks."""
    rng = random.Random(5)
    base = [rng.choice("xyz") for _ in range(30)]
    contents, least = [], []
    for i in range(60):
        words = list(base)
        words[rng.randrange(30)] = "q"
        contents.append(" ".join(words[rng.randrange(5) :]).encode())
        least.append(i)
    args = contents, np.zeros(60, np.int64), np.array(least), 8

    def marks(out):
        flags = set()
        for span, start, end, low in zip(*(x.tolist() for x in out)):
            if least[span] > low:
                flags |= {(span, p) for p in range(start, end)}
        return flags

    whole = marks(suffix_tree.solve(*args))
    monkeypatch.setattr(suffix_tree, "GROUP", 3)
    assert marks(suffix_tree.solve(*args)) == whole
    assert len(whole) > 100
