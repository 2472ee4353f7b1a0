"""Toxicity on held-out rows; Jaccard and vector joins against brute force; recall of the index."""

from __future__ import annotations

import random
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.llm import common, graph, jaccard, learned_index, near_vectors, toxicity
from basketlens.llm.common import words_of


def least_reachable(n, links):
    parent = list(range(n))

    def head(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = head(a), head(b)
        parent[max(a, b)] = min(a, b)
    return [head(i) for i in range(n)]


# -- toxicity ----------------------------------------------------------------------------


def toxic_rows():
    rng = random.Random(4)
    plain = ["w" + "".join(rng.choices("abcdef", k=4)) for _ in range(300)]
    rows, labels = [], []
    for i in range(900):
        words, bad = rng.choices(plain, k=rng.randint(0, 60)), rng.random() < 0.2
        if bad:
            words += rng.choices(["vile", "rotten", "filthy"], k=rng.randint(1, 3))
        if rng.random() < (0.6 if bad else 0.05):  # groups are named more often in toxic texts
            words.append(rng.choice(["women", "men", "girls", "boys"]))
        rng.shuffle(words)
        rows.append((i, " ".join(words), 0.5))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_toxicity_held_out_and_counterfactual(spark):
    rows, labels = toxic_rows()
    docs = spark.createDataFrame([*rows, (5000, None, 0.0), (5001, "", 0.0)], "doc_id long, text string, score double")
    marks = spark.createDataFrame([*labels, (3, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, marks)
    scored = toxicity.score(docs, model)
    assert scored.columns == ["doc_id", "text", "score"]
    got = {r.doc_id: r.score for r in scored.collect()}
    held = [(i, t) for i, _, t in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(got[i] >= 0.5) == bool(t) for i, t in held]) > 0.97
    assert got[5000] == got[5001] < 0.5
    assert all(0 <= s <= 1 for s in got.values())
    neutral = [model.score(f"{w} walk in the garden") for w in ["women", "men", "girls", "boys"]]
    assert max(neutral) < 0.5 and max(neutral) - min(neutral) < 0.05


def test_solver_takes_bags_as_an_arrow_array():
    bags, y, pairs = [[0, 1], [], [2], [0, 2], [1]], np.array([1.0, 0.0, 0.0, 1.0, 0.0]), np.zeros((0, 2), np.int64)
    listed = toxicity.solve(bags, y, 3, pairs)
    packed = toxicity.solve(pa.array([[9], *bags], pa.list_(pa.int32())).slice(1), y, 3, pairs)
    assert (listed[0] == packed[0]).all() and listed[1] == packed[1]


def test_swapping_names_moves_scores_less_with_the_penalty(monkeypatch):
    rng = np.random.default_rng(1)
    bags = [[0] * int(rng.random() < 0.3) + [1 + int(rng.random() < 0.5)] + [int(rng.integers(3, 9))] for _ in range(400)]
    y = np.array([float(1 in b and rng.random() < 0.5 or 0 in b) for b in bags])
    pairs = np.array([(w, 3 - w) for b in bags for w in b if w in (1, 2)])
    gaps = []
    for weight in (0.0, 5.0):
        monkeypatch.setattr(toxicity, "COUNTERFACTUAL", weight)
        w, _ = toxicity.solve(bags, y, 9, pairs)
        gaps.append(abs(w[1] - w[2]))
    assert gaps[1] < 0.3 * gaps[0]


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.score(docs, toxicity.fit(docs, marks)).first().score < 0.5
    assert toxicity.score(docs.limit(0), toxicity.fit(docs, marks)).count() == 0


# -- n-gram Jaccard ----------------------------------------------------------------------


def near_rows(seed=6, docs=160):
    rng = random.Random(seed)
    vocab = ["".join(rng.choices("abcde", k=3)) for _ in range(120)]
    passage = rng.choices(vocab, k=60)
    base = [rng.choices(vocab, k=rng.randint(1, 120)) for _ in range(25)]
    rows = [(None, None), (1, ""), (2, " \n"), (3, "a b c"), (4, "A b  C"), (5, "a b d"), (6, "one"), (7, "É e é f g"), (8, "é e é f g")]
    for i in range(10, docs):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            words[rng.randrange(len(words))] = rng.choice(vocab)
        if rng.random() < 0.2:
            words += passage
        rows.append((i, " ".join(w.upper() if rng.random() < 0.1 else w for w in words)))
    hub = rng.choices(vocab, k=100)
    for i in range(200, 260):  # near copies of one text, and chains of them
        words = list(hub)
        for j in range(rng.randint(0, 3)):
            words[rng.randrange(100)] = f"x{i}{j}"
        rows.append((i, " ".join(words)))
    rows += [(300, rows[30][1]), (31, rows[40][1]), (None, rows[50][1])]
    rng.shuffle(rows)
    return rows


def shingles(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = words_of(lower)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


@pytest.mark.parametrize("block", [4096, 6])
def test_jaccard_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rows = near_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit("clash"))
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs).collect()), key=str)
    sets = [shingles(t) for _, t in rows]
    n = len(rows)
    links = [(i, j) for i in range(n) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    heads, least = least_reachable(n, links), {}
    for (doc, _), h in zip(rows, heads):
        if doc is not None:
            least[h] = min(least.get(h, doc), doc)
    assert got == sorted(((d, len(s), least.get(h)) for (d, _), s, h in zip(rows, sets, heads)), key=str)
    assert len(links) > 500


def test_jaccard_links_short_texts_and_their_extensions(spark):
    rng, rows = random.Random(9), []
    for i in range(120):  # 3 shingles in 4: exactly 75 %, each pair for itself
        words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(8)]
        rows += [(2 * i, " ".join(words[:7] if i % 2 else words[1:])), (2 * i + 1, " ".join(words))]
    got = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == [(i, 3 + i % 2, i - i % 2) for i in range(240)]


def test_least_common_elements_of_halves():
    rng = np.random.default_rng(5)
    for n in range(1, 40):
        for m in range(n, 100 * n // 75 + 1):
            s = -(-75 * (n + m) // 175)
            for _ in range(5):
                every = rng.permutation(n + m - s)
                a, b = np.sort(every[:n]), np.sort(every[n - s :])
                both = len(np.intersect1d(a[: jaccard.half(n)], b[: jaccard.half(m)]))
                assert both >= max(jaccard.enough(n, 75), jaccard.enough(m, 75))


def test_jaccard_groups_of_a_large_component_are_bounded(spark, monkeypatch):
    rng, most, plain = random.Random(3), 3 * 64, jaccard._block_links
    passage = [f"p{i}" for i in range(40)]  # in every text, which does not link them
    rows = [(i, " ".join([*passage, *("".join(rng.choices("abcdefgh", k=6)) for _ in range(rng.randint(20, 30)))])) for i in range(500)]
    rows += [(1000 + i, f"{rows[i][1]} more") for i in range(0, 500, 5)]

    def bounded(percent):
        inner = plain(percent)

        def run(table):
            if table.column("place")[0].as_py().startswith("s") or table.num_rows <= most:
                return inner(table)
            raise ValueError(f"{table.num_rows} sets in a group")

        return run

    monkeypatch.setattr(jaccard, "BLOCK", 64)
    monkeypatch.setattr(jaccard, "_block_links", bounded)
    got = {r.doc_id: r.component_id for r in jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: i % 1000 for i, _ in rows}


def test_tree_links_connect_what_all_links_connect():
    rng = np.random.default_rng(2)
    sets = []
    for _ in range(40):
        base = rng.integers(0, 2**63, rng.integers(1, 80)).astype(np.uint64)
        for _ in range(rng.integers(1, 12)):
            keep = base[rng.random(len(base)) < 0.93]
            sets.append(np.unique(np.append(keep, rng.integers(0, 2**63, rng.integers(0, 5)).astype(np.uint64))))
    sets = [s for s in sets if len(s)]
    n = len(sets)
    every = [(i, j) for i in range(n) for j in range(i) if jaccard.linked(sets[i], sets[j], 75)]
    found = jaccard.spanning_links(sets, np.arange(n), 75)
    assert set(map(frozenset, found)) <= set(map(frozenset, every))
    assert least_reachable(n, found) == least_reachable(n, every)
    assert len(found) < n


def test_components(spark):
    chain = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (103, 101), (7, 7)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 100: 100, 101: 100, 103: 100}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- vectors -----------------------------------------------------------------------------


def vector_rows():
    rng = np.random.default_rng(8)
    rows, i = [], 0
    for label in (0, 1, 2):
        for _ in range(12):
            centre = rng.normal(size=20)
            for _ in range(rng.integers(1, 9)):
                rows.append((i, [float(np.float32(c)) for c in centre + rng.normal(size=20) * rng.choice([0.1, 0.25, 0.4])], label))
                i += 1
    rows += [(1000 + j, rows[3][1], 0) for j in range(30)]  # copies
    rows += [(2000, None, 0), (2001, [0.0] * 20, 0), (2002, [float("nan")] * 20, 0), (2003, [None] * 20, 0), (2004, rows[3][1], None)]
    rows += [(2005, [], 0), (2006, [1.0, 2.0], 0), (2007, [2.0, 4.0], 0), (2008, [float("inf")] + [1.0] * 19, 0), (2009, [x * 3 for x in rows[3][1]], 0)]
    return rows


@pytest.mark.parametrize("kind", ["float", "double"])
@pytest.mark.parametrize("tile", [1024, 5])
def test_vector_join_equals_brute_force(spark, monkeypatch, tile, kind):
    monkeypatch.setattr(near_vectors, "TILE", tile)
    rows = vector_rows()
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int").withColumn("node", F.lit("clash"))
    got = sorted(map(tuple, near_vectors.near_duplicates(df).collect()))
    good = [v is not None and label is not None and len(v) > 0 and None not in v and np.isfinite(v).all() and np.any(v) for _, v, label in rows]

    def linked(i, j):
        (_, x, a), (_, y, b) = rows[i], rows[j]
        if not (good[i] and good[j] and a == b and len(x) == len(y)):
            return False
        x, y = (np.array(v, np.float32 if kind == "float" else float).astype(float) for v in (x, y))
        return x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= 0.93

    n = len(rows)
    links = [(i, j) for i in range(n) for j in range(i) if linked(i, j)]
    degree = [0] * n
    for i, j in links:
        degree[i] += 1
        degree[j] += 1
    heads, least = least_reachable(n, links), {}
    for (key, _, _), h in zip(rows, heads):
        least[h] = min(least.get(h, key), key)
    assert got == sorted((key, d, least[h], key == least[h]) for (key, _, _), d, h in zip(rows, degree, heads))


def grouped_vectors():
    """Vectors of 64 numbers: near copies of a few and unrelated ones, copies, one of them without vec_id."""
    rng = np.random.default_rng(21)
    rows = []
    for label in "ab":
        centres = rng.normal(size=(5, 64))
        for i in range(300):
            v = centres[i % 5] + rng.normal(size=64) * rng.choice([0.05, 0.27, 0.29, 0.4]) if i < 200 else rng.normal(size=64)
            rows.append((len(rows), [float(np.float32(c)) for c in v], label))
    rows += [(1000 + j, rows[j % 2 * 250][1], "a") for j in range(40)] + [(None, rows[250][1], "a"), (7, rows[7][1], "a")]
    return rows + [(2000 + j, rows[j][1], "c") for j in range(3)]


@pytest.mark.parametrize("crowd", [1000, 8])
@pytest.mark.parametrize("tile", [8192, 40])
def test_tiles_find_all_links(spark, monkeypatch, tile, crowd):
    monkeypatch.setattr(near_vectors, "TILE", tile)
    monkeypatch.setattr(near_vectors, "CROWD", crowd)
    monkeypatch.setattr(near_vectors, "FOLDERS", 3)
    assert near_vectors.filter_dims(64, 0.93) == 22
    rows = grouped_vectors()
    x, labels = np.array([v for _, v, _ in rows]), np.array([c for _, _, c in rows])
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    near = (x @ x.T >= 0.93) & (labels[:, None] == labels)
    np.fill_diagonal(near, False)
    heads, least = least_reachable(len(rows), [*zip(*np.nonzero(near))]), {}
    for (key, _, _), h in zip(rows, heads):
        least[h] = min(least.get(h, 10**6), 10**6 if key is None else key)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label string")
    got = sorted(map(tuple, near_vectors.near_duplicates(df).collect()), key=str)
    want = [(key, int(d), least[h], None if key is None else key == least[h]) for (key, _, _), d, h in zip(rows, near.sum(axis=1), heads)]
    assert got == sorted(want, key=str)


def test_vector_join_stores_vectors_once_and_no_links(spark, monkeypatch):
    monkeypatch.setattr(near_vectors, "TILE", 1024)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(6000, 64))
    x[:2000] = x[0] + 0.1 * rng.normal(size=(2000, 64))
    ids = rng.permutation(6000)
    df = spark.createDataFrame([(int(i), list(map(float, x[i])), 1) for i in ids], "vec_id long, embedding array<float>, label int")
    folder = common.shared_folder(spark).removeprefix("file:")
    size = lambda: sum(p.stat().st_size for p in Path(folder).rglob("*.parquet"))
    before = size()
    got = near_vectors.near_duplicates(df)
    assert size() - before < 2 * x.size * 4
    got = {r.vec_id: (r.n_links, r.component_id) for r in got.collect()}
    assert got == {i: (1999, 0) if i < 2000 else (0, i) for i in range(6000)}


def test_equal_vectors_have_equal_signs():
    x = np.random.default_rng(5).normal(size=(100, 64))
    one_by_one = np.concatenate([near_vectors._signs(x[i : i + 1]) for i in range(100)])
    assert (near_vectors._signs(x) == one_by_one).all() and (near_vectors._signs(x[::-1])[::-1] == one_by_one).all()
    assert len(set(one_by_one.tolist())) > 50


def test_index_recall_and_exact_distances(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 16))
    rows = [(i, [float(np.float32(c)) for c in centres[i % 12] + 0.5 * rng.normal(size=16)]) for i in range(2400)]
    rows += [(5000 + j, rows[100][1]) for j in range(300)] + [(9000, None), (9100, [0.0] * 16), (9200, [float("nan")] * 16), (9300, [1.0, 2.0]), (9400, [1.0, 2.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("part", F.lit("clash"))
    found = {}
    for r in learned_index.search(df, df.where("vec_id % 100 = 0")).collect():
        found.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    usable = [(i, v) for i, v in rows if v and len(v) == 16 and np.isfinite(v).all() and np.any(v)]
    ids, x = np.array([i for i, _ in usable]), np.array([v for _, v in usable], np.float32).astype(float)
    hits = total = 0
    for q, v in usable:
        if q % 100:
            continue
        d = np.sqrt(((x - x[ids == q]) ** 2).sum(axis=1))
        order = [k for k in np.lexsort((ids, d)) if ids[k] != q][:10]
        got = [found[q][k + 1] for k in range(10)]
        assert [s for _, s in got] == sorted(s for _, s in got)
        assert all(s == d[ids == i][0] for i, s in got)
        hits += len({i for i, _ in got} & {int(ids[k]) for k in order})
        total += 10
    assert hits / total >= 0.9
    assert found[9300] == {1: (9400, 0.5)} and found[9400] == {1: (9300, 0.5)}
    assert not {9000, 9100, 9200} & set(found)


def test_index_of_few_or_no_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 1.0]), (1, [1.0, 2.0]), (100, [1.0, 1.0])], "vec_id long, embedding array<double>")
    got = [tuple(r) for r in learned_index.search(df, df.where("vec_id % 100 = 0")).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 100, 0.0), (0, 2, 1, 1.0), (100, 1, 0, 0.0), (100, 2, 1, 1.0)]
    assert learned_index.search(df.limit(0), df.limit(0)).count() == 0


def test_balanced_parts():
    x = np.random.default_rng(1).normal(size=(640, 8))
    parts = learned_index.balanced_parts(x, learned_index.neighbour_graph(x, 6), 8)
    assert np.bincount(parts).tolist() == [80] * 8


def test_jaccard_refuses_shares_that_the_filter_cannot_bound(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    for percent in (50, 101):
        with pytest.raises(ValueError, match="percent"):
            jaccard.near_duplicates(docs, percent)


def test_toxicity_sample_has_one_row_per_document(spark):
    docs = spark.createDataFrame([(i % 40, f"text {i}") for i in range(4000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i % 40, 0, i % 2) for i in range(80)], "doc_id long, quality int, toxic int")
    rows = toxicity.labelled(docs, labels).collect()
    assert len(rows) == len({r["doc_id"] for r in rows}) <= 40
    assert sorted(map(tuple, rows)) == sorted(map(tuple, toxicity.labelled(docs.repartition(7), labels).collect()))


def test_a_column_that_is_kept_goes_to_the_worker_once(spark):
    df = spark.createDataFrame([(1, "a b", 2), (2, None, 3)], "doc_id long, text string, n int")
    fields = [("size", T.LongType())]
    kept = common.append_columns(df, ["text"], fields, lambda texts: [[len(t or "") for t in texts]], chunk=1)
    assert "__read" not in kept._jdf.queryExecution().analyzed().toString()
    assert sorted(map(tuple, kept.collect())) == [(1, "a b", 2, 3), (2, None, 3, 0)]
    replaced = common.append_columns(df, ["n", "text"], [("text", T.StringType())], lambda n, texts: [[f"{t}{i}" for i, t in zip(n, texts)]])
    assert sorted(map(tuple, replaced.collect())) == [(1, 2, "a b2"), (2, 3, "None3")]


def test_the_training_rows_of_toxicity_lie_in_few_files(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"{'vile' if i % 2 else 'kind'} word {i}") for i in range(120)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "CAST(doc_id % 2 AS INT) AS toxic")
    cuts, written = [], toxicity.written
    monkeypatch.setattr(toxicity, "written", lambda df: cuts.append(df.rdd.getNumPartitions()) or written(df))
    settings = {"spark.sql.shuffle.partitions": "23", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        model = toxicity.fit(docs, labels)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert cuts and max(cuts) <= toxicity.TRAIN_TASKS
    assert model.score("vile word") > 0.5 > model.score("kind word")
