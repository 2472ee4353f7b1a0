"""Approximate nearest neighbours over learned partitions.

1. Fit, on at most SAMPLE distinct vectors (the first by digest): their neighbour graph
   is cut into parts of equal size by repeated bisection (a median cut, refined by
   swapping the vectors that gain most), and a small network learns to tell, from a
   vector, in which parts its neighbours lie.
2. Index: every vector goes to its most probable part.
3. Search: a query goes to its most probable parts, until they hold MASS of the
   probability (PROBES at least), and is compared exactly with all vectors in them.
   Queries that find fewer than ``k`` this way are compared with all parts.

Of equal vectors only the k + 1 smallest vec_ids can be in an answer; others are left out
before anything is compared, so a very common vector is no hot part. Parts are cut into
tiles of TILE vectors and QUERIES queries; each meeting is a group of its own, and gives
back its k best per query.

Rows: vectors that are null, empty, zero or hold null or non-finite components take no
part, as query or candidate. Vectors of another length than most are compared with all
of their length. A row is not its own neighbour, nor are rows with its vec_id. Repeated
rows count once. Ties go to the smaller vec_id. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from basketlens.llm.common import written
from basketlens.llm.near_vectors import as_numbers, is_usable

K = 10
SAMPLE = 8192
PARTS = 32
#: Vectors of the sample per part at least.
PART_SAMPLE = 48
GRAPH = 10
HIDDEN = 96
EPOCHS = 200
PROBES, MASS = 6, 0.98
TILE, QUERIES = 4096, 2048


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest others of each row."""
    squares, out = (x * x).sum(axis=1), []
    for s in range(0, len(x), 128):
        gap = squares[None, :] - 2 * (x[s : s + 128] @ x.T)
        gap[np.arange(len(gap)), np.arange(s, s + len(gap))] = np.inf
        out.append(np.argpartition(gap, k - 1, axis=1)[:, :k].copy())  # a view would keep the whole block
    return np.concatenate(out)


def bisect(x: np.ndarray, graph: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Which half of ``own`` each goes to (True: second); halves are equal, few edges are cut."""
    centred = x[own] - x[own].mean(axis=0)
    direction = np.linalg.svd(centred, full_matrices=False)[2][0]
    side = np.zeros(len(x), np.int64)
    order = np.argsort(centred @ direction, kind="stable")
    side[own[order[: len(own) // 2]]], side[own[order[len(own) // 2 :]]] = -1, 1
    for _ in range(20):
        pull = side[graph[own]].sum(axis=1).astype(float)
        np.add.at(back := np.zeros(len(x)), graph[own].ravel(), np.repeat(side[own], graph.shape[1]))
        gain = -(pull + back[own]) * side[own]  # positive: more edges to the other half
        a, b = own[side[own] < 0], own[side[own] > 0]
        ga, gb = gain[side[own] < 0], gain[side[own] > 0]
        a, ga = a[np.argsort(-ga, kind="stable")], np.sort(ga)[::-1]
        b, gb = b[np.argsort(-gb, kind="stable")], np.sort(gb)[::-1]
        n = min(len(a), len(b))
        swaps = int((ga[:n] + gb[:n] > 0).sum()) // 2  # half at a time: both ends of an edge may want to move
        if not swaps:
            break
        side[a[:swaps]], side[b[:swaps]] = 1, -1
    return side[own] > 0


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int) -> np.ndarray:
    """A part for each row: parts is a power of two, sizes differ by few."""
    groups = [np.arange(len(x))]
    while len(groups) < parts:
        halves = []
        for own in groups:
            second = bisect(x, graph, own)
            halves += [own[~second], own[second]]
        groups = halves
    out = np.empty(len(x), np.int64)
    for i, own in enumerate(groups):
        out[own] = i
    return out


class Router:
    """A network with one hidden layer: the probability of each part."""

    def __init__(self, mean, scale, w1, b1, w2, b2) -> None:
        self.mean, self.scale, self.w1, self.b1, self.w2, self.b2 = mean, scale, w1, b1, w2, b2
        self.dims, self.parts = len(mean), len(b2)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        h = np.maximum(((x - self.mean) / self.scale) @ self.w1 + self.b1, 0)
        z = h @ self.w2 + self.b2
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def fit(sample: np.ndarray) -> Router:
    """From sample vectors (distinct, of one length)."""
    n, dims = sample.shape
    parts = 1
    while parts < PARTS and n // (parts * 2) >= PART_SAMPLE:
        parts *= 2
    mean = sample.mean(axis=0)
    scale = max(float(np.sqrt(((sample - mean) ** 2).mean())), 1e-300)
    x = (sample - mean) / scale
    rng = np.random.default_rng(5)
    w1, w2 = rng.normal(size=(dims, HIDDEN)) / np.sqrt(dims), np.zeros((HIDDEN, parts))
    b1, b2 = np.zeros(HIDDEN), np.zeros(parts)
    if parts > 1:
        graph = neighbour_graph(x, min(GRAPH, n - 1))
        part = balanced_parts(x, graph, parts)
        target = np.zeros((n, parts))
        np.add.at(target, (np.repeat(np.arange(n), graph.shape[1]), part[graph].ravel()), 1.0 / graph.shape[1])
        target[np.arange(n), part] += 0.5
        target /= target.sum(axis=1, keepdims=True)
        values = [w1, b1, w2, b2]
        first, second, t = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values], 0
        for _ in range(EPOCHS):
            order = rng.permutation(n)
            for s in range(0, n, 1024):
                own = order[s : s + 1024]
                h = np.maximum(x[own] @ w1 + b1, 0)
                z = h @ w2 + b2
                e = np.exp(z - z.max(axis=1, keepdims=True))
                d = (e / e.sum(axis=1, keepdims=True) - target[own]) / len(own)
                dh = (d @ w2.T) * (h > 0)
                grads = [x[own].T @ dh + 1e-4 * w1, dh.sum(axis=0), h.T @ d + 1e-4 * w2, d.sum(axis=0)]
                t += 1
                for v, g, m, q in zip(values, grads, first, second):
                    m += 0.1 * (g - m)
                    q += 0.01 * (g * g - q)
                    v -= 0.01 * (m / (1 - 0.9**t)) / (np.sqrt(q / (1 - 0.99**t)) + 1e-8)
    return Router(mean, scale, w1, b1, w2, b2)


def _routed(router: Router | None, every: bool, several: bool):
    """vec_id, vector -> dims, part: the most probable part; ``several``: as many as a query asks; ``every``: all."""

    def run(batches):
        for batch in batches:
            rows = batch.column(1).to_pylist()
            take, part, dims = [], [], []
            same = [i for i, v in enumerate(rows) if router is not None and len(v) == router.dims]
            if same:
                p = router.probabilities(np.array([rows[i] for i in same], np.float64))
                order = np.argsort(-p, axis=1, kind="stable")
                if every:
                    n = np.full(len(same), router.parts)
                elif several:
                    mass = np.cumsum(np.take_along_axis(p, order, axis=1), axis=1)
                    n = np.clip((mass < MASS).sum(axis=1) + 1, min(PROBES, router.parts), router.parts)
                else:
                    n = np.ones(len(same), np.int64)
                for i, parts, m in zip(same, order.tolist(), n.tolist()):
                    take += [i] * m
                    part += parts[:m]
                    dims += [router.dims] * m
            known = set(same)
            for i, v in enumerate(rows):
                if i not in known:
                    take.append(i)
                    part.append(0)
                    dims.append(len(v))
            out = batch.take(pa.array(take, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*out.columns, pa.array(dims, pa.int32()), pa.array(part, pa.int32())], names=["vec_id", "vector", "dims", "part"]
            )

    return run


_FOUND = T.StructType(
    [T.StructField("query_id", T.LongType()), T.StructField("vec_id", T.LongType()), T.StructField("score", T.DoubleType())]
)


def _nearest(k: int):
    """The k nearest of a tile for each of its queries, by exact distance."""

    def run(index: pa.Table, queries: pa.Table) -> pa.Table:
        out = [], [], []
        if index.num_rows and queries.num_rows:
            dims = index.column("dims")[0].as_py()
            x, q = (t.column("vector").combine_chunks().flatten().to_numpy().astype(np.float64).reshape(-1, dims) for t in (index, queries))
            ids, own = index.column("vec_id").to_numpy(), queries.column("vec_id").to_numpy()
            squares = (x * x).sum(axis=1)
            for s in range(0, len(q), 256):
                some = q[s : s + 256]
                gap = squares[None, :] - 2 * (some @ x.T) + (some * some).sum(axis=1)[:, None]
                slack = 1e-9 * (squares.max() + (some * some).sum(axis=1))
                gap[ids[None, :] == own[s : s + 256][:, None]] = np.inf
                m = min(k, gap.shape[1])
                limit = np.partition(gap, m - 1, axis=1)[:, m - 1] + slack
                rows, cols = np.nonzero((gap <= limit[:, None]) & np.isfinite(gap))
                exact = np.sqrt(((some[rows] - x[cols]) ** 2).sum(axis=1))
                order = np.lexsort((ids[cols], exact, rows))
                rows, cols, exact = rows[order], cols[order], exact[order]
                rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
                keep = rank < k
                for o, v in zip(out, (own[s : s + 256][rows[keep]], ids[cols[keep]], exact[keep])):
                    o.append(v)
        columns = [np.concatenate(o) if o else np.zeros(0) for o in out]
        return pa.table([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.float64())], names=_FOUND.names)

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def _compare(index: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Meet index tiles (dims, part, tile of tiles) with the queries of their part, some at a time."""
    key = ["dims", "part"]
    many = queries.groupBy(*key).agg(F.ceil(F.count("*") / QUERIES).alias("chunks"))
    tiles = index.select(*key, "tile").distinct().join(many, key)
    left = index.join(tiles, [*key, "tile"]).withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    right = queries.join(many, key).withColumn("chunk", F.pmod(F.xxhash64("vec_id"), F.col("chunks"))).drop("chunks")
    right = right.join(tiles.select(*key, "tile"), key)
    place = [*key, "tile", "chunk"]
    # aliases keep the two sides apart, which come from the same tables
    left, right = (df.select(*[F.col(c).alias(c) for c in [*place, "vec_id", "vector"]]) for df in (left, right))
    return left.groupBy(*place).cogroup(right.groupBy(*place)).applyInArrow(_nearest(k), _FOUND)


def search(vectors: DataFrame, queries: DataFrame, k: int = K, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Per query and rank (from 1): query_id, rank, vec_id, score (Euclidean distance, double)."""

    def named(df):
        rows = df.select(F.col(key).cast("long").alias("vec_id"), as_numbers(df, vector).alias("vector"))
        return rows.where(F.col("vec_id").isNotNull() & is_usable("vector")).distinct()

    same = Window.partitionBy("vector").orderBy("vec_id")
    rows = written(named(vectors).withColumn("copy", F.row_number().over(same)).where(F.col("copy") <= k + 1).drop("copy"))
    asked = written(named(queries))
    length = rows.groupBy(F.size("vector").alias("dims")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dims").limit(1).collect()
    router = None
    if length:
        usual = rows.where(F.size("vector") == length[0]["dims"])
        sample = usual.groupBy("vector").agg(F.min("vec_id").alias("vec_id"))
        sample = sample.orderBy(F.md5(F.col("vec_id").cast("string")), "vec_id").limit(SAMPLE).select("vector")
        flat = sample.toArrow().column("vector").combine_chunks().flatten().to_numpy().astype(np.float64)
        flat = flat.reshape(-1, length[0]["dims"])
        router = fit(flat) if len(flat) else None
    kind = rows.schema["vector"].dataType
    schema = T.StructType(
        [T.StructField("vec_id", T.LongType()), T.StructField("vector", kind), T.StructField("dims", T.IntegerType()), T.StructField("part", T.IntegerType())]
    )
    index = written(rows.mapInArrow(_routed(router, False, False), schema))
    sizes = index.groupBy("dims", "part").agg(F.ceil(F.count("*") / TILE).alias("tiles"))
    index = written(index.join(sizes, ["dims", "part"]).withColumn("tile", F.pmod(F.xxhash64("vec_id"), F.col("tiles"))).drop("tiles"))
    first = written(_best(_compare(index, asked.mapInArrow(_routed(router, False, True), schema), k), k))
    full = first.groupBy("query_id").agg(F.count("*").alias("n")).where(F.col("n") >= k)
    short = asked.join(full, F.col("vec_id") == F.col("query_id"), "left_anti")
    rest = _best(_compare(index, short.mapInArrow(_routed(router, True, True), schema), k), k)
    out = first.join(full.select("query_id"), "query_id", "left_semi").unionByName(rest)
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
