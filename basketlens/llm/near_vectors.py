"""Embedding near-dedup: exact pairs within labels, from tiles that are compared where they lie.

The cosine of two vectors is the product of their unit vectors: that in some dimensions after
a random rotation, and in the others at most the product of the lengths there. This bound
takes few dimensions (single precision, with a margin for rounding). Pairs that may reach
``least`` by it are compared in all dimensions, and those near the limit on the original
vectors in double precision.

Equal vectors of a label are one node with a count, so copies cost nothing. The vectors are
exchanged once, to tiles of about TILE nodes of one label (by the signs of a few rotated
dimensions, so that near vectors tend to share a tile). Links inside a tile are found when it
is packed; smaller labels share a tile and are then done. The tiles of a larger label meet
in a Cartesian product, which reads the written tiles anew for each pair of partitions:
no vector is sent or stored again for it.

Links are not listed, as a group of n near copies has n * n / 2 of them. A tile counts the
partners of its nodes and joins linked nodes to one local root; pairs of tiles add counts and
edges between local roots, of which the components are made.

Rows: a null label, and vectors that are null, empty, zero or hold null or non-finite
components, link with nothing. Vectors of different length do not link. Repeated rows
(same vec_id) count as vectors of their own. Empty tables give empty results; other
columns are ignored. Long vectors make tiles of fewer nodes (TILE_BYTES).
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from basketlens.llm.common import shared_path, written
from basketlens.llm.graph import components

LEAST = 0.93
#: Nodes of a tile, and their bytes in double precision.
TILE = 4096
TILE_BYTES = 2 << 20
#: Of a vector with so many rows, one row goes to its tile.
CROWD = 1000
#: Rotated dimensions whose signs order the nodes of a label.
SIGNS = 12
#: Rows of a tile that are compared with so many columns of the other at a time.
STRIP, WIDTH = 256, 2048
#: Tiles that a task keeps prepared.
READY = 24
#: Labels are dealt into so many folders of tiles, and neighbouring tiles written together.
FOLDERS, TOGETHER = 32, 4
#: Edges that a task holds back.
HELD = 1 << 18
#: Bytes sent to a worker at a time where rows are tiles.
BATCH = "16m"


@functools.lru_cache(maxsize=8)
def subspace(dims: int, kept: int) -> np.ndarray:
    """Fixed random orthonormal directions, as columns."""
    return np.linalg.qr(np.random.default_rng(17).normal(size=(dims, kept)))[0]


def filter_dims(dims: int, least: float) -> int:
    """Dimensions of the first comparison; 0: all at once. Of unrelated vectors about one pair in 100,000 passes as many."""
    kept = int(np.ceil((2 - 2 * least) * dims)) + 13
    return kept if kept <= dims // 2 else 0


def tile_rows(dims: int, tile: int, tile_bytes: int) -> int:
    return max(1, min(tile, tile_bytes // (8 * dims)))


def as_numbers(vectors: DataFrame, vector: str) -> F.Column:
    """The vector as array<double>, or array<float> if it is one (half as much to send)."""
    kind = vectors.schema[vector].dataType
    narrow = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    return F.col(vector).cast("array<float>" if narrow else "array<double>")


def is_usable(vector: str) -> F.Column:
    """Whether a vector (array<double>) can take part."""
    v = F.col(vector)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(v, lambda x: x != 0), F.lit(False))


def _unit(v: np.ndarray) -> np.ndarray:
    """Scaled by the largest component first, so that squares neither overflow nor vanish."""
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _vectors(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Where each row's numbers begin and end, and all numbers."""
    return column.offsets.to_numpy(), column.values


def _usable(column: pa.Array) -> np.ndarray:
    """As is_usable, by row."""
    at, values = _vectors(column)
    flat = values.to_numpy(zero_copy_only=False)
    odd = ~np.isfinite(flat)
    if values.null_count:
        odd |= values.is_null().to_numpy(zero_copy_only=False)
    counts = [np.diff(np.append(0, np.cumsum(x))[at]) for x in (odd, flat != 0)]
    return column.is_valid().to_numpy(zero_copy_only=False) & (counts[0] == 0) & (counts[1] > 0)


def _signs(vectors: np.ndarray) -> np.ndarray:
    """The signs of the first rotated dimensions as bits. Equal vectors get equal bits in any batch, as a matrix product does not ensure."""
    kept = min(vectors.shape[1], SIGNS)
    vectors = np.ascontiguousarray((vectors / np.abs(vectors).max(axis=1, keepdims=True)).T)
    turned = np.zeros((kept, vectors.shape[1]))
    for j, weights in enumerate(subspace(len(vectors), kept)):
        turned += weights[:, None] * vectors[j]
    return (1 << np.arange(SIGNS - 1, SIGNS - 1 - kept, -1)) @ (turned > 0)


def _with_cells(batches):
    """Rows (vec_id, label, vector) with vectors that cannot take part as null, their lengths and signs."""
    for batch in batches:
        named, label, column = batch.columns
        usable = _usable(column) & label.is_valid().to_numpy(zero_copy_only=False)
        at, values = _vectors(column)
        flat = values.to_numpy(zero_copy_only=False)
        size = np.where(usable, np.diff(at), 0)
        cell = np.zeros(len(size), np.int32)
        for dims in np.unique(size[usable]).tolist():
            own = np.flatnonzero(size == dims)
            whole = len(own) == len(size)
            rows = flat[at[0] : at[-1]].reshape(-1, dims) if whole else flat[at[own][:, None] + np.arange(dims)]
            cell[own] = _signs(rows.astype(np.float64))
        column = column if usable.all() else pc.if_else(pa.array(usable), column, pa.scalar(None, column.type))
        columns = [named, label, column, pa.array(size.astype(np.int32)), pa.array(cell)]
        yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "dims", "cell"])


class _Tile:
    """Vectors of equal length, ready to be compared."""

    def __init__(self, raw: np.ndarray, least: float):
        self.raw, dims = raw, raw.shape[1]
        unit = _unit(raw.astype(np.float64))
        self.unit = unit.astype(np.float32)
        # sums of so many products in single precision, of factors that are rounded
        self.margin = np.float32((dims + 8) * 2.0**-22)
        self.first = None
        if kept := filter_dims(dims, least):
            near = unit @ subspace(dims, kept)
            rest = np.sqrt(np.maximum(1 - (near * near).sum(axis=1, keepdims=True), 0))
            self.first = np.hstack([near, rest]).astype(np.float32)


def _is_link(x: np.ndarray, y: np.ndarray, least: float) -> np.ndarray:
    """Whether rows of x and y are linked, in double precision."""
    x, y = x.astype(np.float64), y.astype(np.float64)
    dot = (_unit(x) * _unit(y)).sum(axis=1)
    good = dot >= least
    for t in np.flatnonzero(np.abs(dot - least) < 1e-9):  # at the limit, as defined: dot / (norm * norm) of the original vectors
        good[t] = float(x[t] @ y[t]) / (float(np.sqrt(x[t] @ x[t])) * float(np.sqrt(y[t] @ y[t]))) >= least
    return good


def _linked(x: _Tile, y: _Tile, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links (row of x, row of y), some of them at a time; each pair once if y is x."""
    floor, sure_from = np.float32(least) - x.margin, np.float32(least) + x.margin
    space, crowded = np.empty(STRIP * WIDTH, np.float32), 0
    for s in range(0, len(x.raw), STRIP):
        own = slice(s, min(s + STRIP, len(x.raw)))
        for c in range(s if x is y else 0, len(y.raw), WIDTH):
            other, rows, p = slice(c, min(c + WIDTH, len(y.raw))), np.arange(own.start, own.stop), None
            if x.first is not None and not crowded:
                most = space[: len(rows) * (other.stop - c)].reshape(len(rows), -1)
                np.matmul(x.first[own], y.first[other].T, out=most)
                if x is y and c == s:
                    np.fill_diagonal(most, -2)
                hit = np.flatnonzero(most.max(axis=1) >= floor)
                crowded = 8 if 2 * len(hit) > STRIP else 0
                if len(hit) == 0:
                    continue
                rows = rows[hit]
                p, q = np.nonzero(most[hit] >= floor)
            crowded = max(0, crowded - 1)
            if p is not None and len(p) < 64 * len(rows):
                dot = np.einsum("ij,ij->i", x.unit[rows[p]], y.unit[other][q])
            else:
                whole = x.unit[rows] @ y.unit[other].T
                p, q = np.nonzero(whole >= floor)
                dot = whole[p, q]
            p, q = rows[p], q + c
            near = dot >= floor if x is not y else (dot >= floor) & (q > p)
            p, q, sure = p[near], q[near], dot[near] > sure_from
            doubt = np.flatnonzero(~sure)
            for d in range(0, len(doubt), 4096):
                some = doubt[d : d + 4096]
                sure[some] = _is_link(x.raw[p[some]], y.raw[q[some]], least)
            if sure.any():
                yield p[sure], q[sure]


def _merge(root: np.ndarray, p: np.ndarray, q: np.ndarray) -> None:
    """Links p, q put into root, which holds the least member of each one's group."""
    while True:
        a, b = root[p], root[q]
        apart = a != b
        if not apart.any():
            return
        p, q, a, b = (c[apart] for c in (p, q, a, b))
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (up := root[root]).tobytes() != root.tobytes():
            root[:] = up


def _sums(at: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    return np.bincount(at, weights=values, minlength=size).astype(np.int64)


class _Run:
    """The nodes of a label in one tile, as they come in, sorted."""

    def __init__(self, key: tuple):
        self.key, self.parts = key, []

    def add(self, *columns: np.ndarray) -> None:
        self.parts.append(columns)

    def add_to_last(self, copies: int, least: int, named: bool) -> None:
        _, count, lowest, known, given, _ = self.parts[-1]
        count[-1] += 0 if given[-1] else copies
        lowest[-1], known[-1] = min(lowest[-1], least), known[-1] | named

    def __len__(self) -> int:
        return sum(len(part[0]) for part in self.parts)

    def columns(self) -> list[np.ndarray]:
        return [np.concatenate(c) for c in zip(*self.parts)]


_NODES = ["node", "copies", "least", "others", "root", "head"]


def _tile_type() -> T.StructType:
    lists = [T.StructField(n, T.ArrayType(T.LongType())) for n in _NODES]
    return T.StructType([T.StructField("tile", T.LongType()), T.StructField("label", T.StringType()), T.StructField("dims", T.IntegerType()), *lists, T.StructField("vectors", T.BinaryType())])


def _packed(least: float, tile: int, tile_bytes: int):
    """Rows sorted by label, dims, part and node, as tiles with the links inside them.

    A tile of a large label keeps its label and vectors; others hold whole labels and are done.
    """

    def inside(run: _Run, rows: slice = slice(None)) -> list[np.ndarray]:
        node, copies, lowest, known, _, raw = (c[rows] for c in run.columns())
        others, root = np.zeros(len(node), np.int64), np.arange(len(node))
        if len(node) > 1:
            ready = _Tile(raw, least)
            for p, q in _linked(ready, ready, least):
                others += _sums(p, copies[q], len(node)) + _sums(q, copies[p], len(node))
                _merge(root, p, q)
        head, named = np.full(len(node), np.iinfo(np.int64).max), np.zeros(len(node), bool)
        np.minimum.at(head, root[known], lowest[known])
        named[root[known]] = True
        return [node, copies, pa.array(lowest, mask=~known), others, node[root], pa.array(head[root], mask=~named[root]), raw]

    def tile_of(runs: list[list], label: str | None, dims: int | None) -> pa.RecordBatch:
        columns = [pa.concat_arrays([pa.array(run[i]) for run in runs]) for i in range(len(_NODES))]
        vectors = None if label is None else np.ascontiguousarray(runs[0][-1]).tobytes()
        lists = [pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in columns]
        first = min(int(run[0].min()) for run in runs)
        return pa.RecordBatch.from_arrays(
            [pa.array([first], pa.int64()), pa.array([label], pa.string()), pa.array([dims], pa.int32()), *lists, pa.array([vectors], pa.binary())],
            names=_tile_type().names,
        )

    def ended(run: _Run | None, done: list[list]) -> Iterator[pa.RecordBatch]:
        """After the last row of a run."""
        if run is None:
            return
        label, dims, part = run.key
        if part >= 0:
            yield tile_of([inside(run)], label, dims)
            return
        done.append(inside(run)[:-1])
        if sum(len(d[0]) for d in done) >= tile:
            yield tile_of(done, None, None)
            done.clear()

    def run(batches):
        open_run, done = None, []
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            column = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            coded = column["label"].dictionary_encode()
            labels, code = coded.dictionary.to_pylist(), coded.indices.to_numpy()
            dims, part, node = (column[c].to_numpy() for c in ("dims", "part", "node"))
            known = column["vec_id"].is_valid().to_numpy(zero_copy_only=False)
            lowest = column["vec_id"].fill_null(np.iinfo(np.int64).max).to_numpy()
            given, copies = column["copies"].is_valid().to_numpy(zero_copy_only=False), column["copies"].fill_null(0).to_numpy()
            at, values = _vectors(column["vector"])
            flat = values.to_numpy(zero_copy_only=False)
            key = lambda i: (labels[code[i]], int(dims[i]), int(part[i]))
            turn = np.ones(n, bool)
            turn[1:] = (code[1:] != code[:-1]) | (dims[1:] != dims[:-1]) | (part[1:] != part[:-1])
            turn[0] = open_run is None or open_run.key != key(0)
            fresh = turn.copy()
            fresh[1:] |= node[1:] != node[:-1]
            fresh[0] |= not turn[0] and open_run.parts[-1][0][-1] != node[0]
            starts = np.flatnonzero(fresh)
            head = int(starts[0]) if len(starts) else n
            if head:
                open_run.add_to_last(head, int(lowest[:head].min()), bool(known[:head].any()))
            bounds = np.append(np.flatnonzero(turn), n)
            if bounds[0] > head:
                bounds = np.append(head, bounds)
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                if turn[a]:
                    yield from ended(open_run, done)
                    open_run = _Run(key(a))
                s = starts[np.searchsorted(starts, a) : np.searchsorted(starts, b)]
                count = np.where(given[s], copies[s], np.diff(np.append(s, b)))
                raw = flat[at[a] : at[b]].reshape(b - a, -1)[s - a]
                open_run.add(node[s], count, np.minimum.reduceat(lowest[:b], s), np.logical_or.reduceat(known[:b], s), given[s], raw)
            label, size, place = open_run.key
            most = tile_rows(size, tile, tile_bytes)
            while place >= 0 and len(open_run) > 2 * most:
                yield tile_of([inside(open_run, slice(0, most))], label, size)
                rest = [c[most:] for c in open_run.columns()]
                open_run.parts = [tuple(rest)]
        yield from ended(open_run, done)
        if done:
            yield tile_of(done, None, None)

    return run


def tiles(rows: DataFrame, keys: DataFrame, least: float = LEAST) -> DataFrame:
    """All nodes of rows (vec_id, node, label, dims, cell, vector), in tiles with the links inside them. keys: rows without vector.

    Per tile a list of its nodes, their copies, least vec_id, linked copies of others (``others``), local root
    and its least vec_id (``head``); label and vectors if other tiles have nodes of that label.
    """
    usable, counts = (x.where(F.col("node").isNotNull()) for x in (rows, keys))
    counts = counts.groupBy("node", "label", "dims", "cell").agg(F.count("*").alias("copies"), F.min("vec_id").alias("lowest"))
    counts = written(counts)
    most = F.greatest(F.lit(1), F.least(F.lit(TILE), F.floor(F.lit(TILE_BYTES) / (8 * F.col("dims")))))
    large = counts.groupBy("label", "dims").agg(F.count("*").alias("size")).withColumn("most", most).where("size > most")
    # so many signs that a cell is no more than about a tile
    bits = F.least(F.lit(SIGNS), F.ceil(F.log2(F.col("size") / F.col("most"))) + 1).cast("int")
    large = large.withColumn("bits", bits).select("label", "dims", "most", "bits")
    cell = F.expr(f"shiftright(cell, {SIGNS} - bits)")
    sizes = counts.join(F.broadcast(large), ["label", "dims"]).groupBy("label", "dims", "bits", "most", cell.alias("place")).agg(F.count("*").alias("size"))
    upto = Window.partitionBy("label", "dims").orderBy("place")
    sizes = written(sizes.withColumn("before", F.sum("size").over(upto) - F.col("size")))
    large = sizes.select("label", "dims", "bits").distinct()
    crowds = counts.where(F.col("copies") >= CROWD).select("node", "copies", "lowest")
    dealt = usable.join(F.broadcast(large), ["label", "dims"], "left").withColumn("place", cell).join(
        F.broadcast(sizes.drop("bits")), ["label", "dims", "place"], "left"
    )
    dealt = dealt.join(F.broadcast(crowds), "node", "left").where(F.col("lowest").isNull() | (F.col("vec_id") == F.col("lowest")))
    # each cell is an interval of places in its label, each tile so many places
    part = F.floor((F.col("before") + F.pmod("node", "size")) / F.col("most"))
    dealt = dealt.select("label", "dims", F.coalesce(part, F.lit(-1)).cast("int").alias("part"), "node", "vec_id", "copies", "vector")
    dealt = dealt.repartition("label", "dims", F.floor(F.col("part") / TOGETHER)).sortWithinPartitions("label", "dims", "part", "node")
    packed = dealt.mapInArrow(_packed(least, TILE, TILE_BYTES), _tile_type())
    packed = packed.withColumn("folder", F.when(F.col("label").isNull(), -1).otherwise(F.pmod(F.xxhash64("label", "dims"), F.lit(FOLDERS)).cast("int")))
    path = shared_path(rows.sparkSession, "tiles")
    packed.write.partitionBy("folder").parquet(path)
    return rows.sparkSession.read.schema(packed.schema).parquet(path)


_MET = T.StructType([T.StructField(n, T.ArrayType(T.LongType()) if n != "tile" else T.LongType()) for n in ("tile", "others", "a", "b")])


def _meet(least: float, kind: str):
    """Pairs of tiles: to each tile's nodes the linked copies found, and edges between local roots."""

    class Side:
        def __init__(self, row: dict, side: str):
            get = lambda c: row[f"{side}_{c}"]
            self.copies, self.root = get("copies"), get("root")
            raw = np.frombuffer(get("vectors"), kind).reshape(-1, row["a_dims"])
            self.tile, self.size = _Tile(raw.copy(), least), len(raw)
            # the first node of a group is its root
            _, first, group = np.unique(self.root, return_index=True, return_inverse=True)
            self.group = first[group]

    def run(batches):
        ready: dict[int, Side] = {}
        others: dict[int, np.ndarray] = {}
        edges: list[np.ndarray] = []

        def found(name: int, count: np.ndarray | None) -> pa.RecordBatch:
            pairs = np.unique(np.concatenate(edges), axis=0) if edges else np.zeros((0, 2), np.int64)
            edges.clear()
            lists = [pa.array([x], pa.list_(pa.int64())) for x in (count, pairs[:, 0], pairs[:, 1])]
            return pa.RecordBatch.from_arrays([pa.array([name], pa.int64()), *lists], names=_MET.names)

        for batch in batches:
            for i in range(batch.num_rows):
                row = {}
                for c, v in zip(batch.schema.names, batch.columns):
                    row[c] = v[i].values.to_numpy() if pa.types.is_list(v.type) else v[i].as_buffer() if pa.types.is_binary(v.type) else v[i].as_py()
                sides = []
                for s in "ab":
                    name = row[f"{s}_tile"]
                    side = ready.get(name) or Side(row, s)
                    if len(ready) < READY:
                        ready[name] = side
                    sides.append(side)
                a, b = sides
                root = np.concatenate([a.group, b.group + a.size])
                for p, q in _linked(a.tile, b.tile, least):
                    for name, side, own, far, there in ((row["a_tile"], a, p, q, b), (row["b_tile"], b, q, p, a)):
                        if name not in others:
                            others[name] = np.zeros(side.size, np.int64)
                        others[name] += _sums(own, there.copies[far], side.size)
                    _merge(root, p, q + a.size)
                moved = np.flatnonzero(root != np.concatenate([a.group, b.group + a.size]))
                if len(moved):
                    ids = np.concatenate([a.root, b.root])
                    edges.append(np.unique(np.stack([ids[moved], ids[root[moved]]], axis=1), axis=0))
                if sum(map(len, edges)) > HELD:
                    yield found(row["a_tile"], None)
        for name, count in others.items():
            yield found(name, count)

    return run


def meetings(packed: DataFrame, kind: T.DataType, least: float = LEAST) -> DataFrame:
    """What the tiles of a label find in each other: per tile (in each task that saw links) counts and edges of roots."""
    spark, columns = packed.sparkSession, ["tile", "label", "copies", "root", "vectors"]
    pairs = None
    for (folder,) in packed.select("folder").distinct().where("folder >= 0").orderBy("folder").collect():
        a, b = (packed.where(F.col("folder") == folder).select(*[F.col(c).alias(f"{s}_{c}") for c in ["dims", *columns]]) for s in "ab")
        same = (F.col("a_label") == F.col("b_label")) & (F.col("a_dims") == F.col("b_dims")) & (F.col("a_tile") < F.col("b_tile"))
        # a product of partitions has no exchange
        found = a.hint("shuffle_replicate_nl").join(b, same).drop("a_label", "b_label", "b_dims")
        pairs = found if pairs is None else pairs.unionByName(found)
    if pairs is None:
        return spark.createDataFrame([], _MET)
    met = pairs.mapInArrow(_meet(least, np.dtype(to_arrow_type(kind).to_pandas_dtype()).str), _MET)
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    usual = spark.conf.get(limit, None)
    spark.conf.set(limit, BATCH)
    try:
        return written(met)
    finally:
        spark.conf.unset(limit) if usual is None else spark.conf.set(limit, usual)


_STATE = T.StructType([T.StructField(n, T.LongType()) for n in ("node", "root", "head", "n_links")])


def _added(tile: pa.Table, met: pa.Table) -> pa.Table:
    """The nodes of a tile with what all meetings counted."""
    node, copies, others, root, head = (tile.column(c).combine_chunks().values for c in ("node", "copies", "others", "root", "head"))
    total = copies.to_numpy() - 1 + others.to_numpy()
    for chunk in met.column("others").chunks:
        total = total + chunk.values.to_numpy().reshape(-1, len(total)).sum(axis=0)
    return pa.table([node, root, head, pa.array(total)], names=_STATE.names)


def near_duplicates(vectors: DataFrame, least: float = LEAST, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """Per row of vectors: vec_id, n_links, component_id (smallest vec_id that links reach), kept."""
    named = vectors.select(F.col(key).cast("long").alias("vec_id"), as_numbers(vectors, vector).alias("vector"), F.col(label).cast("string").alias("label"))
    schema = T.StructType([*named.schema, T.StructField("dims", T.IntegerType()), T.StructField("cell", T.IntegerType())])
    celled = named.select("vec_id", "label", "vector").mapInArrow(_with_cells, T.StructType([schema[c] for c in ("vec_id", "label", "vector", "dims", "cell")]))
    rows = celled.withColumn("node", F.when(F.col("vector").isNotNull(), F.xxhash64("label", "vector")))
    keys = written(rows.drop("vector"))
    packed = tiles(rows, keys, least)
    links = F.transform(F.arrays_zip("copies", "others"), lambda x: x["copies"] - 1 + x["others"]).alias("n_links")
    done = packed.where(F.col("label").isNull()).select("node", "root", "head", links)
    done = done.select(F.inline(F.arrays_zip("node", "root", "head", "n_links")))
    met = meetings(packed, named.schema["vector"].dataType.elementType, least)
    open_tiles = packed.where(F.col("label").isNotNull()).select("tile", "node", "copies", "others", "root", "head")
    added = open_tiles.groupBy("tile").cogroup(met.select("tile", "others").groupBy("tile")).applyInArrow(_added, _STATE)
    state = written(done.unionByName(added))
    edges = met.select(F.inline(F.arrays_zip("a", "b")))
    linked = components(edges).withColumnRenamed("node", "root")
    heads = state.where(F.col("node") == F.col("root")).select("root", "head")
    linked = linked.join(heads, "root")
    smallest = linked.groupBy("component").agg(F.min("head").alias("component_id"))
    linked = linked.join(smallest, "component").select("root", "component_id")
    state = state.join(linked, "root", "left").select("node", "n_links", F.coalesce("component_id", "head").alias("component_id"))
    out = keys.select("vec_id", "node").join(state, "node", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept")
    )
