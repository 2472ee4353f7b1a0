"""N-gram Jaccard join by signature trees.

A document's set holds the hashes (64 bit) of its distinct 5-word shingles, A-Z in lower
case; a shorter text is one shingle. Two sets link when their Jaccard similarity is at
least ``percent``. The join is exact on these sets:

1. Of a set of n, at most n // 4 elements (for 75 %) are missing in a partner. So of the
   smaller half by hash, P, some must recur in the partner's P, how many follows from
   both sizes (``enough``); texts in groups name P by fingerprint, buckets count in how
   many P each element is, and only sets with enough recurring elements for their least
   demanding partner stay in the join (``candidates``). Partners share elements of P, so
   they share one of their rarest in P: those make the index.
2. Equal sets are one node. Index elements tie nodes to the least node that has them;
   the components of these ties hold all partners of their nodes.
3. Per component (or block of a large one) a signature tree: nodes hold the OR of their
   sets' bitmaps and the range of sizes. A dual traversal from the root prunes pairs of
   tree nodes by the largest overlap that they allow; what is left at the leaves is
   verified exactly. Pairs whose sets are already connected are skipped, so a group of
   near copies costs about one verification each, not one per pair.
4. A component of more than BLOCK nodes is cut into blocks, each with the component's
   hub. Sets that do not connect to the hub in their block are dealt into tiles of about
   BLOCK sets of like size, and so are the others; each pair of tiles that sizes allow to
   link is a group of its own (``meetings``), but for pairs of tiles that are connected
   anyway. So no group holds more than two tiles, and no link is lost.

Rows: null texts and texts without words have empty sets and link with nothing; their
component is their own doc_id. Equal texts are linked. A null doc_id is never the
smallest (a component of such rows only is null). Empty tables give empty results;
other columns are ignored. Two different shingles are taken for one only if their
64-bit hashes are equal.
"""

from __future__ import annotations

import functools
import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.llm.anchors import Rolling
from basketlens.llm.common import mix64, partitions, written
from basketlens.llm.graph import components
from basketlens.llm.repeats import BLOCK as EXCHANGE
from basketlens.llm.repeats import _BYTE_HASH, _IS_SPACE, _blocks, _bucket, _by_bucket, _name, _pack, _parts, _unpack

WORDS = 5
PERCENT = 75
#: Below this, partners may share no element of P.
LEAST_PERCENT = 51
BLOCK = 1024
FANOUT = 16
BITS = 2048
#: Pairs of tree nodes that are looked at together.
FRONTIER = 1 << 16
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def shingle_sets(texts: list[str | None], words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
    raw = _LOWER[np.frombuffer(b" ".join([*data, b""]), np.uint8)]
    word = np.concatenate([[False], ~_IS_SPACE[raw], [False]])
    edge = np.flatnonzero(word[1:] != word[:-1])
    starts, ends = edge[::2], edge[1::2]
    rolling = Rolling(Rolling(_BYTE_HASH[raw]).of(starts, ends))
    bounds = np.searchsorted(starts, np.append(0, np.cumsum([len(d) + 1 for d in data])))
    grams = rolling.of_length(words)
    sets = []
    for a, b in zip(bounds.tolist(), bounds[1:].tolist()):
        if b - a >= words:
            sets.append(np.unique(grams[a : b - words + 1]))
        elif b > a:
            sets.append(rolling.of(np.array([a]), np.array([b])))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def half(n: int) -> int:
    """Size of P."""
    return -(-n // 2)


@functools.cache
def enough(n: int, percent: int) -> int:
    """How many elements the P of a set of n and the P of any partner have in common at least.

    Sets of n and m that link share s or more. P and a partner's P hold the least of
    these, but for as many as the n - s or m - s others may displace.
    """
    m = np.arange(-(-percent * n // 100), 100 * n // percent + 1)
    s = -(-percent * (n + m) // (100 + percent))
    return int(np.minimum(half(n) - (n - s), -(-m // 2) - (m - s)).min())


def indexed(n: int, percent: int) -> int:
    """How many of the rarest elements of P meet one of every partner's."""
    return half(n) - enough(n, percent) + 1


def _key(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def _distinct(table: pa.Table):
    """The sets of a group's documents, row by row: (row, set, its key)."""
    row = 0
    for part in _parts(table):
        for tokens in shingle_sets(part.column("text").to_pylist()):
            yield row, tokens, _key(tokens) if len(tokens) else None
            row += 1


def _elements(buckets: int):
    def run(table: pa.Table) -> pa.Table:
        seen, parts = set(), []
        for _, tokens, key in _distinct(table):
            if key is not None and key not in seen:
                seen.add(key)
                parts.append(tokens[: half(len(tokens))])
        if not parts:
            return _blocks([])
        name, count = np.unique(_name(np.concatenate(parts), buckets), return_counts=True)
        grp, low = table.column("grp")[0].as_py(), (name & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        several = count > 1
        rows = [
            (bucket, grp, _pack(name=low[part], several=np.where(several[part], count[part], 1).astype(np.uint16 if count.max() < 65536 else np.int32)))
            for bucket, part in _by_bucket((name >> np.uint64(32)).astype(np.int64))
        ]
        return _blocks(rows)

    return run


def _counted(table: pa.Table) -> pa.Table:
    """Per group, its elements that two sets or more have, and in how many they are."""
    blocks = [_unpack(b) for b in table.column("block").to_pylist()]
    names = [b.column("name").to_numpy() for b in blocks]
    every = np.concatenate(names) if names else np.zeros(0, np.uint32)
    count = np.concatenate([b.column("several").to_numpy().astype(np.int64) for b in blocks]) if blocks else np.zeros(0)
    order = np.argsort(every, kind="stable")
    every, count = every[order], count[order]
    if not len(every):
        return _blocks([])
    starts = np.flatnonzero(np.append(True, every[1:] != every[:-1]))
    total, every = np.add.reduceat(count, starts), every[starts]
    every, total = every[total > 1], total[total > 1]
    rows = []
    if len(every):
        for bucket, grp, name in zip(table.column("bucket").to_pylist(), table.column("grp").to_pylist(), names):
            at = np.minimum(np.searchsorted(every, name), len(every) - 1)
            hit = every[at] == name
            if hit.any():
                rows.append((bucket, grp, _pack(name=name[hit], count=total[at[hit]])))
    return _blocks(rows)


_ROW = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_shingles", T.LongType()),
        T.StructField("node", T.LongType()),
        T.StructField("tokens", T.BinaryType()),
        T.StructField("index", T.ArrayType(T.LongType())),
    ]
)


def _candidates(buckets: int, percent: int):
    def run(table: pa.Table, counted: pa.Table) -> pa.Table:
        names, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for bucket, block in zip(counted.column("bucket").to_pylist(), counted.column("block").to_pylist()):
            one = _unpack(block)
            names.append((np.uint64(bucket) << np.uint64(32)) | one.column("name").to_numpy().astype(np.uint64))
            counts.append(one.column("count").to_numpy())
        known, count = np.concatenate(names), np.concatenate(counts)
        order = np.argsort(known)
        known, count = known[order], count[order]
        seen, sizes, nodes, tokens_out, index_out = set(), [], [], [], []
        for _, tokens, key in _distinct(table):
            n = len(tokens)
            sizes.append(n)
            nodes.append(int.from_bytes(key[:8], "little", signed=True) if key else None)
            sent = index = None
            if n and key not in seen and len(known):
                seen.add(key)
                name = _name(tokens[: half(n)], buckets)
                at = np.minimum(np.searchsorted(known, name), len(known) - 1)
                found = np.where(known[at] == name, count[at], 1)
                if (found > 1).sum() >= enough(n, percent):
                    rare = np.argsort(found, kind="stable")[: indexed(n, percent)]
                    rare = rare[found[rare] > 1]
                    sent, index = tokens.tobytes(), tokens[rare].view(np.int64)
            tokens_out.append(sent)
            index_out.append(index)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
        columns = [table.column("doc_id").combine_chunks(), sizes, nodes, tokens_out, index_out]
        return pa.table([c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, kinds)], names=_ROW.names)

    return run


# -- signature trees ---------------------------------------------------------------------


class SignatureTree:
    """Levels of nodes over sets in order of size and least hash; level 0 are the sets."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        n = len(sets)
        sizes = np.fromiter(map(len, sets), np.int64, n)
        bits = np.zeros((n, BITS // 8), np.uint8)
        owner = np.repeat(np.arange(n), sizes)
        at = (mix64(np.concatenate(sets)) % np.uint64(BITS)).astype(np.int64) if n else np.zeros(0, np.int64)
        np.bitwise_or.at(bits, (owner, at >> 3), (1 << (at & 7)).astype(np.uint8))
        maps = bits.view(np.uint64)
        excess = sizes - np.bitwise_count(maps).sum(axis=1)
        self.levels = [(maps, sizes, sizes, excess)]
        while len(self.levels[-1][1]) > 1:
            maps, low, high, excess = self.levels[-1]
            cuts = np.arange(0, len(low), FANOUT)
            self.levels.append(
                (
                    np.bitwise_or.reduceat(maps, cuts, axis=0),
                    np.minimum.reduceat(low, cuts),
                    np.maximum.reduceat(high, cuts),
                    np.maximum.reduceat(excess, cuts),
                )
            )

    def possible(self, level: int, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
        """Whether sets below two nodes of a level may link, by sizes and by the bits that both have."""
        maps, low, high, excess = self.levels[level]
        least = np.maximum(low[a], low[b])
        fits = 100 * np.minimum(high[a], high[b]) >= percent * least
        need = np.maximum(percent * (low[a] + low[b]), 0) / (100 + percent)
        overlap = np.zeros(len(a), np.int64)
        for s in range(0, len(a), FRONTIER):
            part = slice(s, s + FRONTIER)
            overlap[part] = np.bitwise_count(maps[a[part]] & maps[b[part]]).sum(axis=1)
        return fits & (overlap + np.minimum(excess[a], excess[b]) >= need - 1e-9)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def spanning_links(sets: list[np.ndarray], first: np.ndarray, percent: int = PERCENT, side: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Verified links that connect whatever the links among the sets connect.

    ``first``: labels; sets of one label count as connected already.
    ``side``: 0 or 1 for each set; links within a side are left out (some may be found).
    """
    n = len(sets)
    side = np.zeros(n, np.int64) if (alone := side is None) else side
    order = np.lexsort((np.array([s[0] for s in sets], np.uint64), np.fromiter(map(len, sets), np.int64, n), side))
    sets, side = [sets[i] for i in order], side[order]
    _, parent = np.unique(first[order], return_inverse=True)
    heads: dict[int, int] = {}
    parent = np.array([heads.setdefault(int(p), i) for i, p in enumerate(parent)], np.int64)
    out: list[tuple[int, int]] = []

    def roots() -> np.ndarray:
        while True:
            up = parent[parent]
            if (up == parent).all():
                return parent
            parent[:] = up

    def head(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def verify(a, b) -> None:
        for i, j in zip(a.tolist(), b.tolist()):
            x, y = head(i), head(j)
            if x != y and linked(sets[i], sets[j], percent):
                parent[max(x, y)] = min(x, y)
                out.append((int(order[i]), int(order[j])))

    tree = SignatureTree(sets)
    # sets next to each other by their least hash are the likeliest: they connect most near copies at once
    near = np.argsort(np.array([s[0] for s in sets], np.uint64), kind="stable")
    verify(near[:-1], near[1:])
    stack = [(len(tree.levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        level, a, b = stack.pop()
        if len(a) > FRONTIER:
            stack += [(level, a[s : s + FRONTIER], b[s : s + FRONTIER]) for s in range(0, len(a), FRONTIER)]
            continue
        label, width = roots(), FANOUT**level
        edges = np.arange(0, n, width)
        lo, hi = np.minimum.reduceat(label, edges), np.maximum.reduceat(label, edges)
        open_pairs = ~((lo[a] == hi[a]) & (lo[b] == hi[b]) & (lo[a] == lo[b]))
        if not alone:
            left, right = np.minimum.reduceat(side, edges), np.maximum.reduceat(side, edges)
            open_pairs &= ~((left[a] == right[a]) & (left[b] == right[b]) & (left[a] == left[b]))
        a, b = a[open_pairs], b[open_pairs]
        keep = tree.possible(level, a, b, percent)
        a, b = a[keep], b[keep]
        if not len(a):
            continue
        if level == 0:
            verify(a, b)
            continue
        below = len(tree.levels[level - 1][1])
        x = a[:, None] * FANOUT + np.repeat(np.arange(FANOUT), FANOUT)
        y = b[:, None] * FANOUT + np.tile(np.arange(FANOUT), FANOUT)
        real = (x < below) & (y < below) & ((a[:, None] != b[:, None]) | ((x <= y) if level > 1 else (x < y)))
        stack.append((level - 1, x[real], y[real]))
    return out


_LINKS = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def _block_links(percent: int):
    def run(table: pa.Table) -> pa.Table:
        nodes = np.array(table.column("node").to_pylist(), np.int64)
        label = np.array(table.column("label").to_pylist(), np.int64)
        nodes, at = np.unique(nodes, return_index=True)  # the hub may come twice
        tokens = table.column("tokens").to_pylist()
        sets = [np.frombuffer(tokens[i], np.uint64) for i in at.tolist()]
        side = np.array(table.column("side").to_pylist(), np.int64)[at] if "side" in table.column_names else None
        links = spanning_links(sets, label[at], percent, side) if len(sets) > 1 else []
        a, b = ([int(nodes[i]) for i in side] for side in (zip(*links) if links else ((), ())))
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def links_of_nodes(nodes: DataFrame, percent: int) -> DataFrame:
    """From (node, tokens, index): links that connect exactly what all links connect."""
    spark = nodes.sparkSession
    ties = nodes.select("node", F.explode("index").alias("t"))
    hubs = written(ties.groupBy("t").agg(F.min("node").alias("hub"), F.count("*").alias("n")).where("n > 1").drop("n"))
    star = ties.join(hubs, "t").where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b"))
    near = components(star)
    sizes = near.groupBy("component").agg(F.count("*").alias("n")).withColumn("blocks", F.ceil(F.col("n") / BLOCK)).drop("n")
    placed = written(nodes.select("node", "tokens").join(near, "node").join(sizes, "component"))
    small = placed.where("blocks = 1").select(
        F.concat(F.lit("s"), F.pmod(F.xxhash64("component"), F.lit(4 * partitions(spark)))).alias("place"), "node", "tokens", F.col("node").alias("label")
    )
    large = placed.where("blocks > 1")
    block = F.pmod(F.xxhash64("node"), F.col("blocks"))
    # a hub's component is its own name: it goes to all blocks
    everywhere = F.explode(F.when(F.col("node") == F.col("component"), F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).otherwise(F.array(block)))
    place = F.concat_ws(":", F.lit("c"), "component", "block")
    cut = large.withColumn("block", everywhere)
    grouped = small.unionByName(cut.select(place.alias("place"), "node", "tokens", F.col("node").alias("label")))
    links = written(grouped.groupBy("place").applyInArrow(_block_links(percent), _LINKS))
    if not large.limit(1).count():
        return links
    # second round for cut components: who is not connected to the hub meets all others
    joined = components(links).withColumnRenamed("component", "label")
    labelled = large.join(joined, "node", "left").withColumn("label", F.coalesce("label", "node"))
    hub = labelled.where("node = component").select("component", F.col("label").alias("hub_label"))
    inside, across = meetings(labelled.join(hub, "component").withColumn("apart", F.col("label") != F.col("hub_label")), percent)
    for groups in (inside, across):
        links = links.unionByName(written(groups.groupBy("place").applyInArrow(_block_links(percent), _LINKS)))
    return links


def meetings(labelled: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """From (component, node, tokens, label, apart): groups in which each node that is apart meets all of its component that sizes allow.

    Nodes lie in tiles of about BLOCK by component, class of size and apart. Partners are
    of one class or of neighbouring ones. First result: each tile of nodes apart; second:
    each pair of tiles of which one at least is apart, its nodes with the ``side`` they are of.
    """
    width = math.log(100 / percent) + 1e-6  # a little more than the sizes of partners differ
    key = ["component", "class", "apart"]
    dealt = labelled.withColumn("class", F.floor(F.log(F.octet_length("tokens") / 8) / width))
    sizes = dealt.groupBy(*key).agg(F.ceil(F.count("*") / BLOCK).alias("tiles"))
    dealt = written(dealt.join(sizes, key).withColumn("tile", F.pmod(F.xxhash64("node", F.lit(1)), F.col("tiles"))).drop("tiles"))
    tiles = written(dealt.groupBy(*key, "tile").agg(F.count("*").alias("n")).drop("n"))
    place = F.concat_ws(":", "component", "class", "apart", "tile")
    inside = dealt.where("apart").select(place.alias("place"), "node", "tokens", "label")
    a = tiles.select("component", F.struct("class", "apart", "tile").alias("x"))
    b = tiles.select("component", F.struct("class", "apart", "tile").alias("y"))
    pairs = a.join(b, "component").where("x < y and y.class - x.class <= 1 and (x.apart or y.apart)")
    pairs = pairs.withColumn("place", F.concat_ws(":", "component", "x.class", "x.apart", "x.tile", "y.class", "y.apart", "y.tile"))
    sides = F.explode(F.array(*[F.struct(F.col(c).alias("own"), F.lit(side).alias("side")) for side, c in enumerate("xy")]))
    sides = pairs.select("component", "place", sides.alias("s")).select("component", "place", "s.own.*", "s.side")
    return inside, dealt.join(sides, [*key, "tile"]).select("place", "node", "tokens", "label", "side")


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Per row of docs: doc_id, n_shingles, component_id (the smallest doc_id that links reach)."""
    if not LEAST_PERCENT <= percent <= 100:
        raise ValueError(f"percent must be between {LEAST_PERCENT} and 100")
    n = partitions(docs.sparkSession)
    groups = buckets = 2 * n
    grp = F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(groups)).cast("int")
    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("grp", grp)
    counted = dealt.groupBy("grp").applyInArrow(_elements(buckets), EXCHANGE).groupBy("bucket").applyInArrow(_counted, EXCHANGE)
    rows = written(dealt.groupBy("grp").cogroup(counted.groupBy("grp")).applyInArrow(_candidates(buckets, percent), _ROW))
    nodes = rows.where(F.col("tokens").isNotNull()).select("node", "tokens", "index")
    nodes = written(nodes.groupBy("node").agg(F.first("tokens").alias("tokens"), F.first("index").alias("index")))
    labels = components(links_of_nodes(nodes, percent))
    # the least doc_id per node first, so that a text of many copies is one row where labels meet
    least = rows.where(F.col("node").isNotNull()).groupBy("node").agg(F.min("doc_id").alias("least"))
    named = least.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    of_node = written(named.join(smallest, "component").select("node", "component_id"))
    out = rows.select("doc_id", "n_shingles", "node").join(of_node, "node", "left")
    own = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id"))
