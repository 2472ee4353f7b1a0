"""Sharding by a k-d tree over document metadata, with leaves of equal bytes.

1. Points: documents of equal text are one point, whose coordinates are the least of the
   copies' metadata and whose weight is their bytes together. A group heavier than
   ``GROUP_SHARE`` of a shard is cut into several points by a digest of doc_id, so no point,
   however many copies there are, spoils a cut. Points of one group follow each other in
   every order, and a cut goes beside a group if that is within ``GROUP_SLACK`` of a shard:
   only a group that a cut has to run through lies in more than one shard.
2. Tree: all nodes of a level are split at once, each along its widest dimension (extent in
   the node over extent in the table), at the weighted median: the place in the order
   (coordinate, digest of the text, part of the group) next to its share of the bytes. The
   place is found by counting: weights per interval of the node's range, then per interval
   of the one that holds the median, until one point is left. A round shuffles sums of at
   most ``INTERVALS`` intervals per node; windows see one node's intervals.
3. Leaves are the shards: as many as ask for ``target_bytes`` each.
4. Slots: documents of a shard are numbered in the order of a digest, by runs of that order
   whose totals are carried over, so no shard is ordered in one task.

Everything is a DataFrame expression; what is shuffled are keys and digests, no texts.

Rows: null and empty texts are equal and weigh 1 byte. Null coordinates come first. Rows
that agree in text and doc_id stay in one point. Coordinates of text are the first six
bytes, so values that differ only later are one coordinate. Ties are settled by the
digests. Fewer points than shards leave shards empty; an empty table gives no rows. Columns
of the operator's own start with two underscores and are replaced if docs has them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from basketlens.llm.common import partitions, written

#: Metadata columns that may be dimensions, as far as a table has them; the bytes of the text are one more.
DIMENSIONS = ("source", "lang", "doc_id")
#: Part of a shard's bytes from which a group of equal texts is cut into points.
GROUP_SHARE = 0.01
#: Part of a shard's bytes that a cut may miss its place by to keep a group whole.
GROUP_SLACK = 0.02
#: Shards up to which the list of heavy groups (at most 1 / GROUP_SHARE for each) is small enough to broadcast.
BROADCAST_SHARDS = 1000
INTERVALS = 4096
_TIES = ["__t0", "__t1", "__part"]


def _digits(column: Column, first: int, n: int) -> Column:
    """Hex digits of a text as a number (up to 13 digits are exact in a double)."""
    return F.conv(F.substring(column, first, n), 16, 10).cast("double")


def _coordinate(df: DataFrame, name: str) -> Column:
    if df.schema[name].dataType.typeName() == "string":
        head = F.rpad(F.hex(F.substring(F.col(name).cast("binary"), 1, 6)), 12, "0")
        return F.coalesce(_digits(head, 1, 12) + 1, F.lit(0.0))
    return F.coalesce(F.col(name).cast("double"), F.lit(float(-(1 << 63))))


def keyed(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with bytes (+ 1), a digest of the text, the dimensions, and a number by doc_id."""
    body = F.coalesce(F.col(text), F.lit(""))
    size = (F.octet_length(body) + 1).cast("long")
    dims = [n for n in DIMENSIONS if n in docs.columns]
    own = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    columns = {"__size": size, "__digest": F.md5(body), "__own": _digits(own, 1, 8).cast("long")}
    columns |= {f"__d{i}": _coordinate(docs, n) for i, n in enumerate(dims)}
    columns[f"__d{len(dims)}"] = size.cast("double")
    return docs.withColumns(columns)


def dimensions(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("__d") and c[3:].isdigit()]


def heavy_groups(rows: DataFrame, limit: float, shards: int) -> DataFrame:
    """Digest and number of parts of the texts whose copies weigh over ``limit``: of T bytes, at most T / limit texts."""
    heavy = rows.groupBy("__digest").agg(F.sum("__size").alias("w")).where(F.col("w") > limit)
    heavy = written(heavy.select("__digest", F.ceil(F.col("w") / limit).cast("long").alias("__parts")))
    return F.broadcast(heavy) if shards <= BROADCAST_SHARDS else heavy


def parted(rows: DataFrame, heavy: DataFrame) -> DataFrame:
    """rows with ``__part``: 0, but for heavy groups of equal texts."""
    part = F.coalesce(F.col("__own") % F.col("__parts"), F.lit(0))
    return rows.join(heavy, "__digest", "left").withColumn("__part", part.cast("long")).drop("__parts")


def points_of(rows: DataFrame) -> DataFrame:
    """One row per text (or part of a heavy group): weight, coordinates, digest as two numbers."""
    dims = dimensions(rows)
    points = rows.groupBy("__digest", "__part").agg(F.sum("__size").alias("w"), *[F.min(d).alias(d) for d in dims])
    # parts of a group share its coordinates
    same = Window.partitionBy("__digest")
    points = points.withColumns({d: F.min(d).over(same) for d in dims})
    return points.withColumns({"__t0": _digits(F.col("__digest"), 1, 13), "__t1": _digits(F.col("__digest"), 14, 13)})


def cuts_of(points: DataFrame, extents: dict[str, float], slack: float) -> DataFrame:
    """For each open node (``leaves`` > 1): its dimension and the last key of its left side.

    From points (node, leaves, w, coordinates, ties). Result: node, dim, level (how many parts
    of the key decide), k0..k3 (the key of the point at the median) and ``take`` (whether that
    point goes left).
    """
    dims = dimensions(points)
    some = points.where("leaves > 1")
    nodes = some.groupBy("node", "leaves").agg(
        F.sum("w").alias("total"), *[F.min(d).alias(f"lo_{d}") for d in dims], *[F.max(d).alias(f"hi_{d}") for d in dims]
    )
    width = [(F.col(f"hi_{d}") - F.col(f"lo_{d}")) / F.lit(max(extents[d], 1e-300)) for d in dims]
    widest = F.greatest(*width, F.lit(-1.0))
    pick = lambda make: F.coalesce(*[F.when(width[i] == widest, make(i, d)) for i, d in enumerate(dims)])
    state = nodes.select(
        "node",
        pick(lambda i, d: F.lit(i)).alias("dim"),
        (F.col("total") * F.floor(F.col("leaves") / 2) / F.col("leaves")).alias("need"),
        F.lit(0.0).alias("before"),
        F.lit(0).alias("level"),
        *[F.lit(0.0).alias(f"k{j}") for j in range(4)],
        pick(lambda i, d: F.col(f"lo_{d}")).alias("lo"),
        pick(lambda i, d: F.col(f"hi_{d}")).alias("hi"),
        F.lit(0).cast("long").alias("n"),
        F.lit(0.0).alias("last_w"),
    )
    state, done = written(_settled(state, slack)), None
    while True:
        ready = state.where("n = 1")
        done = ready if done is None else done.unionByName(ready)
        state = state.where("n <> 1")
        if state.isEmpty():
            break
        state = written(_settled(_narrowed(some, state, dims), slack))
    front, behind = _missed()
    take = behind < front
    return done.select("node", "dim", "level", "k0", "k1", "k2", "k3", take.alias("take"))


def _missed() -> tuple[Column, Column]:
    """By how many bytes a cut before and a cut behind the last interval miss their place."""
    return F.abs(F.col("before") - F.col("need")), F.abs(F.col("before") + F.col("last_w") - F.col("need"))


def _settled(state: DataFrame, slack: float) -> DataFrame:
    """Where the interval is one value, that part of the key is known and the next one is looked at.

    A group of several parts counts as one point where a cut beside it is near enough.
    """
    known = (F.col("lo") == F.col("hi")) & (F.col("n") != 1) & (F.col("level") < 3)
    whole = (F.col("lo") == F.col("hi")) & (F.col("level") == 2) & (F.least(*_missed()) <= slack)
    n = F.when(whole, F.lit(1).cast("long")).otherwise(F.col("n"))
    state = state.withColumn("n", n)
    top = F.when(F.col("level") < 2, float(1 << 52)).otherwise(float(1 << 53))
    keys = {f"k{j}": F.when((known | (F.col("n") == 1)) & (F.col("level") == j), F.col("lo")).otherwise(F.col(f"k{j}")) for j in range(4)}
    moved = {
        "lo": F.when(known, 0.0).otherwise(F.col("lo")),
        "hi": F.when(known, top).otherwise(F.col("hi")),
        "level": F.when(known, F.col("level") + 1).otherwise(F.col("level")),
    }
    return state.withColumns({**keys, **moved})


def _narrowed(points: DataFrame, state: DataFrame, dims: list[str]) -> DataFrame:
    """state with the interval that holds the median cut to one of INTERVALS, and what lies before it."""
    met = points.join(state.withColumnRenamed("n", "old_n"), "node")
    keys = [_along(dims), *[F.col(t).cast("double") for t in _TIES]]
    key = F.coalesce(*[F.when(F.col("level") == j, k) for j, k in enumerate(keys)])
    here = (key >= F.col("lo")) & (key <= F.col("hi"))
    for j, k in enumerate(keys):
        here &= (F.col("level") <= j) | (k == F.col(f"k{j}"))
    step = F.floor((key - F.col("lo")) / (F.col("hi") - F.col("lo")) * INTERVALS)
    step = F.coalesce(F.when(F.col("hi") > F.col("lo"), F.least(step, F.lit(INTERVALS - 1))), F.lit(0))
    kept = ["node", "dim", "need", "before", "level", "k0", "k1", "k2", "k3"]
    sums = met.where(here).withColumns({"step": step, "key": key}).groupBy(*kept, "step").agg(
        F.sum("w").alias("sum_w"), F.count("*").alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi")
    )
    order = Window.partitionBy("node").orderBy("step")
    reached = F.col("before") + F.sum("sum_w").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    sums = sums.withColumns({"reached": reached, "last": F.lead("step").over(order).isNull()})
    sums = sums.withColumn("start", F.col("reached") - F.col("sum_w"))
    holds = sums.where((F.col("start") <= F.col("need")) & ((F.col("reached") > F.col("need")) | F.col("last")))
    columns = [c for c in kept if c != "before"]
    return holds.select(*columns, F.col("start").cast("double").alias("before"), "lo", "hi", "n", F.col("sum_w").cast("double").alias("last_w"))


def _along(dims: list[str]) -> Column:
    """The coordinate along the node's dimension."""
    return F.coalesce(*[F.when(F.col("dim") == i, F.col(d)) for i, d in enumerate(dims)])


def tree(points: DataFrame, shards: int, slack: float) -> DataFrame:
    """points with ``shard``: the leaf of the k-d tree that they fall into."""
    dims = dimensions(points)
    points = written(points.withColumns({"node": F.lit(0).cast("long"), "leaves": F.lit(shards).cast("long")}))
    ends = points.agg(*[F.min(d) for d in dims], *[F.max(d) for d in dims]).first()
    extents = {d: (ends[i + len(dims)] or 0.0) - (ends[i] or 0.0) for i, d in enumerate(dims)}
    most = shards
    while most > 1:
        cuts = cuts_of(points, extents, slack)
        met = points.join(cuts, "node", "left")
        keys = [_along(dims), *[F.col(t).cast("double") for t in _TIES]]
        left, equal = F.lit(False), F.lit(True)
        for j, key in enumerate(keys):
            asked = F.col("level") >= j
            left = left | (equal & asked & (key < F.col(f"k{j}")))
            equal = equal & (~asked | (key == F.col(f"k{j}")))
        left = left | (equal & F.col("take"))
        half, split = F.floor(F.col("leaves") / 2), F.col("leaves") > 1
        points = written(
            met.withColumn("__left", left).select(
                *[c for c in points.columns if c not in ("node", "leaves")],
                F.when(split & ~F.col("__left"), F.col("node") + half).otherwise(F.col("node")).alias("node"),
                F.when(~split, F.lit(1)).when(F.col("__left"), half).otherwise(F.col("leaves") - half).cast("long").alias("leaves"),
            )
        )
        most = -(-most // 2)
    return points.drop("leaves").withColumnRenamed("node", "shard")


def assign(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None, text: str = "text") -> DataFrame:
    """docs with ``shard`` (from 0): as many shards as asked for, or as give ``target_bytes`` each."""
    marked = keyed(docs, text)
    dims = dimensions(marked)
    slim = written(marked.select("__size", "__digest", "__own", *dims))
    total = slim.agg(F.sum("__size")).first()[0] or 0
    if shards is None:
        shards = max(1, round(total / target_bytes))
    heavy = heavy_groups(slim, max(1.0, GROUP_SHARE * total / shards), shards)
    leaves = tree(points_of(parted(slim, heavy)), shards, GROUP_SLACK * total / shards)
    leaves = leaves.select("__digest", "__part", F.col("shard").cast("int").alias("__shard"))
    out = parted(marked, heavy).join(leaves, ["__digest", "__part"])
    kept = [c for c in docs.columns if c != "shard"]
    return out.select(*kept, F.col("__shard").alias("shard"))


def numbered(rows: DataFrame, ties: list[str]) -> DataFrame:
    """rows with ``slot``: 0, 1, 2... in each shard, in the order of a digest of doc_id and ``ties``."""
    runs = 4 * partitions(rows.sparkSession)
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ["doc_id", *ties]])
    marked = rows.withColumn("__name", F.md5(name))
    marked = marked.withColumn("__run", F.floor(_digits(F.col("__name"), 1, 8) * runs / (1 << 32)))
    counts = marked.groupBy("shard", "__run").agg(F.count("*").alias("__n"))
    before = Window.partitionBy("shard").orderBy("__run").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "__run", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    inside = F.row_number().over(Window.partitionBy("shard", "__run").orderBy("__name", "doc_id", *ties))
    out = marked.withColumn("__in", inside).join(starts, ["shard", "__run"])
    return out.select(*rows.columns, (F.col("__start") + F.col("__in") - 1).cast("long").alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int | None = None, target_bytes: int | None = None) -> None:
    """The documents as Parquet, one folder ``shard=N`` for each shard; tasks of one shard write a file each."""
    out = assign(docs, shards, target_bytes)
    spread = F.pmod(F.xxhash64("doc_id"), F.lit(partitions(docs.sparkSession)))
    out.repartition("shard", spread).write.mode("overwrite").partitionBy("shard").parquet(path)


def listed(docs: DataFrame, shards: int) -> DataFrame:
    """Per document: doc_id, size, text_crc32, shard, slot. Texts stay where they are read."""
    body = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.withColumns({"size": (F.octet_length(body) + 1).cast("long"), "text_crc32": F.crc32(body.cast("binary"))})
    placed = written(assign(rows, shards).select("doc_id", "size", "text_crc32", "shard"))
    return numbered(placed, ["size", "text_crc32"])
