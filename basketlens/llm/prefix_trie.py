"""Prefix trie of conversations by collapse of whole sequences.

1. Rebuild: conversation c starts with the first h turns of the conversation that opens its
   block of ``BLOCK`` ids, h being crc32(c) % 4, and goes on with its own turns after its
   first h.
2. Chain: a turn's place, role and text give 128 bits; their running sums (four numbers)
   name every prefix, so equal prefixes get equal names wherever they are computed.
3. Collapse: conversations of equal whole sequences become one weighted sequence, with a
   list of who ends there (rows, in blocks of ids). Thousands of copies cost one row per
   task from here on.
4. Leaves: sequences that are a proper prefix of another one fall out by an anti-join.
5. Aggregate: each sequence gives its weight to all its prefixes; a prefix is a node. What
   a subtree saves is each node's saving, given to all prefixes of one sequence that runs
   through it: running sums from the end of that sequence.

No trie is built in memory and no step follows parents round by round. Window functions run
inside one conversation's run of ``RUN`` turn numbers; totals of earlier runs are carried
over, so a conversation of very many turns is no group without bound (turns of one number
stay together).

Rows: without conv_id a row takes no part. A null role or text counts as empty; a null turn
comes first; turns of one number are ordered by role and text, so repeated rows are
repeated turns. Texts of any length are used whole (as digests; ``turns_of_nodes`` brings
them back). A conversation that comes out without turns ends at the root. An empty table
gives no nodes. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from basketlens.llm.common import WORD, written

#: Ids that share the conversation which opens their block.
BLOCK = 20
#: Turn numbers (or places) that a window spans.
RUN = 1024
#: Ids of a block of an end list.
END_BLOCK = 4096
_NAME = ["s0", "s1", "s2", "s3"]


def running(df: DataFrame, key: list[str], run: Column, order: list[Column], sums: dict[str, Column], backward: bool = False) -> DataFrame:
    """df with ``sums[name]`` added up over all rows of the key up to and with the current one.

    The order must agree with that of ``run``; ``backward`` adds up from the end. Rows of one
    run are windowed together, and so are the runs of one key.
    """
    way = (lambda c: F.desc(c)) if backward else (lambda c: F.asc(c))
    earlier = Window.partitionBy(*key).orderBy(way("__run")).rowsBetween(Window.unboundedPreceding, -1)
    marked = df.withColumns({"__run": run, **{f"__v_{n}": c for n, c in sums.items()}})
    totals = marked.groupBy(*key, "__run").agg(*[F.sum(f"__v_{n}").alias(f"__t_{n}") for n in sums])
    starts = totals.select(
        *key, "__run", *[F.coalesce(F.sum(f"__t_{n}").over(earlier), F.lit(0)).alias(f"__o_{n}") for n in sums]
    )
    inside = Window.partitionBy(*key, "__run").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = marked.withColumns({f"__v_{n}": F.sum(f"__v_{n}").over(inside) for n in sums})
    joined = local.join(starts, [*key, "__run"])
    return joined.select(*df.columns, *[(F.col(f"__v_{n}") + F.col(f"__o_{n}")).alias(n) for n in sums])


def turns_taken(conversations: DataFrame) -> DataFrame:
    """Rows of the table with their place (from 1) in their conversation: conv_id, place, role, text, said, words."""
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    # role and text as one digest: the length tells them apart
    said = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")))
    rows = rows.withColumns({"said": said, "words": F.regexp_count("text", F.lit(WORD)).cast("long")})
    run = F.coalesce(F.floor(F.col("turn") / RUN), F.lit(-(1 << 62)).cast("long"))
    order = [F.col("turn").asc_nulls_first(), F.col("role").cast("binary").asc(), F.col("text").cast("binary").asc()]
    return running(rows, ["conv_id"], run, order, {"place": F.lit(1).cast("long")}).drop("turn")


def rebuilt(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From turns_taken: (conv_id, h) of all conversations, and the turns of the rebuilt ones with their new places."""
    head = (F.crc32(F.col("conv_id").cast("string")) % 4).cast("long")
    convs = placed.select("conv_id").distinct().select("conv_id", head.alias("h"))
    convs = convs.withColumn("opener", F.col("conv_id") - F.col("conv_id") % BLOCK)
    # at most three turns of an opener are used, by at most BLOCK conversations on either side of zero
    openers = placed.where(F.col("conv_id") % BLOCK == 0).where(F.col("place") <= 3)
    taken = openers.withColumnRenamed("conv_id", "opener").join(convs, "opener").where(F.col("place") <= F.col("h"))
    had = openers.groupBy(F.col("conv_id").alias("opener")).agg(F.max("place").alias("had"))
    lengths = convs.join(had, "opener", "left").select("conv_id", "h", F.least("h", F.coalesce("had", F.lit(0))).alias("front"))
    columns = placed.columns
    own = placed.join(lengths, "conv_id").where(F.col("place") > F.col("h"))
    own = own.withColumn("place", F.col("place") - F.col("h") + F.col("front"))
    return convs.select("conv_id", "h"), taken.select(*columns).unionByName(own.select(*columns))


def link(place: str) -> dict[str, Column]:
    """What a turn adds to the name of a prefix: four 31-bit parts of a digest of its place and of what is said."""
    digest = F.md5(F.concat_ws(":", F.col(place).cast("string"), F.col("said")))
    return {n: F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").bitwiseAND(0x7FFFFFFF) for i, n in enumerate(_NAME)}


def named_prefixes(turns: DataFrame) -> DataFrame:
    """turns with the name of the prefix that ends there: s0..s3, the running sums of its links."""
    return running(turns, ["conv_id"], F.floor(F.col("place") / RUN), [F.asc("place")], link("place"))


def collapse(convs: DataFrame, prefixes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Whole sequences: (seq, depth, name, n, conv_id), ``seq`` being the least conversation that has it; and (conv_id, seq)."""
    zero = [F.lit(0).cast("long").alias(n) for n in ["depth", *_NAME]]
    last = prefixes.groupBy("conv_id").agg(F.max(F.struct(F.col("place").alias("depth"), *_NAME)).alias("end"))
    ends = last.select("conv_id", "end.*").unionByName(convs.join(last, "conv_id", "left_anti").select("conv_id", *zero))
    ends = written(ends)
    whole = ends.groupBy("depth", *_NAME).agg(F.count("*").alias("n"), F.min("conv_id").alias("seq"))
    return whole, ends


def nodes_of(prefixes: DataFrame, whole: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes with their sums, and whole sequences that are leaves.

    Per node: depth, name, conv_id, n_convs, n_leaves, words, parent's name, saved_tokens.
    """
    key = ["depth", *_NAME]
    steps = prefixes.join(whole.select("seq", "n").withColumnRenamed("seq", "conv_id"), "conv_id")
    steps = steps.select(F.col("conv_id").alias("seq"), "n", F.col("place").alias("depth"), "words", "said", *_NAME)
    zero = [F.lit(0).cast("long").alias(n) for n in ["depth", "words", *_NAME]]
    steps = written(steps.unionByName(whole.select("seq", "n", F.lit("").alias("said"), *zero)))
    # proper prefixes of other sequences are no leaves
    inner = steps.join(whole.select("seq", F.col("depth").alias("length")), "seq").where(F.col("depth") < F.col("length"))
    leaves = written(whole.join(inner.select(*key).distinct(), key, "left_anti").select("seq", "depth", *_NAME))
    marked = steps.join(leaves.select("seq", F.lit(1).cast("long").alias("leaf")), "seq", "left")
    sums = marked.groupBy(*key).agg(
        F.sum("n").alias("n_convs"),
        F.min("seq").alias("conv_id"),
        F.sum(F.coalesce("leaf", F.lit(0))).cast("long").alias("n_leaves"),
        F.first("words").alias("words"),
        F.first("said").alias("said"),
    )
    sums = written(sums)
    # each node's saving stands on the one sequence that names it, and goes to all prefixes of that sequence
    own = sums.select(F.col("conv_id").alias("seq"), "depth", ((F.col("n_convs") - 1) * F.col("words")).alias("saving"))
    costs = steps.select("seq", *key).join(own, ["seq", "depth"], "left").withColumn("saving", F.coalesce("saving", F.lit(0)))
    below = running(costs, ["seq"], F.floor(F.col("depth") / RUN), [F.desc("depth")], {"below": F.col("saving")}, backward=True)
    saved = below.groupBy(*key).agg(F.sum("below").cast("long").alias("saved_tokens"))
    # a parent's name is the node's own without its last link
    up = [(F.col(s) - part).alias(f"up_{s}") for s, part in link("depth").items()]
    return sums.join(saved, key).select(*key, "conv_id", "n_convs", "n_leaves", "words", "saved_tokens", *up), leaves


def trie(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes and ends.

    Nodes: conv_id (least member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, and the node's name s0..s3. Ends: one row per conversation, conv_id with
    depth and name of the node where it ends.
    """
    placed = written(turns_taken(conversations).select("conv_id", "place", "said", "words"))
    convs, turns = rebuilt(placed)
    prefixes = written(named_prefixes(turns))
    whole, ends = collapse(convs, prefixes)
    whole = written(whole)
    nodes, _ = nodes_of(prefixes, whole)
    nodes = written(nodes)
    up = [f"up_{s}" for s in _NAME]
    inner = nodes.where("depth > 0").withColumn("depth", F.col("depth") - 1)
    children = inner.groupBy("depth", *up).agg(F.count("*").alias("n_children"))
    children = children.withColumnsRenamed(dict(zip(up, _NAME)))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), *[F.col(s).alias(u) for s, u in zip(_NAME, up)], F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(children, ["depth", *_NAME], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))
    deep = out.where("depth > 0").join(parents, ["depth", *up])
    top = out.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", *_NAME]
    return deep.select(*columns).unionByName(top.select(*columns)), ends


def turns_of_nodes(conversations: DataFrame, nodes: DataFrame) -> DataFrame:
    """nodes with role and text of their last turn (null at the root)."""
    _, turns = rebuilt(turns_taken(conversations))
    said = turns.select("conv_id", F.col("place").alias("depth"), "role", "text")
    return nodes.join(said, ["conv_id", "depth"], "left")


_ENDS = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("depth", *_NAME)] + [T.StructField("ends_sha256", T.StringType())]
)


def digest_of_ends(ends: DataFrame) -> DataFrame:
    """Per node where conversations end: SHA-256 of their ids in ascending order, joined by commas.

    Ids are joined in blocks of END_BLOCK neighbouring numbers; a task reads the blocks of its
    nodes in order and keeps one block and one digest at a time, however many end at a node.
    """
    key = ["depth", *_NAME]
    block = F.floor(F.col("conv_id") / END_BLOCK)
    joined = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    blocks = ends.withColumn("block", block).groupBy(*key, "block").agg(joined.alias("ids"))

    def run(batches):
        node, digest = None, None

        def out():
            columns = [pa.array([v], pa.int64()) for v in node]
            return pa.RecordBatch.from_arrays([*columns, pa.array([digest.hexdigest()])], names=_ENDS.names)

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(len(key))]
            for i, here in enumerate(zip(*columns)):
                if here != node:
                    if node is not None:
                        yield out()
                    node, digest = here, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(batch.column(len(key))[i].as_py().encode())
        if node is not None:
            yield out()

    dealt = blocks.repartition(*key).sortWithinPartitions(*key, "block")
    return dealt.select(*key, "ids").mapInArrow(run, _ENDS)


def nodes_with_ends(conversations: DataFrame) -> DataFrame:
    """The nodes of ``trie`` with ends_sha256 (of nothing, where no conversation ends)."""
    nodes, ends = trie(conversations)
    none = hashlib.sha256().hexdigest()
    out = nodes.join(digest_of_ends(ends), ["depth", *_NAME], "left")
    return out.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(none)))
