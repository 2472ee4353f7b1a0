"""Connected components of links, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """From undirected links (a, b): (node, component), the component being its smallest node.

    Each round contracts: a node goes to the least of its neighbours, and on to that one's
    least; links are rewritten by where their ends went, and those within one node are
    dropped, so what is joined shrinks. A chain of nodes is at most half as long after a
    round, a star is one node after two. The moves of all rounds are put together at the
    end. Every round is written to the shared folder, so a lost executor costs one round;
    only whether links are left reaches the driver.
    """
    a, b = F.least("a", "b"), F.greatest("a", "b")
    left = written(links.where("a <> b").select(a.alias("a"), b.alias("b")).distinct())
    moves: list[DataFrame] = []
    while not left.isEmpty():
        ends = left.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("near")), F.struct(F.col("b").alias("node"), F.col("a").alias("near")))).alias("e"))
        least = ends.groupBy("e.node").agg(F.min("e.near").alias("near")).select("node", F.least("node", "near").alias("up"))
        least = written(least)
        on = least.select(F.col("node").alias("up"), F.col("up").alias("component"))
        moved = written(least.join(on, "up").select("node", "component"))
        moves.append(moved)
        first, second = (moved.select(F.col("node").alias(c), F.col("component").alias(f"to_{c}")) for c in "ab")
        kept = left.join(first, "a").join(second, "b").where("to_a <> to_b")
        left = written(kept.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct())
    if not moves:
        return links.where(F.lit(False)).select(F.col("a").alias("node"), F.col("b").alias("component"))
    labels = moves[0]
    for later in moves[1:]:
        later = later.select(F.col("node").alias("component"), F.col("component").alias("on"))
        labels = labels.join(later, "component", "left").select("node", F.coalesce("on", "component").alias("component"))
    return written(labels) if len(moves) > 1 else labels
