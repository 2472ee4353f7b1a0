"""What each feature adds to the score of each row, for boosted trees.

The share of a feature is its Shapley value in the game whose worth of a set of features
is the expected margin when only these are known: where an unknown feature decides,
both branches count by their training weight. The shares of a row and the expected margin
add up to the row's margin (half its log odds), exactly.

A leaf asks each feature on its path for an interval. Given which of these a row meets, a
leaf's shares do not depend on the row, so they are computed once per leaf and pattern
that occurs in a batch, for all leaves of a tree together.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.operators.models import feature_names
from basketlens.session import scratch_path

#: Rows that are looked at together.
ROWS = 1024
#: Codes of (leaf, pattern) up to which a table marks those that occur.
TABLE = 1 << 22

MARGIN, EXPECTED = "margin", "expected_margin"


@dataclass(frozen=True)
class Paths:
    """The leaves of one tree: per leaf and feature on its path the interval asked for, and the share of weight that meets it.

    Short paths are filled up with feature 0, which is asked for nothing.
    """

    feature: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray
    value: np.ndarray

    @property
    def expected(self) -> float:
        return float((self.value * self.share.prod(axis=1)).sum())


def paths_of(nodes: list, weight: float) -> Paths:
    """From the stored nodes of a tree and its weight in the sum."""
    by_id = {n["id"]: n for n in nodes}
    leaves: list[tuple[dict[int, tuple[float, float, float]], float]] = []
    stack = [(0, {})]
    while stack:
        at, asked = stack.pop()
        node = by_id[at]
        if node["leftChild"] < 0:
            leaves.append((asked, node["prediction"] * weight))
            continue
        split = node["split"]
        if split["numCategories"] >= 0:
            raise ValueError("a split on categories; numeric features are expected")
        feature, cut = split["featureIndex"], split["leftCategoriesOrThreshold"][0]
        low, high, share = asked.get(feature, (-np.inf, np.inf, 1.0))
        for child, bounds in ((node["leftChild"], (low, min(high, cut))), (node["rightChild"], (max(low, cut), high))):
            part = by_id[child]["impurityStats"][0] / node["impurityStats"][0]
            stack.append((child, {**asked, feature: (*bounds, share * part)}))
    depth = max(1, *(len(asked) for asked, _ in leaves))
    blank = (0, -np.inf, np.inf, 1.0)
    rows = [[(f, *b) for f, b in sorted(asked.items())] + [blank] * (depth - len(asked)) for asked, _ in leaves]
    table = np.array(rows, float).reshape(len(leaves), depth, 4)
    return Paths(table[:, :, 0].astype(np.int64), table[:, :, 1], table[:, :, 2], table[:, :, 3], np.array([v for _, v in leaves]))


def stored_paths(spark: SparkSession, model: GBTClassificationModel) -> list[Paths]:
    """The trees of a model, as Spark's model files hold them (their size is set by number and depth)."""
    path = scratch_path(spark, "trees")
    model.write().save(path)
    trees: dict[int, list] = {}
    for row in spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect():
        trees.setdefault(row["treeID"], []).append(row)
    return [paths_of(trees[i], w) for i, w in enumerate(model.treeWeights)]


def shares(met: np.ndarray, share: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Shapley values of the places of paths.

    ``met`` (0 or 1) and ``share``: one row per pattern, one column per place; ``value``: of
    the leaf. A set of features is worth the product of ``met`` over it and ``share`` over
    the others. For each place, the sets of the others are summed by size.
    """
    n, depth = met.shape
    weights = [factorial(s) * factorial(depth - 1 - s) / factorial(depth) for s in range(depth)]
    out = np.empty((n, depth))
    for i in range(depth):
        by_size = np.zeros((n, depth))
        by_size[:, 0] = 1.0
        for j in range(depth):
            if j != i:
                known = by_size[:, :-1] * met[:, j, None]
                by_size *= share[:, j, None]
                by_size[:, 1:] += known
        out[:, i] = (met[:, i] - share[:, i]) * (by_size @ weights)
    return out * value[:, None]


def tree_shares(tree: Paths, x: np.ndarray, out: np.ndarray) -> None:
    """Add the shares of one tree for the rows of x to out."""
    n, (leaves, depth) = len(x), tree.feature.shape
    code = np.zeros((n, leaves), np.int64)
    for j in range(depth):
        seen = x[:, tree.feature[:, j]]
        code |= ((seen > tree.low[:, j]) & (seen <= tree.high[:, j])).astype(np.int64) << j
    code += np.arange(leaves) << depth
    if leaves << depth <= TABLE:
        there = np.zeros(leaves << depth, bool)
        there[code] = True
        known = np.flatnonzero(there)
        place = np.cumsum(there) - 1
        at = place[code]
    else:
        known, at = np.unique(code, return_inverse=True)
        at = at.reshape(code.shape)
    leaf = known >> depth
    met = ((known[:, None] >> np.arange(depth)) & 1).astype(float)
    found = shares(met, tree.share[leaf], tree.value[leaf])
    for j in range(depth):
        # leaves that ask for one feature at this place are summed together
        order = np.argsort(tree.feature[:, j], kind="stable")
        features, first = np.unique(tree.feature[order, j], return_index=True)
        out[:, features] += np.add.reduceat(found[at[:, order], j], first, axis=1)


def attribute(model: PipelineModel, df: DataFrame, keep: Sequence[str] = ("user_id",)) -> DataFrame:
    """Per row: the columns kept, one share per slot of the features, the margin and the expected margin."""
    spark, boosted = df.sparkSession, model.stages[-1]
    names = feature_names(model, df)
    trees = stored_paths(spark, boosted)
    expected = sum(t.expected for t in trees)
    sent = spark.sparkContext.broadcast(trees)
    prepared = PipelineModel(model.stages[:-1]).transform(df)
    rows = prepared.select(*keep, vector_to_array("features").alias("__features"))
    kept = [rows.schema[c] for c in keep]
    numbers = [T.StructField(n, T.DoubleType()) for n in (*names, MARGIN, EXPECTED)]
    schema = T.StructType([*kept, *numbers])

    def run(batches):
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                x = batch.column(len(kept)).flatten().to_numpy().reshape(-1, len(names))
                out = np.zeros(x.shape)
                for tree in sent.value:
                    tree_shares(tree, x, out)
                columns = [*out.T, out.sum(axis=1) + expected, np.full(len(x), expected)]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[: len(kept)], *[pa.array(c, pa.float64()) for c in columns]], names=schema.names
                )

    return rows.mapInArrow(run, schema)


def importance(shared: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean absolute share per feature, largest first."""
    wide = shared.agg(*[F.avg(F.abs(F.col(f"`{f}`"))).alias(f) for f in features])
    rows = ", ".join(f"'{f}', `{f}`" for f in features)
    return wide.selectExpr(f"stack({len(features)}, {rows}) AS (feature, importance)").orderBy(F.desc_nulls_last("importance"), "feature")
