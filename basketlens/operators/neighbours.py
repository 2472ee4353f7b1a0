"""Exact k nearest neighbours among the rows of one table, without comparing all pairs.

Equal feature vectors are merged into one *site* with its number of rows first,
so copies, however many, cost one site. Space is cut into cells at medians of a
bounded sample; each cell finds neighbours among its own sites, and a site whose
k-th distance reaches out of its cell asks the other cells in reach, which it finds
by going down the tree of cuts. Cells beyond a task's share are compared tile by
tile. The cuts steer the work only: the answer does not depend on them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.functions.sql import named
from basketlens.session import shared_dir

CELL_SITES = 2048
SAMPLE_PER_CELL = 32
# The driver cuts space into at most so many cells, from so many sample rows. Larger tables
# have larger cells, which are compared in more tiles.
MAX_CELLS = 16_384
TILE_SITES = 8192
QUERIES_PER_TASK = 20_000
# Rows of the sample that bound the radius of a site whose cell has fewer than k others.
BOUND_ROWS = 2048


# The name of a feature vector: equal vectors, and only they, share it.
SITE = "md5(concat_ws('|', transform(vec, v -> CAST(v AS STRING))))"


def sites_of(points: DataFrame) -> DataFrame:
    """Distinct feature vectors of a table with ``vec`` as (site, vec, copies)."""
    return points.groupBy("vec").agg(*named(copies="count(1)")).selectExpr(f"{SITE} AS site", "vec", "copies")


def _cuts(sample: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """Median cuts as a complete binary tree in arrays (axis, value), root at 1.

    Each node cuts its widest axis. An axis of -1 ends the branch early.
    """
    axis, value = np.full(cells, -1), np.zeros(cells)
    members = {1: sample}
    for node in range(1, cells):
        points = members.pop(node, None)
        if points is None or len(points) < 2:
            continue
        spread = np.ptp(points, axis=0)
        wide = int(np.argmax(spread))
        if spread[wide] == 0:
            continue
        cut = np.median(points[:, wide])
        left = points[:, wide] <= cut
        if left.all():  # ties at the top: cut below them
            cut = points[points[:, wide] < cut][:, wide].max()
            left = points[:, wide] <= cut
        axis[node], value[node] = wide, cut
        members[2 * node], members[2 * node + 1] = points[left], points[~left]
    return axis, value


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=float)


@dataclass(frozen=True)
class _Tree:
    """Median cuts, and some rows of the sample they come from."""

    axis: np.ndarray
    value: np.ndarray
    sample: np.ndarray

    @classmethod
    def of(cls, sites: DataFrame, cells: int, total: int, seed: int) -> _Tree:
        share = min(1.0, cells * SAMPLE_PER_CELL / max(total, 1))
        rows = _matrix(sites.select("vec").sample(share, seed).toPandas()["vec"])
        return cls(*_cuts(rows, cells), rows[:BOUND_ROWS])

    def cell_of(self, points: np.ndarray) -> np.ndarray:
        node, active = np.ones(len(points), dtype=int), np.ones(len(points), dtype=bool)
        while active.any():
            inner = node < len(self.axis)
            active = inner & (self.axis[np.where(inner, node, 0)] >= 0)
            at = node[active]
            node[active] = 2 * at + (points[active, self.axis[at]] > self.value[at])
        return node

    def in_reach(self, points: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell) of all cells that a ball around a row's point can touch."""
        row, node = np.arange(len(points)), np.ones(len(points), dtype=int)
        rows, cells = [], []
        while len(row):
            inner = node < len(self.axis)
            inner &= self.axis[np.where(inner, node, 0)] >= 0
            rows.append(row[~inner])
            cells.append(node[~inner])
            row, node = row[inner], node[inner]
            x, r, cut = points[row, self.axis[node]], radius[row] * (1 + 1e-9), self.value[node]
            left, right = x - r <= cut, x + r >= cut  # touching counts, so none is lost to rounding
            row, node = np.concatenate([row[left], row[right]]), np.concatenate([2 * node[left], 2 * node[right] + 1])
        return np.concatenate(rows or [row]), np.concatenate(cells or [node])

    def bound(self, points: np.ndarray, k: int) -> np.ndarray:
        """An upper bound of the distance to the k-th other site: that of the k-th other sample row."""
        if len(self.sample) <= k:
            return np.full(len(points), np.inf)
        squared = sum((points[:, d : d + 1] - self.sample[None, :, d]) ** 2 for d in range(points.shape[1]))
        return np.sqrt(np.partition(squared, k, axis=1)[:, k])


def _with_cell(sites: DataFrame, tree: _Tree) -> DataFrame:
    @F.pandas_udf(T.IntegerType())
    def cell_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for vec in batches:
            yield pd.Series(tree.cell_of(_matrix(vec)), dtype="int32")

    return sites.withColumn("cell", cell_of("vec"))


_FOUND = "site string, vec array<double>, other string, other_vec array<double>, other_copies long, distance double"


def _closest(query: pd.DataFrame, points: pd.DataFrame, k: int, radius: np.ndarray | None = None) -> pd.DataFrame:
    """For each query site, its k closest other sites among ``points``, ties by site."""
    points = points.sort_values("site", ignore_index=True)
    target, names = _matrix(points["vec"]), points["site"].to_numpy()
    out = []
    step = max(1, 4_000_000 // max(1, len(points)))
    for lo in range(0, len(query), step):
        part = query.iloc[lo : lo + step]
        source = _matrix(part["vec"])
        squared = np.zeros((len(source), len(target)))
        for d in range(source.shape[1]):
            squared += (source[:, d : d + 1] - target[None, :, d]) ** 2
        squared[part["site"].to_numpy()[:, None] == names[None, :]] = np.inf
        take = min(k, len(target))
        order = np.argsort(squared, axis=1, kind="stable")[:, :take]
        found = np.sqrt(np.take_along_axis(squared, order, axis=1))
        keep = np.isfinite(found)
        if radius is not None:
            keep &= found <= radius[lo : lo + step, None]
        row, rank = np.nonzero(keep)
        hit = order[row, rank]
        out.append(
            pd.DataFrame(
                {
                    "site": part["site"].to_numpy()[row],
                    "vec": part["vec"].to_numpy()[row],
                    "other": names[hit],
                    "other_vec": points["vec"].to_numpy()[hit],
                    "other_copies": points["copies"].to_numpy()[hit],
                    "distance": found[row, rank],
                }
            )
        )
    columns = ["site", "vec", "other", "other_vec", "other_copies", "distance"]
    return pd.concat(out)[columns] if out else pd.DataFrame(columns=columns)


def nearest_sites(sites: DataFrame, k: int, cell_sites: int = CELL_SITES, seed: int = 42) -> DataFrame:
    """Rows (site, vec, other, other_vec, other_copies, distance, rank), rank 1 to k.

    Euclidean distance; equal distances rank by site. ``sites`` is read several
    times, so pass a written or checkpointed table. What the cells find on their
    own is checkpointed, as both the answer and the questions to other cells use it.
    """
    shared_dir(sites.sparkSession)
    total = sites.count()
    cells = 2
    while cells * cell_sites < total and cells < MAX_CELLS:
        cells *= 2
    tree = _Tree.of(sites, cells, total, seed)
    placed = _with_cell(sites, tree).checkpoint()
    own = placed.selectExpr("site", "vec", "cell", "double('Infinity') AS radius")
    local = _asked(placed, own, k).checkpoint()
    found = local.unionByName(_from_other_cells(placed, local, tree, k))
    ranked = found.selectExpr("*", "row_number() OVER (PARTITION BY site ORDER BY distance, other) AS rank")
    return ranked.filter(f"rank <= {k}")


def _asked(placed: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """The k closest within the radius for each (site, vec, cell, radius), among the sites of that cell.

    A cell with many sites is cut into tiles, a cell that many sites ask is copied, and
    each pair of a tile and a share of the questions is a group of its own; so a group's
    size has a bound whatever the cells are like.
    """
    shares = asked.groupBy("cell").agg(*named(parts=f"CAST(ceil(count(1) / {QUERIES_PER_TASK}) AS INT)"))
    tiles = placed.groupBy("cell").agg(*named(tiles=f"CAST(ceil(count(1) / {TILE_SITES}) AS INT)"))
    load = shares.join(tiles, "cell")
    questions = asked.join(load, "cell").selectExpr(
        "site AS q_site", "vec AS q_vec", "radius", "cell AS q_cell", "pmod(xxhash64(site), parts) AS q_part",
        "explode(sequence(0L, tiles - 1L)) AS q_tile",
    )
    offered = placed.join(load, "cell").selectExpr(
        "site AS p_site", "vec AS p_vec", "copies", "cell AS p_cell", "pmod(xxhash64('tile', site), tiles) AS p_tile",
        "explode(sequence(0L, parts - 1L)) AS p_part",
    )

    def answer(query: pd.DataFrame, points: pd.DataFrame) -> pd.DataFrame:
        query = query.rename(columns={"q_site": "site", "q_vec": "vec"})
        points = points.rename(columns={"p_site": "site", "p_vec": "vec"})
        return _closest(query, points, k, query["radius"].to_numpy())

    meeting = questions.groupBy("q_cell", "q_part", "q_tile").cogroup(offered.groupBy("p_cell", "p_part", "p_tile"))
    return meeting.applyInPandas(answer, _FOUND)


def _from_other_cells(placed: DataFrame, local: DataFrame, tree: _Tree, k: int) -> DataFrame:
    """Candidates for sites whose k-th local neighbour is not proven to be the k-th overall."""
    by_distance = local.selectExpr("site", "distance", "row_number() OVER (PARTITION BY site ORDER BY distance) AS rank")
    reach = by_distance.filter(f"rank = {k}").selectExpr("site", "distance AS radius")
    queries = placed.join(reach, "site", "left").select("site", "vec", "cell", "radius")

    @F.pandas_udf("struct<radius double, cells array<int>>")
    def ask(vec: pd.Series, cell: pd.Series, radius: pd.Series) -> pd.DataFrame:
        points, r = _matrix(vec), radius.to_numpy(dtype=float, copy=True)
        open_ = np.isnan(r)
        r[open_] = tree.bound(points[open_], k) if open_.any() else 0.0
        row, found = tree.in_reach(points, r)
        other = found != cell.to_numpy()[row]
        row, found = row[other], found[other]
        order = np.argsort(row, kind="stable")
        ends = np.searchsorted(row[order], np.arange(1, len(points)))
        return pd.DataFrame({"radius": r, "cells": [c.tolist() for c in np.split(found[order], ends)]})

    asked = queries.withColumn("a", ask("vec", "cell", "radius"))
    asked = asked.select("site", "vec", "a.radius", F.explode("a.cells").alias("cell")).checkpoint()
    return _asked(placed, asked, k)
