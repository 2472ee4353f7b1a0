"""Synthetic minority oversampling: new rows between a row and one of its neighbours."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from basketlens.functions.ordering import hash_rank
from basketlens.functions.sql import named
from basketlens.operators.neighbours import SITE, nearest_sites, sites_of
from basketlens.session import scratch_path


#: Copies of each neighbour row that draws are dealt out to.
SALTS = 8


def _drawn(seed: int, what: str, digits: int) -> str:
    """A number of so many hexadecimal digits for a synthetic row's ``id``, from an md5 digest that any engine can repeat."""
    return f"CAST(conv(substring(md5(concat('{seed}-{what}-', CAST(id AS STRING))), 1, {digits}), 16, 10) AS BIGINT)"


def neighbour_slots(sites: DataFrame, k: int) -> DataFrame:
    """Per site, its ``k`` neighbours as rows (site, slot, other_vec), slots from 0.

    Neighbours are rows, not sites: the other copies of a site come first, at
    distance zero, and a neighbouring site fills as many slots as it has copies.
    """
    near = nearest_sites(sites, k).select("site", "other_vec", "other_copies", "rank")
    own = sites.filter("copies > 1").selectExpr(
        "site", "vec AS other_vec", "copies - 1 AS other_copies", "0 AS rank"
    )
    by_rank = "OVER (PARTITION BY site ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return (
        own.unionByName(near)
        .selectExpr("*", f"sum(least(other_copies, {k})) {by_rank} AS until")
        .selectExpr("*", f"until - least(other_copies, {k}) AS start")
        .filter(f"start < {k}")
        .selectExpr("site", "other_vec", f"explode(sequence(start, least(until, {k}) - 1)) AS slot")
    )


def smote(
    df: DataFrame, features: Sequence[str], target: str, key: str = "user_id", k: int = 5, seed: int = 42
) -> DataFrame:
    """The training rows plus synthetic minority rows up to parity: (features, target, synthetic).

    Each synthetic row draws a minority row and one of its ``k`` neighbours and
    lies at a random point between them; draws are hashes of its number. Features
    must not be NULL. The minority rows are written once to the shared folder, as
    the neighbour search reads them repeatedly.
    """
    spark = df.sparkSession
    counts = {r[target]: r["n"] for r in df.groupBy(target).agg(*named(n="count(1)")).limit(3).collect()}
    if len(counts) != 2:
        raise ValueError(f"two classes needed in {target}, found {sorted(counts)}")
    minority = min(sorted(counts), key=counts.get)
    rows, missing = counts[minority], max(counts.values()) - counts[minority]
    doubles = [f"CAST({f} AS DOUBLE) AS {f}" for f in features]
    original = df.selectExpr(*doubles, target, "false AS synthetic")
    if missing == 0:
        return original
    if rows <= k:
        raise ValueError(f"{rows} minority rows are too few for {k} neighbours")

    path = scratch_path(spark, "minority")
    vec = f"array({', '.join(f'CAST({f} AS DOUBLE)' for f in features)})"
    points = df.filter(f"{target} = {minority}").selectExpr(key, f"{vec} AS vec").selectExpr("*", f"{SITE} AS site")
    hash_rank(points, key, seed, rank="n").write.parquet(path)
    base = spark.read.parquet(path)
    site_path = scratch_path(spark, "sites")
    sites_of(base).write.parquet(site_path)
    sites = spark.read.parquet(site_path)

    draws = spark.range(missing).selectExpr(
        f"{_drawn(seed, 'row', 15)} % {rows}L + 1 AS n",
        f"{_drawn(seed, 'slot', 15)} % {k}L AS slot",
        f"{_drawn(seed, 'step', 13)} / CAST({1 << 52}L AS DOUBLE) AS step",
    )
    # a vector that many minority rows share gets many draws: they are dealt out, and its k neighbours copied
    salts = SALTS
    slots = neighbour_slots(sites, k).selectExpr("*", f"explode(sequence(0L, {salts - 1}L)) AS salt")
    drawn = draws.join(base.select("n", "vec", "site"), "n").selectExpr("*", f"pmod(n, {salts}L) AS salt")
    made = drawn.join(slots, ["site", "slot", "salt"])
    between = [f"vec[{i}] + step * (other_vec[{i}] - vec[{i}]) AS {f}" for i, f in enumerate(features)]
    kind = df.schema[target].dataType.simpleString()
    synthetic = made.selectExpr(*between, f"CAST({minority} AS {kind}) AS {target}", "true AS synthetic")
    return original.unionByName(synthetic)
