from __future__ import annotations

import pytest

from basketlens.operators.actions import asked_only
from basketlens.session import scratch_path
from basketlens.sources import keyed
from basketlens.sources.keyed import KeyedTable

ROWS, RANGES = 200_000, 20


@pytest.fixture(scope="module")
def table(spark):
    """Even ids, two rows of each in places, and rows without one."""
    rows = spark.range(ROWS).selectExpr("id * 2 AS user_id", "id % 7 AS kind", "repeat('x', 20) AS filler")
    twice = rows.filter("user_id % 1000 = 0").selectExpr("user_id", "-1L AS kind", "filler")
    none = spark.range(30).selectExpr("CAST(NULL AS LONG) AS user_id", "id AS kind", "'y' AS filler")
    made = KeyedTable(spark, scratch_path(spark, "keyed"), "user_id")
    made.replace(rows.unionByName(twice).unionByName(none), RANGES)
    return made


def _asked(spark, keys):
    return spark.createDataFrame([(k,) for k in keys], "user_id long")


def _scanned(df) -> int:
    """Rows that the scan of a plan without shuffles gave out."""
    df.count()
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_a_lookup_opens_only_files_of_its_keys(spark, table):
    assert len(table.read().inputFiles()) >= RANGES
    found = table.lookup(_asked(spark, [4000, 4000, 5001, None, -3, 10**9]))
    assert sorted((r["user_id"], r["kind"]) for r in found.collect()) == [(4000, -1), (4000, 2000 % 7)]
    assert len(found.inputFiles()) == 1
    assert "EqualTo(user_id,4000)" in found._jdf.queryExecution().executedPlan().toString()


def test_ids_between_stored_ones_are_settled_without_reading_rows(spark, table):
    found = table.lookup(_asked(spark, [5001, 77_777]))
    assert found.inputFiles() and _scanned(found) == 0, "Bloom filters answer inside the ranges"


def test_one_hundred_requests_read_few_rows(spark, table):
    keys = [2 * (ROWS // 100) * i for i in range(100)]
    found = table.lookup(_asked(spark, keys))
    assert {r["user_id"] for r in found.collect()} == set(keys)
    near = table.lookup(_asked(spark, range(10_000, 10_200, 2)))
    assert len(near.inputFiles()) <= 2 and near.count() == 101


@pytest.mark.parametrize("many", [False, True])
def test_both_ways_equal_a_semi_join(spark, table, many, monkeypatch):
    if many:
        monkeypatch.setattr(keyed, "PUSHED_KEYS", 3)
    asked = _asked(spark, [None, 0, 0, 1, 2, 1000, 399_998, 400_000, -1, 250_000, 123_456])
    want = sorted(map(tuple, asked_only(asked, table.read()).select("user_id", "kind", "filler").collect()))
    assert sorted(map(tuple, asked_only(asked, table).collect())) == want and len(want) == 9


def test_nothing_asked_and_nothing_stored(spark, table):
    assert table.lookup(_asked(spark, [])).count() == 0
    empty = KeyedTable(spark, scratch_path(spark, "keyed"), "user_id")
    with pytest.raises(LookupError):
        empty.read()
    empty.replace(table.read().limit(0))
    assert empty.read().count() == 0 and empty.lookup(_asked(spark, [1])).columns == ["user_id", "kind", "filler"]


def test_replacing_leaves_open_readers_alone(spark):
    made = KeyedTable(spark, scratch_path(spark, "keyed"), "user_id")
    made.replace(spark.range(10).withColumnRenamed("id", "user_id"))
    before = made.lookup(_asked(spark, [3, 12]))
    made.replace(spark.range(10, 20).withColumnRenamed("id", "user_id"))
    assert [r[0] for r in before.collect()] == [3]
    assert [r[0] for r in made.lookup(_asked(spark, [3, 12])).collect()] == [12]


def test_text_keys(spark):
    made = KeyedTable(spark, scratch_path(spark, "keyed"), "name")
    made.replace(spark.createDataFrame([("it's",), ("b\\c",), ("",), (None,)], "name string"))
    asked = spark.createDataFrame([("it's",), ("b\\c",), ("",), ("zz",)], "name string")
    assert sorted(r[0] for r in made.lookup(asked).collect()) == ["", "b\\c", "it's"]
