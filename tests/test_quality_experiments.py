from __future__ import annotations

import math

import pytest

from basketlens.operators import experiments as ex
from basketlens.operators import quality as q
from basketlens.session import scratch_path
from basketlens.sources.layers import FolderLayer


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(
        [(1, "a"), (1, "b"), (2, None), (None, "z"), (None, "a"), (3, "a")], "id long, v string"
    )


def test_suite_results(spark, table):
    parent = spark.createDataFrame([(1,), (2,), (None,)], "key long")
    checks = (
        q.RowCount(1, 5), q.Unique("id"), q.NotNull("id"), q.NotNull("v", 0.8), q.Accepted("v", ("a", "b")),
        q.References("id", parent, "key"), q.Unique("v"),
    )
    rows = {(r["check_name"], r["column_name"]): r for r in q.run_suite(q.Suite("t", table, checks)).collect()}
    assert len(rows) == 7
    assert rows["row_count", "*"]["success"] is False
    assert (rows["unique", "id"]["observed"], rows["unique", "id"]["failed_rows"]) == (1.0, 2)
    assert rows["not_null", "id"]["failed_rows"] == 2
    assert rows["not_null", "v"]["success"] is True and rows["not_null", "v"]["observed"] == 5 / 6
    assert rows["accepted_values", "v"]["failed_rows"] == 1, "NULL passes"
    assert rows["relationships", "id"]["failed_rows"] == 1, "NULL passes"
    assert rows["unique", "v"]["failed_rows"] == 3
    assert sorted(r["position"] for r in rows.values()) == list(range(1, len(rows) + 1))


def test_empty_table_passes_all_but_the_count(spark, table):
    rows = q.run_suite(q.Suite("t", table.limit(0), (q.RowCount(1, 5), q.Unique("id"), q.NotNull("id")))).collect()
    assert {r["check_name"]: r["success"] for r in rows} == {"unique": True, "row_count": False, "not_null": True}


def test_checkpoint_stops_the_run(spark, table):
    book = q.SuiteBook()
    first = book.register("s", q.Suite("t", table, (q.Unique("id"),)))
    assert book.register("s", q.Suite("t", table, ())) is first
    book.register("other", q.Suite("u", table, (q.RowCount(1, 10),)))
    results = book.run()
    assert tuple(q.summary(results).first()) == (2, 1, False)
    with pytest.raises(q.QualityError, match="t.id unique: 2 rows"):
        q.assert_passed(results)
    q.assert_passed(results.filter("table_name = 'u'"))
    assert q.stamped(results, "run").first()["run_name"].startswith("run-")


def test_ramp_keeps_sides(spark):
    df = spark.range(20000).selectExpr("id", f"{ex.variant('id', 's', ex.RAMP_HEALTH_CHECK)} AS a", f"{ex.variant('id', 's')} AS b")
    rows = df.collect()
    assert {r["b"] for r in rows} == {"control", "treatment"}
    assert all(r["a"] in (r["b"], "holdout") for r in rows)
    assert 0.01 < sum(r["a"] != "holdout" for r in rows) / 20000 < 0.03
    assert 0.48 < sum(r["b"] == "control" for r in rows) / 20000 < 0.52


def test_proportion_test_follows_the_formula(spark):
    counts = spark.createDataFrame([("control", 3821, 9600), ("treatment", 4061, 9600)], "variant string, buyers long, cart_units long")
    row = ex.proportion_test(counts).first()
    a, b = 3821 / 9600, 4061 / 9600
    pooled = (a + b) / 2
    z = (b - a) / math.sqrt(pooled * (1 - pooled) * 2 / 9600)
    assert row["z_score"] == pytest.approx(z)
    assert row["p_value"] == pytest.approx(math.erfc(z / math.sqrt(2)), rel=2e-7)
    assert row["status"] == "Significant Positive" and row["lift"] == pytest.approx(b / a - 1)


def test_undefined_without_variance(spark):
    counts = spark.createDataFrame([("control", 5, 5), ("treatment", 5, 5)], "variant string, buyers long, cart_units long")
    row = ex.proportion_test(counts).first()
    assert row["p_value"] is None and row["status"] == "Undefined"


def test_conversion_counts_units_once(spark):
    rows = [("u1", "control", 1, 0), ("u1", "control", 1, 1), ("u2", "control", 0, 1), ("u3", "holdout", 1, 1), (None, "control", 1, 1)]
    df = spark.createDataFrame(rows, "unit_id string, variant string, reached_cart int, purchased int")
    row = ex.conversion(df).first()
    assert (row["units"], row["cart_units"], row["buyers"], row["conversion_rate"]) == (2, 1, 1, 1.0)


def test_sample_size_and_days(spark):
    designs = spark.createDataFrame([(0.40, 2000.0), (0.0, 10.0)], "baseline double, daily_units double")
    rows = {r["baseline"]: r for r in ex.power_plan(designs).collect()}
    assert abs(rows[0.40]["units_per_variant"] - 9490) <= 2 and rows[0.40]["days"] == 10
    assert rows[0.0]["units_per_variant"] is None


def test_decision(spark):
    def primary(lift, p):
        return spark.createDataFrame([(lift, p)], "lift double, p_value double")

    def guard(ok):
        return spark.createDataFrame([(ok,)], "within_guardrail boolean")

    decide = lambda *a: ex.decide(*a).first()["decision"]
    assert decide(primary(0.06, 0.003), guard(True)) == "launch"
    assert decide(primary(0.06, 0.003), guard(False)) == "rollback"
    assert decide(primary(-0.06, 0.003), guard(True)) == "rollback"
    assert decide(primary(0.06, 0.2), guard(True)) == "rollback"
    assert decide(primary(None, None), guard(True)) == "rollback"


def test_p_values_of_known_normal_tails(spark):
    from basketlens.functions.sql import named, two_sided_p

    known = {0.0: 1.0, 1.0: 0.31731050786, 1.959963984540054: 0.05, 2.5758293035489: 0.01, -3.0: 0.00269979606, 5.0: 5.733031e-7}
    rows = spark.createDataFrame([(z,) for z in known], "z double").select("z", *named(p=two_sided_p("z"))).collect()
    assert all(abs(r["p"] - known[r["z"]]) <= 3e-7 * known[r["z"]] for r in rows)


def test_checks_of_the_written_table_equal_checks_of_its_plan(spark):
    rows = [(i, None if i % 10 == 0 else "ab"[i % 2], i % 7) for i in range(100)] + [(5, "c", None)]
    df = spark.createDataFrame(rows, "id long, kind string, ref int")
    parent = spark.createDataFrame([(i,) for i in range(6)], "k int")
    checks = (
        q.NotNull("kind", 0.8), q.Unique("id"), q.RowCount(1, 50), q.Accepted("kind", ("a", "b")),
        q.References("ref", parent, "k"),
    )
    layer = FolderLayer(spark, scratch_path(spark, "checked"))
    for table, frame in (("some", df), ("none", df.limit(0))):
        suite = q.Suite(table, frame, checks)
        got = q.replace_checked(layer, suite)
        assert got.columns == q.RESULT_COLUMNS
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, q.run_suite(suite).collect()))
        assert layer.read(table).count() == frame.count()
