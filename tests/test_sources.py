from __future__ import annotations

import math
from datetime import datetime
from multiprocessing.pool import ThreadPool

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer

from basketlens import schemas
from basketlens.plans import catalog
from basketlens.plans.marts import LoadedSources, MartDates, build_marts
from basketlens.session import scratch_path, shared_dir
from basketlens.sources import readers, samples
from basketlens.sources.commits import CommitLog
from basketlens.sources.layers import DatabaseLayer, FolderLayer, drop_derived
from basketlens.sources.registry import ModelRegistry


@pytest.fixture()
def layer(spark):
    return FolderLayer(spark, scratch_path(spark, "layer"))


def test_sample_tables_have_the_declared_schemas(spark, layer):
    samples.load_samples(spark, layer)
    for name, rows in samples.SAMPLE_ROWS.items():
        table = layer.read(name)
        assert table.count() == rows
        assert [(f.name, f.dataType) for f in table.schema] == [(f.name, f.dataType) for f in schemas.SOURCE_SCHEMAS[name]]
    assert {r["message"] for r in layer.read("hello_world").collect()} == {"Hello", "World"}
    user = layer.read("users").filter("id = 51").first()
    assert (user["first_name"], user["gender"], user["created_at"]) == ("User51", "F", datetime(2023, 1, 1))
    assert samples.hello_world(spark).first()["message"] == "Hello World"
    assert samples.sample_table(spark, "events", 1000).count() == 1000


def test_marts_from_samples(spark, layer):
    samples.load_samples(spark, layer)
    marts = FolderLayer(spark, scratch_path(spark, "marts"))
    names = build_marts(LoadedSources(layer), marts, MartDates())
    assert names[0] == "fct_sessions" and len(names) == 8
    assert marts.read("fct_sessions").count() == 100
    assert marts.read("churn_labels").count() == 0, "nobody bought in the sixty days before the snapshot"
    assert marts.read("mart_churn_features").select("is_churned").distinct().count() == 1
    assert marts.read("churn_features").count() == 50
    funnel = marts.read("mart_funnel").first()
    assert funnel["total_sessions"] == 100 and funnel["purchase_rate"] is None


def test_csv_folder_with_a_bad_table(spark, layer, tmp_path):
    (tmp_path / "users.csv").write_text("ID,First Name,extra\n7,Ann,x\n")
    (tmp_path / "orders.csv").write_text("order_id,user_id\n1,2\n")
    (tmp_path / "notes.csv").write_text("Some Text\nhello\n")
    (tmp_path / "skip.txt").write_text("no table")
    report = {r["table_name"]: r for r in readers.load_csv_folder(
        spark, str(tmp_path), layer, {"orders": schemas.ORDERS, "users": schemas.USERS.__class__(schemas.USERS.fields[:2])}
    ).collect()}
    assert set(report) == {"users", "orders", "notes"}
    assert report["orders"]["status"] == "failed" and report["orders"]["error"]
    assert report["users"]["loaded_rows"] == 1
    assert layer.read("users").first().asDict() == {"id": 7, "first_name": "Ann"}
    assert layer.read("notes").columns == ["some_text"]


def test_a_value_that_does_not_fit_fails_its_table(spark, layer, tmp_path):
    (tmp_path / "products.csv").write_text("id,cost\n1,cheap\n")
    schema = schemas.PRODUCTS.__class__(schemas.PRODUCTS.fields[:2])
    report = readers.load_csv_folder(spark, str(tmp_path), layer, {"products": schema}).first()
    assert report["status"] == "failed"


def test_no_folder_gives_an_empty_report(spark, layer):
    assert readers.load_csv_folder(spark, scratch_path(spark, "none"), layer).count() == 0


def test_reload_replaces(spark, layer):
    layer.replace("t", spark.range(3))
    layer.replace("t", spark.range(5))
    layer.append("t", spark.range(2))
    assert layer.read("t").count() == 7


def test_database_layers(spark):
    raw, marts = DatabaseLayer(spark, "bl_raw").create(), DatabaseLayer(spark, "bl_marts").create()
    try:
        raw.create().replace("t", spark.range(3))
        marts.replace("m", spark.range(2))
        marts.append("m", spark.range(1))
        assert marts.read("m").count() == 3
        drop_derived([marts])
        assert not marts.exists() and raw.read("t").count() == 3
    finally:
        drop_derived([raw, marts])


def test_bucketed_tables_join_without_a_shuffle(spark):
    raw = DatabaseLayer(spark, "bl_bucketed").create()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        raw.replace_bucketed("orders", spark.range(100).selectExpr("id AS order_id", "id % 7 AS user_id"), "order_id", 4)
        raw.replace_bucketed("items", spark.range(300).selectExpr("id % 100 AS order_id", "id AS price"), "order_id", 4)
        joined = raw.read("items").join(raw.read("orders"), "order_id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 300
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        raw.drop()


def _stub_model(spark, text: str) -> PipelineModel:
    return Pipeline(stages=[SQLTransformer(statement=f"SELECT *, '{text}' AS said FROM __THIS__")]).fit(spark.range(1))


def test_registry(spark, layer):
    registry = ModelRegistry(layer)
    assert registry.latest("m").count() == 0
    with pytest.raises(LookupError):
        registry.load_latest("m")
    assert [registry.register("m", _stub_model(spark, t)) for t in ("one", "two")] == [1, 2]
    assert registry.register("other", _stub_model(spark, "x")) == 1
    assert registry.load_latest("m").transform(spark.range(1)).first()["said"] == "two"


def test_runs(spark, layer):
    registry = ModelRegistry(layer)
    with pytest.raises(LookupError):
        registry.load_latest_run("e")
    metrics = spark.createDataFrame([("auc", 0.5)], "metric string, value double")
    registry.log_run("e", "first", {"depth": 3}, metrics, _stub_model(spark, "one"))
    run = registry.log_run("e", "second", {"depth": 4}, metrics, _stub_model(spark, "two"))
    registry.log_run("elsewhere", "third", {"depth": 5}, metrics)
    assert registry.latest_run("e").first()["run_id"] == run
    assert registry.load_latest_run("e").transform(spark.range(1)).first()["said"] == "two"
    values = {(r["kind"], r["key"]): r["text"] or r["value"] for r in registry.run_values(run).collect()}
    assert values == {("param", "depth"): "4", ("metric", "auc"): 0.5}


def test_shared_dir_follows_the_setting(spark):
    assert shared_dir(spark) == shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_csv_keeps_quotes_line_breaks_and_short_rows(spark, tmp_path):
    path = tmp_path / "people.csv"
    path.write_text('Id,Name,City,N\n1,"a ""b"", c",Rome,5\n2,"two\nlines","x,y",6\n3,,"",7\n4,short\n')
    schema = "n int, id long, name string, city string"
    rows = readers.read_csv_table(spark, str(path), spark.createDataFrame([], schema).schema).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [
        (5, 1, 'a "b", c', "Rome"), (6, 2, "two\nlines", "x,y"), (7, 3, None, None), (None, 4, "short", None),
    ]


@pytest.mark.parametrize("surplus", ["9,a,b,1,more", "9,a,b,1,", "9,a,b,1,2,3"])
def test_csv_row_with_too_many_fields_fails_its_table(spark, layer, tmp_path, surplus):
    (tmp_path / "bad.csv").write_text(f"id,name,city,n\n1,x,y,2\n{surplus}\n")
    (tmp_path / "good.csv").write_text("id\n1\n")
    report = {r["table_name"]: r for r in readers.load_csv_folder(spark, str(tmp_path), layer, {}).collect()}
    assert report["bad"]["status"] == "failed" and report["bad"]["loaded_rows"] == 0
    assert report["good"]["status"] == "loaded"


def _model(spark):
    return Pipeline(stages=[SQLTransformer(statement="SELECT * FROM __THIS__")]).fit(spark.range(1))


def test_registry_never_overwrites_and_never_restarts(spark, layer):
    registry = ModelRegistry(layer)
    assert registry.register("m", _model(spark)) == 1
    first = registry.latest("m").first()["path"]
    assert registry.register("m", _model(spark)) == 2
    assert registry.latest("m").first()["path"] != first and PipelineModel.load(first)
    broken = FolderLayer(spark, scratch_path(spark, "broken"))
    spark.range(1).selectExpr("'no commit' AS value").write.text(broken.path("commits"))
    with pytest.raises(Exception):
        ModelRegistry(broken).register("m", _model(spark))


def test_writers_at_once_get_versions_of_their_own(spark, layer):
    registry = ModelRegistry(layer)
    with ThreadPool(4) as pool:
        given = pool.map(lambda i: registry.register("m", _stub_model(spark, str(i))), range(8))
    assert sorted(given) == list(range(1, 9))
    rows = registry.versions().orderBy("version").collect()
    assert [r["version"] for r in rows] == list(range(1, 9)) and len({r["path"] for r in rows}) == 8
    assert registry.load_latest("m").transform(spark.range(1)).first()["said"] == str(given.index(8))


@pytest.mark.parametrize("way", ["_claim", "_rename"])
def test_a_number_is_taken_once(spark, tmp_path, way):
    log = CommitLog(spark, str(tmp_path / "a log"))
    assert log.last() == 0 and log.read("commit long").count() == 0
    assert log.commit(lambda: {"who": "a"}) == 1

    def claim(number: int, text: str) -> bool:
        if way == "_claim":
            return log._claim(number, text)
        return log._rename(f"{log.folder}/.hidden", log._path(number), text)

    assert not claim(1, '{"commit": 1, "who": "b"}')
    assert claim(2, '{"commit": 2, "who": "c"}')
    assert [tuple(r) for r in log.read("commit long, who string").orderBy("commit").collect()] == [(1, "a"), (2, "c")]
    assert not [p for p in (tmp_path / "a log").iterdir() if p.name == ".hidden"]


def test_a_lost_race_asks_again(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"))
    seen = []

    def entry():
        seen.append(log.last())
        if len(seen) == 1:
            CommitLog(spark, log.folder).commit(lambda: {"who": "faster"})
        return {"who": "slower"}

    assert log.commit(entry) == 2 and seen == [0, 1]


def test_odd_metrics_survive(spark, layer):
    registry = ModelRegistry(layer)
    odd = spark.createDataFrame([("nan", float("nan")), ("inf", float("inf")), ("none", None)], "metric string, value double")
    run = registry.log_run("e", "odd", {}, odd)
    values = {r["key"]: r["value"] for r in registry.run_values(run).collect()}
    assert math.isnan(values["nan"]) and values["inf"] == math.inf and values["none"] is None


def test_load_report_packs_its_csv_files(spark, tmp_path, monkeypatch):
    """tables of the load report go through small files, each read by one task, and come back whole."""
    rows = spark.range(400).selectExpr(
        "id AS user_id", "concat('a name, ', id % 7) AS full_name", "CASE WHEN id % 3 > 0 THEN 'line\nbreak' END AS note"
    ).coalesce(2)
    monkeypatch.setattr(catalog, "PACKED_ROWS", 60)
    monkeypatch.setattr(catalog.schemas, "SOURCE_SCHEMAS", {"notes": None})
    monkeypatch.setattr(catalog.StarSchema, "notes", lambda self: rows, raising=False)
    monkeypatch.setattr(catalog, "scratch_path", lambda _, name: f"{tmp_path}/{name}")
    assert [tuple(r)[:3] for r in catalog.load_report(spark, "unused").collect()] == [("notes", "loaded", 400)]
    catalog._write_csv(rows, f"{tmp_path}/plain.csv")
    packed, plain = (list((tmp_path / f).glob("part-*")) for f in ("csv/notes.csv", "plain.csv"))
    assert len(packed) >= 400 / 60 and all(p.suffix == ".gz" for p in packed)
    assert 2 * sum(p.stat().st_size for p in packed) < sum(p.stat().st_size for p in plain)
    loaded = spark.read.parquet(f"{tmp_path}/raw/notes")
    assert sorted(map(tuple, loaded.collect())) == sorted((str(r[0]), *r[1:]) for r in rows.collect())
