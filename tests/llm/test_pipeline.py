"""The pipeline: stages in order, each against what its operator says on its own input."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import queries
from basketlens.llm.common import written

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        made = written(stage(spark, docs, FOLDER))
        out.append((name, docs, made))
        docs = made
    return {name: (before, after) for name, before, after in out}


def test_stages_keep_columns(stages):
    assert list(stages) == ["toxicity", "near_duplicates", "pii", "mixing", "bpe"]
    assert all(a.columns == b.columns for name, (a, b) in stages.items() if name != "bpe")


def test_filters_keep_clean_documents(stages, spark):
    before, after = stages["toxicity"]
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    gone = before.join(after, "doc_id", "left_anti").join(labels, "doc_id")
    assert gone.where("toxic = 0").count() <= 0.02 * labels.where("toxic = 0").count()
    before, after = stages["near_duplicates"]
    assert after.count() < before.count()
    assert after.groupBy("doc_id").count().where("count > 1").count() == 0


def test_redaction_and_mix(stages):
    before, after = stages["pii"]
    assert after.count() == before.count()
    assert after.where(F.col("text").rlike(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\.")).count() == 0
    before, after = stages["mixing"]
    assert after.join(before, "doc_id", "left_anti").count() == 0
    assert stages["bpe"][1].count() == after.count()


def test_stages_bear_null_and_empty_texts(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, "me@x.org writes to you", "en", "a", 22), (None, "me@x.org writes to you", None, None, 22)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, FOLDER))
    assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_repeated_ids_keep_their_different_texts(spark):
    rows = [(1, "alpha beta gamma delta epsilon zeta", "en", "a", 1), (2, "alpha beta gamma delta epsilon zeta", "en", "a", 1)]
    rows += [(3, "alpha beta gamma delta epsilon zeta", "en", "a", 1), (3, "quite another text of six words", "en", "b", 1)]
    rows += [(3, "quite another text of six words", "de", "a", 1), (None, "no id", None, None, None), (None, "no id", None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(map(tuple, corpus_pipeline.near_duplicates(spark, docs, FOLDER).collect()), key=str)
    assert got.count((None, "no id", None, None, None)) == 2
    assert [r[0] for r in got if r[0] is not None] == [1, 3, 3]
    assert (3, "quite another text of six words", "de", "a", 1) in got


def test_registered():
    names = queries()
    assert "pipeline" in names
    assert [n for n in range(1, 14) if sum(k.startswith(f"op{n}_") for k in names) != 1] == []
