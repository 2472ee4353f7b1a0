"""Scoring requests from a stream against a static feature table and model."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from basketlens.operators.actions import answer_requests, asked_only
from basketlens.operators.models import score
from basketlens.sources.keyed import KeyedTable

REQUEST_SCHEMA = "request_id long, user_id long"


def read_requests(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    """A stream of request files (JSON lines with ``request_id`` and ``user_id``)."""
    return (
        spark.readStream.schema(REQUEST_SCHEMA).option("maxFilesPerTrigger", files_per_trigger).json(folder)
    )


def answers(requests: DataFrame, features: DataFrame | KeyedTable, model: PipelineModel) -> DataFrame:
    """Answer a batch of requests; only the features of users asked for are scored."""
    return answer_requests(requests, score(model, asked_only(requests, features)))


def serve(
    requests: DataFrame, features: DataFrame | KeyedTable, scoring: Callable[[DataFrame], DataFrame], out: str, checkpoint: str
) -> StreamingQuery:
    """Answer all requests there are and stop; a later call goes on where this one ended.

    Each micro-batch reduces ``features`` (a written table, best one by key) to the users it asks for,
    scores those with ``scoring`` and writes its answers to a folder of its own below
    ``out``: a batch that is repeated after a failure replaces what it wrote before.
    """

    def answer(batch: DataFrame, number: int) -> None:
        answered = answer_requests(batch, scoring(asked_only(batch, features)))
        answered.write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch={number}")

    return (
        requests.writeStream.foreachBatch(answer)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
