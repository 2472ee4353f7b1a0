"""From raw documents to token ids: filter, deduplicate, redact, mix, encode.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before kept;
its result is written as Parquet to the shared folder and read again, so a lost executor
costs at most one stage's tasks. All but the last keep the columns of documents. What a
stage leaves in the shared folder besides its result is deleted when the next one starts.

Rows: null texts count as empty and pass all filters; rows of one doc_id and one text are
one document for deduplication; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from basketlens.llm import jaccard, mixing, pii, toxicity
from basketlens.llm.common import stage, table, written
from basketlens.llm.queries import digest_of_tokens, tokenizer_path

#: Documents at this score or above are rejected.
TOXIC = 0.5


@stage
def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below TOXIC; the model is fitted on the labels of these documents."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, into="__toxicity")
    return scored.where(F.col("__toxicity") < TOXIC).select(*docs.columns)


@stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one of smallest doc_id (rows without an id all stay).

    Rows that repeat both id and text are one document, the first by its other columns;
    different texts under one id all stay if one of them does.
    """
    groups = jaccard.near_duplicates(docs)
    kept = groups.where(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    digest, rest = F.md5(F.coalesce("text", F.lit(""))), [c for c in docs.columns if c not in ("doc_id", "text")]
    first = F.row_number().over(Window.partitionBy("doc_id", digest).orderBy(*rest, "doc_id"))
    named = docs.where(F.col("doc_id").isNotNull()).join(kept, "doc_id", "left_semi").withColumn("__first", first).where("__first = 1")
    return named.select(*docs.columns).unionByName(docs.where(F.col("doc_id").isNull()))


@stage
def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of personal data replaced by its kind in brackets."""
    return pii.redact(docs)


@stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them; where a target ends, the first words of a document."""
    return mixing.mixed_documents(docs)


@stage
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document of the mix, as counts and digests."""
    return digest_of_tokens(docs, tokenizer_path())


STAGES = [
    ("toxicity", toxicity_filter),
    ("near_duplicates", near_duplicates),
    ("pii", redact_personal_data),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: The models of the first and third stage have no SQL; each stage is tested against a plain version of it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for _, function in STAGES:
        docs = written(function(spark, docs, sf_dir))
    return docs
