"""The registered queries: each operator over its whole table, as the digest of its rows, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.llm import bpe, importance, jaccard, kd_shards, learned_index, mixing, near_vectors, oracle, pii, prefix_trie, suffix_array, suffix_tree, token_file, toxicity
from basketlens.llm.common import crc_fold, shared_path, table

#: Appended to each document in the token file.
END_ID = 2
SHARDS = 8


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_tree.deduplicate(table(spark, folder, "documents")).select(
        "doc_id", F.col("n_units").alias("n_words"), "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def op3_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_array.deduplicate(table(spark, folder, "documents")).select(
        "doc_id", F.col("n_units").alias("n_bytes"), "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op5_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return learned_index.search(vectors, vectors.where(F.col("vec_id") % 100 == 0))


def op6_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, folder, "documents"))


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.fit(docs, table(spark, folder, "labels"))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    held_out = F.coalesce(crc_fold(F.col("doc_id")) == 0, F.lit(False))
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op8_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find(table(spark, folder, "documents").select("doc_id", "text"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select(
        "doc_id", *[count(k) for k in pii.KINDS], F.sha2(pii.listed("base").cast("binary"), 256).alias("base_sha256"),
        pii.listed("spans").alias("spans"),
    )


def op9_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors.near_duplicates(table(spark, folder, "embeddings"))


def digest_of_tokens(docs: DataFrame, vocabulary: str) -> DataFrame:
    return bpe.round_trip(docs.select("doc_id", "text"), vocabulary).select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return digest_of_tokens(table(spark, folder, "documents"), tokenizer_path())


def op4_token_file(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_path(spark, "tokens")
    token_file.write(table(spark, folder, "documents"), path, tokenizer_path(), END_ID)
    return token_file.read(spark, path)


def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "first_slot")


def op11_kd_shards(spark: SparkSession, folder: str) -> DataFrame:
    placed = kd_shards.listed(table(spark, folder, "documents"), SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.nodes_with_ends(table(spark, folder, "conversations")).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )


def op13_importance(spark: SparkSession, folder: str) -> DataFrame:
    drawn = importance.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_bpe": op2_bpe,
    "op3_suffix_array_dedup": op3_suffix_array_dedup,
    "op4_token_file": op4_token_file,
    "op5_nearest_neighbours": op5_nearest_neighbours,
    "op6_ngram_jaccard": op6_ngram_jaccard,
    "op7_toxicity": op7_toxicity,
    "op8_pii": op8_pii,
    "op9_near_vectors": op9_near_vectors,
    "op10_mixing": op10_mixing,
    "op11_kd_shards": op11_kd_shards,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_importance": op13_importance,
}

ORACLE = {
    "op10_mixing": oracle.MIXING_SQL,
    "op11_kd_shards": oracle.KD_SHARDS_SQL,
    "op12_prefix_trie": oracle.TRIE_SQL,
    "op13_importance": oracle.IMPORTANCE_SQL,
}
