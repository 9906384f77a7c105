"""Registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftline.llm import (
    embedding_dedup,
    exact_dedup,
    minhash,
    mixing,
    packing,
    phrases,
    prefix_trie,
    quality,
    secret_scan,
    sharding,
    substring_dedup,
    token_output,
    warc,
)
from siftline.llm.sql import SQL  # noqa: F401  (re-exported for the entry point)
from siftline.llm.tables import read, work_folder


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_groups(read(spark, folder, "documents"))


def op2_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(read(spark, folder, "documents")).drop("row")


def op3_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_groups(read(spark, folder, "documents"), shingle=4)


def op4_warc(spark: SparkSession, folder: str) -> DataFrame:
    archive = work_folder(spark, "archive")
    warc.write_archive(read(spark, folder, "pages"), archive)
    return warc.read_archive(spark, archive)


def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.cut_repeats(read(spark, folder, "documents"))


def op6_token_output(spark: SparkSession, folder: str) -> DataFrame:
    path = work_folder(spark, "tokens")
    docs = read(spark, folder, "documents")
    token_output.write_tokens(token_output.encode_documents(docs, tokenizer_file("byte_bpe_50k.json"), end_id=2), path)
    rows = token_output.checksums(spark.read.parquet(path))
    started = token_output.with_starts(rows, token_output.read_metadata(spark, path))
    return started.select("doc_id", "start", "n_tokens", "ids_crc32")


def op7_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.near_vectors(read(spark, folder, "embeddings"))


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(read(spark, folder, "documents"), tokenizer_file("word_bpe_49k.json"))


def op9_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.find_secrets(read(spark, folder, "documents"))


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    scored = quality.score(docs, quality.fit(docs, read(spark, folder, "labels")))
    return scored.select("doc_id", quality.held_out().alias("held_out"), "score", F.col("predicted"))


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(read(spark, folder, "documents"))


def op12_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.in_shards(read(spark, folder, "documents"), shards=8)


def op13_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.conversation_trie(read(spark, folder, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_exact_dedup,
        op2_mix_sources,
        op3_near_dedup,
        op4_warc,
        op5_substring_dedup,
        op6_token_output,
        op7_embedding_dedup,
        op8_packing,
        op9_secret_scan,
        op10_quality,
        op11_collocations,
        op12_sharding,
        op13_conversation_trie,
    )
}
