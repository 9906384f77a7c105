"""A training corpus from raw documents, stage by stage.

Each stage works on all rows that the one before kept; all but the last hand on
the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siftline.llm import exact_dedup, minhash, mixing, packing, quality
from siftline.llm.queries import tokenizer_file
from siftline.llm.tables import read, stage

TOKENIZER = "word_bpe_49k.json"


def keep_good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones among them, doesn't reject."""
    return quality.keep_good(docs, quality.fit(docs, read(spark, sf_dir, "labels")))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in windows."""
    return packing.pack_documents(docs, tokenizer_file(TOKENIZER))


STAGES = [
    ("quality classifier", keep_good_documents),
    ("exact dedup", drop_exact_copies),
    ("near dedup", drop_near_copies),
    ("mix sources", mix_sources),
    ("pack", pack_windows),
]

# A trained model has no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
