"""The corpus pipeline: toxic documents go, near copies and benchmark passages go, and the rest is mixed and sharded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm.common import stored, table
from ledgerline.llm.decontaminate import clean_documents
from ledgerline.llm.mixing import mix_documents
from ledgerline.llm.ngram_join import keep_one
from ledgerline.llm.sharding import assign_shards
from ledgerline.llm.toxicity import train_toxicity, without_toxic

SHARDS = 8
BLOCK_WORDS = 1024


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't call toxic."""
    net = train_toxicity(docs, table(spark, sf_dir, "labels"))
    return without_toxic(docs, net)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares five-word shingles at a similarity of 0.8: one with the smallest doc_id."""
    return keep_one(docs, width=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window of ten words."""
    return clean_documents(spark, docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The parts of documents that the mix draws, as often as it draws them, each with its document's other columns."""
    return mix_documents(docs, block_words=BLOCK_WORDS).select(*docs.columns)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every part with its shard; the parts of a document share one."""
    return assign_shards(docs, SHARDS)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: Trained scores, set joins and seeded draws are beyond SQL; tests/llm holds the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
