"""A corpus from raw documents to shards: quality, near-duplicates, contamination, mixing, sharding."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from fleetgauge.llm import decontaminate, line_crf, mixing, sharding, simhash
from fleetgauge.llm.common import shared_dir
from fleetgauge.llm.queries import fold, table


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier, fitted on labelled ones among them, accepts.

    Every row is judged by its own text, repeated ids and equal rows too; null and empty texts get a score as well.
    """
    return line_crf.accepted(docs, line_crf.fit(docs, table(spark, sf_dir, "labels"), fold(3) != 1))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates by SimHash: 3-word shingles, 2 bits at most.

    The smallest id stays, once; texts without a word are duplicates of each other. A null id counts as larger than any.
    """
    return simhash.one_of_each_group(docs)


def unseen_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark item, with its own or other values. Null texts and items hold nothing."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in an order in which every stretch holds the sources by their target weights; a null source is one too."""
    return mixing.mixed(docs)


def sharded_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their shard, and the documents of a shard together, in the order in which they were mixed.

    Null texts have no bytes; equal rows beyond a shard's limit go to pages; an empty table gives no shard.
    """
    placed, order = mixing.with_row_order(docs)
    return sharding.sharded(placed, order=order).drop(*order)


STAGES = [
    ("quality_classifier", good_documents),
    ("simhash_near_dedup", distinct_documents),
    ("benchmark_decontamination", unseen_documents),
    ("source_mixing", mixed_documents),
    ("sharding", sharded_documents),
]

#: A conditional random field and 64-bit XXH64 fingerprints cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet in the shared folder and read again by the next."""
    docs, path = table(spark, sf_dir, "documents"), f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{path}/{name}")
        docs = spark.read.parquet(f"{path}/{name}")
    return docs
