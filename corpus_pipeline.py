"""A corpus pipeline in stages: (spark, docs, sf_dir) -> DataFrame, each written and read again as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridspark.llm import bpe, common, exact_dedup, jaccard_join, mixing, toxicity

#: Toxicity, near duplicates and mixing repeat rows or drop them; encoding has a result that SQL cannot express.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted toxic go; learned from the labels of the training part."""
    return toxicity.reject(docs, common.read(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest id stays."""
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by similar word shingles the one with the smallest id stays."""
    return jaccard_join.one_of_each(docs)


def take_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.take(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number of tokens, and hashes of the ids and of the decoded text."""
    return bpe.encode(docs, digest=True)


STAGES = [("toxicity", drop_toxic), ("exact dedup", drop_copies), ("jaccard join", drop_near_copies), ("mixing", take_mix), ("bpe", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.keep(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
