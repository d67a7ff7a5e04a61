"""A corpus pipeline over ``documents``: quality, toxicity, near duplicates, packing.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes each result as Parquet in the
shared folder and hands the table read back to the next stage, so a lost executor costs at most one stage's work.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from strata.llm import best_fit, ngram_join, quality_net, toxicity_mil
from strata.llm.common import read_table
from strata.session import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose calibrated quality reaches the threshold."""
    return quality_net.accept(docs, quality_net.fit(docs, read_table(spark, sf_dir, "labels")))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a sentence scored as toxic."""
    return toxicity_mil.accept(docs, toxicity_mil.fit(docs, read_table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word n-grams at a similarity of 0.8."""
    return ngram_join.one_of_each(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the remaining documents with their places in sequences."""
    return best_fit.pack(docs)


STAGES = [("quality classifier", quality), ("toxicity", toxicity), ("n-gram Jaccard join", near_duplicates), ("best-fit packing", packing)]

#: The learned stages have no SQL form; tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"pipeline-{k}-{uuid.uuid4().hex[:8]}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
