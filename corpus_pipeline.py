"""A training-data pipeline over ``documents``: quality classifier, exact dedup, n-gram Jaccard join,
benchmark decontamination, best-fit packing.

Each stage is a function of (spark, docs, sf_dir), where docs is what the stage before has kept. The first four return
the documents that stay, with their columns; the last returns where each piece of a document is packed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from cadenza.llm import decontam, exact_dedup, jaccard, packing, quality
from cadenza.llm.common import table
from cadenza.llm.registry import ready


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject. It learns from ``labels`` outside the held-out fold."""
    ready(spark)
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of equal texts."""
    ready(spark)
    return exact_dedup.drop_copies(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    ready(spark)
    return jaccard.drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    ready(spark)
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document, or piece of a longer one, is packed."""
    ready(spark)
    return packing.pack(docs).withColumnRenamed("id", "doc_id")


STAGES = [("quality_classifier", quality_classifier), ("exact_dedup", exact), ("ngram_jaccard_join", near_duplicates),
          ("benchmark_decontamination", decontamination), ("best_fit_packing", best_fit_packing)]

#: SQL can't express the classifier or the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written below the shared checkpoint folder and read again."""
    base = f"{ready(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{base}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
