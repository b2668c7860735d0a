"""Documents made into training sequences, in stages that each write what they keep."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from callflow.llm import jaccard_join, quality_cascade, repeated_spans, toxicity_chain, window_packing
from callflow.llm.queries import tokenizer_path
from callflow.llm.shared import importable, read
from callflow.session import new_work_path


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    importable(spark)
    return quality_cascade.keep_good(docs)


def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic, judged by a chain fitted on the labelled ones among them."""
    return toxicity_chain.keep_clean(docs, read(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    importable(spark)
    return jaccard_join.keep_one(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without bytes that repeat elsewhere over 200 bytes or more."""
    importable(spark)
    return repeated_spans.remove_repeats(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in the training sequences."""
    importable(spark)
    return window_packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality", good_documents),
    ("toxicity", clean_documents),
    ("near_duplicates", one_of_each),
    ("repeated_spans", without_repeats),
    ("packing", packed),
]

#: Word chains, shingle links and packing are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet in the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_work_path(spark, f"pipeline_{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
