"""The corpus pipeline: five stages, each an operator of martloom.llm applied to what the stage before it kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame. run() writes what a stage returns to the shared folder and
reads it back as the next one's input, so a lost executor costs at most the stage at work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm import decontaminate, language_id, mixing, near_dedup, passages
from martloom.llm.common import held_out, ship, stored, table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; learned from documents outside the held-out fold."""
    return language_id.keep_known(docs, language_id.train(docs.filter(~held_out(F.col("doc_id")))))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every class of near copies: five-word shingles, similarity 0.8 or more."""
    return near_dedup.keep_first(docs, near_dedup.Plan(share=80))


def without_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 13 words and more that a smaller document has; n_chars follows the text."""
    cut = passages.without_repeats(docs, 13)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) \
        if "n_chars" in docs.columns else cut


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, also none with other numbers or names."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), decontaminate.Rule(whole=True))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The selection by hierarchical budgets, with the number of copies of each document."""
    return mixing.mixed(docs, mixing.Recipe())


STAGES = [
    ("language_id", known_language),
    ("near_dedup", one_of_near_copies),
    ("passages", without_passages),
    ("decontaminate", without_benchmark),
    ("mixing", mixed),
]

# Prediction, signatures and shingle classes cannot be told in SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
