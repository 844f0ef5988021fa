"""Registered queries of the package, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from martloom.llm import (
    collocations, decontaminate, language_id, lexical, metric_search, mixing, near_dedup, passages, quality, reply_trees,
    substrings, token_counts, toxicity,
)
from martloom.llm.common import ship

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    "op10_near_dedup": near_dedup.op10_near_dedup,
    "op11_lexical_search": lexical.op11_lexical_search,
    "op12_collocations": collocations.op12_collocations,
    "op13_toxicity": toxicity.op13_toxicity,
    "op1_language_id": language_id.op1_language_id,
    "op2_decontaminate": decontaminate.op2_decontaminate,
    "op3_quality": quality.op3_quality,
    "op4_chat_format": reply_trees.op4_chat_format,
    "op5_repeated_passages": passages.op5_repeated_passages,
    "op6_mixing": mixing.op6_mixing,
    "op7_repeated_substrings": substrings.op7_repeated_substrings,
    "op8_metric_search": metric_search.op8_metric_search,
    "op9_token_counts": token_counts.op9_token_counts,
}
SQL: dict[str, str] = {
    "op11_lexical_search": lexical.SQL,
    "op12_collocations": collocations.SQL,
    "op6_mixing": mixing.SQL,
    "op8_metric_search": metric_search.SQL,
}


def queries() -> dict[str, Query]:
    def shipped(query: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return query(spark, sf_dir)
        return run
    return {name: shipped(query) for name, query in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
