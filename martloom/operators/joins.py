"""Joins that Spark does not plan well from their literal form."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def or_join(left: DataFrame, right: DataFrame, left_keys: list[str], right_key: str) -> DataFrame:
    """Left join on ``right_key = left_keys[0] OR right_key = left_keys[1] ...``.

    An OR condition leaves Spark only a nested loop. Here each left row probes once
    per distinct key value, so a pair can meet at most once and needs no row id or
    de-duplication; rows that meet nothing are found by equi anti joins.
    ``right_key`` is dropped; the other right columns must not clash with the left.
    """
    payload = [c for c in right.columns if c != right_key]
    probe = F.array_compact(F.array_distinct(F.array(*[F.col(k) for k in left_keys])))
    matched = (
        left.withColumn("_probe", F.explode(probe))
        .join(right.withColumnRenamed(right_key, "_match"), F.col("_probe") == F.col("_match"))
        .drop("_probe", "_match")
    )
    keys = right.select(F.col(right_key).alias("_match")).distinct()
    unmatched = reduce(
        lambda rows, k: rows.join(keys, F.col(k) == F.col("_match"), "left_anti"), left_keys, left
    )
    padded = unmatched.select(
        *left.columns, *[F.lit(None).cast(right.schema[c].dataType).alias(c) for c in payload]
    )
    return matched.select(*left.columns, *payload).unionByName(padded)


def matched_flag(in_left: Column, in_right: Column) -> Column:
    """``both`` / ``left_only`` / ``right_only`` from two presence flags."""
    return (
        F.when(in_left & in_right, "both")
        .when(in_left, "left_only")
        .when(in_right, "right_only")
    )


def month_latest(df: DataFrame, key: str = "YM") -> DataFrame:
    """Rows of the newest month, through a one-row scalar subquery."""
    newest = df.select(F.col(key)).agg(F.max(key)).scalar()
    return df.filter(F.col(key) == newest)
