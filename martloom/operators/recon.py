"""Reconciliation of two versions of one table."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.operators.joins import matched_flag


def _row_hash(left: DataFrame, right: DataFrame) -> Column:
    shared = [c for c in left.columns if c in right.columns]
    return F.xxhash64(*[F.col(c) for c in shared], *[F.col(c).isNull() for c in shared]).cast("decimal(20,0)")


def recon(left: DataFrame, right: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Keys whose rows differ: presence flag and ``left - right`` of every measure.

    Both sides go through one union and one aggregation: a single shuffle with
    map-side combine, and NULL keys compare as equal. A sum of row hashes over all shared columns shows
    differences that cancel out in the sums, and tells NULL from 0.
    """
    row = _row_hash(left, right)

    def side(df: DataFrame, name: str, sign: int) -> DataFrame:
        return df.select(
            *keys,
            *[(F.coalesce(F.col(m), F.lit(0)) * sign).alias(m) for m in measures],
            F.lit(1 if name == "left" else 0).alias("_left"),
            F.lit(1 if name == "right" else 0).alias("_right"), (row * sign).alias("_rows"),
        )

    delta = [f"{m}Delta" for m in measures]
    total = side(left, "left", 1).unionByName(side(right, "right", -1)).groupBy(*keys).agg(
        *[F.sum(m).alias(d) for m, d in zip(measures, delta)],
        F.sum("_left").alias("LeftRows"), F.sum("_right").alias("RightRows"), F.sum("_rows").alias("_rows"),
    )
    differs = reduce(or_, [F.col(d) != 0 for d in delta], F.col("LeftRows") != F.col("RightRows"))
    return total.filter(differs | (F.col("_rows") != 0)).drop("_rows").withColumn(
        "Presence", matched_flag(F.col("LeftRows") > 0, F.col("RightRows") > 0)
    )


def _differing(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Groups whose sums of row hashes differ. Rows that moved between groups count, as keys are hashed with the row."""
    row = _row_hash(left, right)
    both = left.select(*keys, row.alias("_rows")).unionByName(right.select(*keys, (-row).alias("_rows")))
    return both.groupBy(*keys).agg(F.sum("_rows").alias("_rows")).filter(F.col("_rows") != 0).drop("_rows")


def digested(
    left: DataFrame, right: DataFrame, keys: list[str], measures: list[str]
) -> tuple[DataFrame, DataFrame]:
    """Both sides as narrow as a comparison needs them: keys, measures, and one hash of all shared columns of a row.

    Comparing these finds what comparing the sides finds. For sides that are computed, stored so between the passes of
    `drill_down`.
    """
    row = _row_hash(left, right).cast("long").alias("_digest")
    return left.select(*keys, *measures, row), right.select(*keys, *measures, row)


def drill_down(left: DataFrame, right: DataFrame, levels: list[str], measures: list[str]) -> DataFrame:
    """What `recon` over all of ``levels`` returns, found from coarse to fine.

    One sum of row hashes per group of the first level (the month) tells which groups differ, and only those go on to the
    next level. The first level becomes a literal filter: it has few values, and tables stored by it are then
    read in the differing directories alone. Deeper groups narrow by a semi join. NULL keys are groups of their own.
    Each level reads its sides again, so sides that are computed should be stored first.
    """
    first = levels[0]
    for depth in range(1, len(levels)):
        found = _differing(left, right, levels[:depth])
        if depth == 1:
            values = [r[0] for r in found.collect()]
            among = F.col(first).isin([v for v in values if v is not None])
            among = among | F.col(first).isNull() if None in values else among
            left, right = left.filter(among), right.filter(among)
            continue
        found = found.toDF(*[f"_{k}" for k in levels[:depth]])
        same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in levels[:depth]])
        left, right = left.join(found, same, "left_semi"), right.join(found, same, "left_semi")
    return recon(left, right, levels, measures)
