"""Text expressions with database semantics for blanks, NULL and letter case."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def concat_blank(*parts: Column) -> Column:
    """Concatenate, reading NULL as the empty text (never NULL)."""
    return F.concat_ws("", *parts)


def trimmed(value: Column) -> Column:
    return F.trim(value.cast("string"))


def fold_key(value: Column) -> Column:
    """Join key that ignores letter case and trailing blanks; NULL stays NULL."""
    return F.lower(F.rtrim(value))


def collate_text(df: DataFrame, collation: str = "UTF8_LCASE_RTRIM") -> DataFrame:
    """Give every text column a collation.

    Spark's own equality, IN, prefix test, GROUP BY, DISTINCT and join then ignore
    letter case and trailing blanks, so a mart that needs those rules applies this
    to its input tables once and runs the jobs unchanged.
    """
    return df.select(*[
        F.collate(F.col(f.name), collation).alias(f.name)
        if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in df.schema.fields
    ])
