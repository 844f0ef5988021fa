"""Stored tables: a path with a format, or a catalog table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_table(
    spark: SparkSession, location: str, kind: str = "parquet", schema: T.StructType | None = None, **options: str
) -> DataFrame:
    if kind == "table":
        return spark.table(location)
    reader = spark.read.format(kind).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(location)
