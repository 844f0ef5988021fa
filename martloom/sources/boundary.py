"""Map regions from GeoJSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Boundary attributes.
ATTRIBUTES = ["p_name_t", "p_name_e", "s_region", "a_name_t", "a_name_e", "t_name_t", "t_name_e"]
CODES = ["prov_idn", "amphoe_idn", "tambon_idn"]

_RING = "array<array<double>>"


def read_boundary(spark: SparkSession, path: str) -> DataFrame:
    """``id``, codes, attributes and ``rings`` of Polygon and MultiPolygon features, one per line."""
    properties = ", ".join(f"{c}:string" for c in ["id", *CODES, *ATTRIBUTES])
    line = F.from_json("value", f"properties struct<{properties}>, geometry struct<type:string, coordinates:string>")
    shape = spark.read.text(path).select(line.alias("f")).select("f.properties.*", "f.geometry.*")
    parts = F.when(
        F.col("type") == "MultiPolygon", F.flatten(F.from_json("coordinates", f"array<array<{_RING}>>"))
    ).otherwise(F.from_json("coordinates", f"array<{_RING}>"))
    point = lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))
    return shape.select(
        "id", *CODES, *ATTRIBUTES, F.transform(parts, lambda r: F.transform(r, point)).alias("rings")
    )
