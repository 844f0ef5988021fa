"""Copies of ten mart tables for the second database."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom import schemas

# Mirrored table -> rows per write batch.
MIRRORS = {
    "DimChannel": 150000, "DimCustGrp1": 150000, "DimCustGrpSap": 150000, "DimCustomer": 150000,
    "DimLocation": 150000, "DimMaterial": 150000, "DimRoute": 150000, "DimSalesman": 150000,
    "AggInvByBrandYM": 30000, "FactRouteSalesman": 150000,
}


def mirror(df: DataFrame, table: str) -> DataFrame:
    """Mirrored columns of a mart table, NULL where the mart does not fill one.

    The sink stamps a new load time.
    """
    if table not in MIRRORS:
        raise ValueError(f"{table} is not mirrored")
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schemas.schema(table).fields
    ])
