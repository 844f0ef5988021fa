"""Database writes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from martloom.plans.dims import stamped
from martloom.plans.mirror import MIRRORS, mirror
from martloom.sources.jdbc import JdbcSource


@dataclass(frozen=True)
class JdbcSink:
    target: JdbcSource
    batch_size: int = 10_000
    connections: int = 10
    isolation: str = "NONE"

    def options(self, table: str, batch_size: int | None = None, truncate: bool = False) -> dict[str, str]:
        base = {k: v for k, v in self.target.options().items() if k != "fetchsize"}
        return base | {
            "dbtable": table, "batchsize": str(batch_size or self.batch_size), "isolationLevel": self.isolation,
            # Spark coalesces to this many writers; a wider frame is not shuffled for it.
            "numPartitions": str(self.connections), "truncate": str(truncate).lower(),
        }

    def write(self, df: DataFrame, table: str, mode: str = "append", batch_size: int | None = None) -> int:
        """Write and return the row count, observed during the write itself."""
        seen = Observation()
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        options = self.options(table, batch_size, truncate=mode == "overwrite")
        counted.write.format("jdbc").options(**options).mode(mode).save()
        return seen.get["rows"]

    def append(self, df: DataFrame, table: str, batch_size: int | None = None) -> int:
        return self.write(df, table, "append", batch_size)

    def refresh(self, df: DataFrame, table: str) -> int:
        """Truncate and load, keeping the table's definition."""
        return self.write(df, table, "overwrite")

    def mirror(self, df: DataFrame, table: str, prefix: str = "Sales_") -> int:
        """Refresh a mirrored table with a new load stamp."""
        return self.write(stamped(mirror(df, table)), prefix + table, "overwrite", MIRRORS[table])
