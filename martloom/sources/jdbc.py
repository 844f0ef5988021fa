"""Database scans."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcSource:
    """Connection plus the ways to scan it. Credentials come from the caller."""

    url: str
    user: str | None = None
    password: str | None = None
    driver: str | None = None
    fetch_size: int = 10_000
    extra: dict[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        known = {"url": self.url, "user": self.user, "password": self.password, "driver": self.driver}
        set_ones = {k: v for k, v in known.items() if v is not None}
        return set_ones | {"fetchsize": str(self.fetch_size)} | self.extra

    def query(self, spark: SparkSession, sql: str) -> DataFrame:
        """Result of a query, in one partition; for small dimensions."""
        return spark.read.format("jdbc").options(**self.options(), query=sql).load()

    def ranged_options(
        self, column: str, lower: str, upper: str, partitions: int, *, table: str | None = None, query: str | None = None
    ) -> dict[str, str]:
        if (table is None) == (query is None):
            raise ValueError("name either a table or a query")
        return self.options() | {
            "dbtable": table if query is None else f"({query}) t", "partitionColumn": column, "lowerBound": str(lower),
            "upperBound": str(upper), "numPartitions": str(partitions),
        }

    def ranged(
        self, spark: SparkSession, column: str, lower: str, upper: str, partitions: int, *,
        table: str | None = None, query: str | None = None,
    ) -> DataFrame:
        """A table or query read in parallel by ranges of a number, date or timestamp column.

        The bounds only set the stride: rows outside them are read too.
        """
        return spark.read.format("jdbc").options(
            **self.ranged_options(column, lower, upper, partitions, table=table, query=query)
        ).load()

    def sliced(self, spark: SparkSession, table: str, predicates: list[str]) -> DataFrame:
        """One partition per predicate, e.g. one per month; predicates must not overlap."""
        props = {k: v for k, v in self.options().items() if k != "url"}
        return spark.read.jdbc(self.url, table, predicates=predicates, properties=props)
