"""The mart on a shared file system: parquet tables with repeatable replace protocols.

A table is a directory, partitioned by month or load day where a replace is scoped by
it. Scoped replaces use dynamic partition overwrite: only partitions in the incoming
frame change, the commit swaps them after all tasks succeed, and the table itself is not
read. Whole-table writes go to a sibling directory that takes the table's place at the end.
"""

from __future__ import annotations

import uuid
from datetime import date
from functools import reduce
from operator import and_
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom import schemas
from martloom.functions import fold_key
from martloom.operators.replace import replace_keys

Keys = str | tuple[str, ...] | None
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
KEY_BUCKET = "key_bucket"


def _keys(partition: Keys) -> tuple[str, ...]:
    return () if partition is None else (partition,) if isinstance(partition, str) else tuple(partition)


def _plain_keys(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Partition columns in binary text: a directory name has no collation."""
    return df.withColumns({
        k: F.collate(F.col(k), "UTF8_BINARY") for k in keys if isinstance(df.schema[k].dataType, T.StringType)
        and df.schema[k].dataType != T.StringType()
    })


class Mart:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _file_system(self):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path

    def _old(self, table: str) -> str:
        return f"{self.root}/_{table}.old"

    def exists(self, table: str) -> bool:
        fs, path = self._file_system()
        return fs.exists(path(self.path(table)))

    def read(self, table: str) -> DataFrame:
        fs, path = self._file_system()
        live, old = self.path(table), self._old(table)
        # Between the two renames of a refresh the old rows are still complete.
        found = self.spark.read.parquet(old if not fs.exists(path(live)) and fs.exists(path(old)) else live)
        found = found.drop(KEY_BUCKET)
        if table not in schemas.TABLES:
            return found
        # A partition directory is text and comes last: give declared columns their type and place.
        declared = [f for f in schemas.schema(table).fields if f.name in found.columns]
        names = {f.name for f in declared}
        return found.select(*[
            F.col(f.name) if found.schema[f.name].dataType == f.dataType or isinstance(f.dataType, T.StringType)
            else F.col(f.name).cast(f.dataType).alias(f.name) for f in declared
        ], *[c for c in found.columns if c not in names])

    def _write(self, df: DataFrame, path: str, mode: str, partition: Keys, overwrite: str = "dynamic") -> int:
        seen, keys = Observation(), _keys(partition)
        counted = _plain_keys(df, keys).observe(seen, F.count(F.lit(1)).alias("rows"))
        writer = counted.write.mode(mode).option("partitionOverwriteMode", overwrite)
        (writer.partitionBy(*keys) if keys else writer).parquet(path)
        return seen.get["rows"]

    def _clustered(self, df: DataFrame, partition: Keys, sort: tuple[str, ...] = ()) -> DataFrame:
        """Few files per partition: rebalance by it, letting Spark split the large ones.

        ``sort`` orders rows inside each file, so that scans skip row groups by those columns.
        """
        keys = _keys(partition)
        laid = df.hint("rebalance", *[F.col(k) for k in keys]) if keys else df
        return laid.sortWithinPartitions(*keys, *sort) if sort else laid

    def append(
        self, table: str, df: DataFrame, partition: Keys = None, sort: tuple[str, ...] = ()
    ) -> int:
        return self._write(self._clustered(df, partition, sort), self.path(table), "append", partition)

    def overwrite(
        self, table: str, df: DataFrame, partition: Keys = None, sort: tuple[str, ...] = ()
    ) -> int:
        """Full refresh; the old rows stay in place until the new ones are complete.

        ``df`` may read the table itself. One writer per table is assumed.
        """
        fs, path = self._file_system()
        fresh = f"{self.root}/_{table}.{uuid.uuid4().hex}"
        rows = self._write(self._clustered(df, partition, sort), fresh, "errorifexists", partition)
        live, old = path(self.path(table)), path(self._old(table))
        self._finish_swap(table)
        if fs.exists(live):
            fs.rename(live, old)
        if not fs.rename(path(fresh), live):
            raise OSError(f"could not put the new {table} in place; it is complete at {fresh}")
        fs.delete(old, True)
        return rows

    def _finish_swap(self, table: str) -> None:
        """After a crash between the two renames, put the old table back."""
        fs, path = self._file_system()
        live, old = path(self.path(table)), path(self._old(table))
        if fs.exists(old):
            if fs.exists(live):
                fs.delete(old, True)
            else:
                fs.rename(old, live)

    def partitions(self, table: str, keys: tuple[str, ...]) -> list[tuple[str, ...]]:
        """Values of the partition columns, from the directory names."""
        fs, path = self._file_system()
        if not self.exists(table):
            return []

        def below(folder: str, left: tuple[str, ...]) -> list[tuple[str, ...]]:
            if not left:
                return [()]
            names = [s.getPath().getName() for s in fs.listStatus(path(folder)) if s.isDirectory()]
            values = [n.split("=", 1)[1] for n in names if n.startswith(f"{left[0]}=")]
            return [(v, *rest) for v in values for rest in below(f"{folder}/{left[0]}={v}", left[1:])]
        return below(self.path(table), keys)

    def replace_partitions(self, table: str, df: DataFrame, partition: str) -> int:
        """Key-set replace: every key in ``df`` takes the place of the rows the table had for it.

        A NULL key takes no one's place: stored rows without a key stay, as in the frame form, and are
        written again together with the new ones.
        """
        if any(v == (NO_VALUE,) for v in self.partitions(table, (partition,))):
            kept = self.spark.read.parquet(self.path(table)).filter(F.col(partition).isNull())
            df = df.unionByName(kept.select(*[F.col(f.name).cast(f.dataType) for f in df.schema.fields]))
        return self._write(self._clustered(df, partition), self.path(table), "overwrite", partition)

    def replace_window(
        self, table: str, df: DataFrame, partition: Keys, since: str, sort: tuple[str, ...] = ()
    ) -> int:
        """Trailing-window replace: partitions from ``since`` on hold exactly the rows of ``df``.

        The last partition column is the window key; a row of ``df`` before the window or without a
        key fails the write, and the table stays as it was. Partitions of the window that became
        empty are dropped once the new ones are in place. Which ones is counted during the write, one
        counter per stored partition of the window, so the frame is computed once.
        """
        keys = _keys(partition)
        stored = [v for v in self.partitions(table, keys) if v[-1] >= since and v[-1] != NO_VALUE]
        inside = F.col(keys[-1]).cast("string") >= since
        return self._replace(table, df, keys, inside, f"row outside the window from {since}", stored, sort)

    def replace_values(
        self, table: str, df: DataFrame, partition: str, values: set[str], sort: tuple[str, ...] = ()
    ) -> int:
        """Replace of named partitions: they hold exactly the rows of ``df``; ``NO_VALUE`` names the rows without a key.

        A row of ``df`` of another partition fails the write; named partitions that became empty are dropped.
        """
        key = F.col(partition).cast("string")
        inside = key.isin(sorted(values - {NO_VALUE}))
        if NO_VALUE in values:
            inside = inside | key.isNull()
        stored = [v for v in self.partitions(table, (partition,)) if unquote(v[0]) in values]
        return self._replace(table, df, (partition,), inside, "row of a partition that is not replaced", stored, sort)

    def _replace(
        self, table: str, df: DataFrame, keys: tuple[str, ...], inside: Column, wrong: str,
        stored: list[tuple[str, ...]], sort: tuple[str, ...]
    ) -> int:
        """Write rows over their partitions, then drop those of ``stored`` that received none."""
        key = F.col(keys[-1]).cast("string")
        late = F.raise_error(F.concat(F.lit(f"{table}: {wrong}: "), F.coalesce(key, F.lit("NULL"))))
        seen = Observation()

        def here(values: tuple[str, ...]) -> Column:
            # A stored directory escapes some characters, so compare what Spark would name it.
            tests = [F.col(k).isNull() if v == NO_VALUE else F.col(k).cast("string") == unquote(v)
                     for k, v in zip(keys, values)]
            return reduce(and_, tests)
        checked = _plain_keys(df, keys).filter(
            F.when(F.coalesce(inside, F.lit(False)), F.lit(True)).otherwise(late.cast("boolean"))
        ).observe(
            seen, F.count(F.lit(1)).alias("rows"),
            *[F.count_if(here(v)).alias(f"p{i}") for i, v in enumerate(stored)],
        )
        self._clustered(checked, keys, sort).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy(*keys).parquet(self.path(table))
        found = seen.get
        fs, path = self._file_system()
        for i, values in enumerate(stored):
            if not found[f"p{i}"]:
                folder = "/".join(f"{k}={v}" for k, v in zip(keys, values))
                fs.delete(path(f"{self.path(table)}/{folder}"), True)
        return found["rows"]

    def overwrite_in_buckets(self, table: str, df: DataFrame, on: list[str], buckets: int) -> int:
        """Full refresh of a table whose rows lie in directories by a hash of their key, for ``replace_by_keys``.

        The bucket column is not among the columns that ``read`` gives. Letter case and trailing blanks do
        not matter to it, so keys that compare as equal under a collation share a bucket.
        """
        return self.overwrite(table, _bucketed(df, on, buckets), KEY_BUCKET)

    def replace_by_keys(self, table: str, df: DataFrame, on: list[str], *, buckets: int | None = None) -> int:
        """Key-set replace of a table that is not partitioned by the key.

        A table stored in ``buckets`` is read and written in the buckets of the incoming keys only; the others keep their
        files. Any other table is written anew. Rows without a key take no one's place, as in the frame form.
        """
        if not self.exists(table) or buckets is None:
            merged = replace_keys(self.read(table), df, on) if self.exists(table) else df
            return self.overwrite(table, merged) if buckets is None else self.overwrite_in_buckets(table, merged, on, buckets)
        if not self.partitions(table, (KEY_BUCKET,)):
            return self.overwrite_in_buckets(table, replace_keys(self.read(table), df, on), on, buckets)
        old = self.spark.read.parquet(self.path(table))
        new = _bucketed(df.select(*[F.col(c).cast(old.schema[c].dataType).alias(c) for c in df.columns]), on, buckets)
        # Not more than there are buckets.
        touched = sorted(r[0] for r in new.select(KEY_BUCKET).distinct().collect())
        if not touched:
            return 0
        stored = old.withColumn(KEY_BUCKET, F.col(KEY_BUCKET).cast("int"))
        there = stored.filter(F.col(KEY_BUCKET).isin(touched))
        wrong = F.col(KEY_BUCKET) != _bucket(on, buckets)
        checked = there.withColumn(KEY_BUCKET, F.when(wrong, F.raise_error(F.lit(
            f"{table}: not stored in {buckets} buckets by {on}")).cast("int")).otherwise(F.col(KEY_BUCKET)))
        merged = replace_keys(checked, new, on).select(*old.columns)
        return self.replace_values(table, merged, KEY_BUCKET, {str(b) for b in touched})


def _bucket(on: list[str], buckets: int) -> Column:
    keys = [F.collate(fold_key(F.col(k).cast("string")), "UTF8_BINARY") for k in on]
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _bucketed(df: DataFrame, on: list[str], buckets: int) -> DataFrame:
    return df.withColumn(KEY_BUCKET, _bucket(on, buckets))


def with_month(df: DataFrame, key: str = "DateKey", name: str = "ym") -> DataFrame:
    """Partition column of a month aggregate: the first six characters of its date key."""
    return df.withColumn(name, F.left(F.col(key), F.lit(6)))


def with_load_day(df: DataFrame, stamp: str = "ETLLoadData", name: str = "etl_date") -> DataFrame:
    """Partition column of a fact replaced by load day."""
    return df.withColumn(name, F.date_format(stamp, "yyyy-MM-dd"))


def window_month(as_of: date, back: int) -> str:
    """``yyyyMM`` of the month ``back`` months before ``as_of``, as plain text."""
    months = as_of.year * 12 + as_of.month - 1 - back
    return f"{months // 12:04d}{months % 12 + 1:02d}"


__all__ = ["KEY_BUCKET", "NO_VALUE", "Mart", "window_month", "with_load_day", "with_month"]
