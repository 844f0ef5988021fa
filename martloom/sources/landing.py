"""Landed sheets: text-first reads with a declared schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom import schemas
from martloom.functions import parse_number


def _cell(name: str, kind: T.DataType):
    text = F.when(F.trim(F.col(name)) != "", F.col(name))
    if isinstance(kind, T.StringType):
        return text.alias(name)
    if isinstance(kind, (T.DateType, T.TimestampType)):
        return F.trim(text).try_cast(kind).alias(name)
    return parse_number(text, kind.simpleString()).alias(name)


def read_landing(
    spark: SparkSession, path: str, table: str, kind: str = "csv", bad_cells: str = "fail"
) -> DataFrame:
    """A landed sheet with the declared columns of ``table``.

    Cells are read as text, blanks become NULL, then each column is cast; a cell that does
    not parse fails the job, or becomes NULL with ``bad_cells="null"``. Short or long rows
    always fail.
    """
    target = schemas.schema(table)
    if kind == "csv":
        raw = spark.read.schema(schemas.schema(table, text_only=True)).csv(
            path, header=True, mode="FAILFAST", enforceSchema=False, multiLine=False, escape='"'
        )
    else:
        stored = spark.read.format(kind).load(path)
        raw = stored.select(*[F.col(f.name).cast("string").alias(f.name) for f in target.fields])
    cells = raw.select(*[_cell(f.name, f.dataType) for f in target.fields])
    if bad_cells == "null":
        return cells
    checked = []
    for f in target.fields:
        lost = _cell(f.name, T.StringType()).isNotNull() & _cell(f.name, f.dataType).isNull()
        message = F.concat(F.lit(f"bad cell in {f.name}: "), F.col(f.name))
        checked.append(F.when(lost, F.raise_error(message)).otherwise(_cell(f.name, f.dataType)).alias(f.name))
    return raw.select(*checked)


def split_landing(spark: SparkSession, path: str, table: str, kind: str = "csv") -> tuple[DataFrame, DataFrame]:
    """A landed sheet as (good rows with the declared columns, rejected cells): every landed row is in one of the two.

    A row with a cell that does not parse is rejected whole, with one line for each such cell: ``File``, ``Column``, ``Cell`` and
    ``Row``, the landed row as JSON text. A csv line with too few or too many cells is rejected once, with NULL as its column and
    the line as ``Row``; blank csv lines are no rows. Files lie in pieces over the cluster, so there is no line number.
    """
    target = schemas.schema(table)
    names, line = [f.name for f in target.fields], "_line"
    if kind == "csv":
        asked = T.StructType([*schemas.schema(table, text_only=True).fields, T.StructField(line, T.StringType())])
        raw = spark.read.schema(asked).csv(path, header=True, mode="PERMISSIVE", enforceSchema=False, multiLine=False,
                                           escape='"', columnNameOfCorruptRecord=line)
    else:
        raw = spark.read.format(kind).load(path).withColumn(line, F.lit(None).cast("string"))
    raw = raw.select(*[F.col(n).cast("string").alias(n) for n in names], line, F.col("_metadata.file_path").alias("_file"))
    bad = F.filter(F.array(*[
        F.when(F.col(line).isNotNull(), None).when(
            _cell(f.name, T.StringType()).isNotNull() & _cell(f.name, f.dataType).isNull(),
            F.struct(F.lit(f.name).alias("Column"), F.col(f.name).alias("Cell"))) for f in target.fields
    ]), lambda cell: cell.isNotNull())
    told = raw.withColumn("_bad", bad)
    good = told.filter(F.col(line).isNull() & (F.size("_bad") == 0)).select(*[_cell(f.name, f.dataType) for f in target.fields])
    row = F.coalesce(F.col(line), F.to_json(F.struct(*names), {"ignoreNullFields": "false"}))
    rejected = told.filter(F.col(line).isNotNull() | (F.size("_bad") > 0)).select(
        F.col("_file").alias("File"), row.alias("Row"), F.explode_outer("_bad").alias("_cell")).select(
        "File", "_cell.Column", "_cell.Cell", "Row")
    return good, rejected


def read_sheets(
    spark: SparkSession, root: str, sheets: list[str], table: str = "TargetSheet", kind: str = "csv"
) -> DataFrame:
    """Named sheets, one directory each, appended; ``Sheet`` tells where a row came from."""
    parts = [
        read_landing(spark, f"{root}/{name}", table, kind).withColumn("Sheet", F.lit(name)) for name in sheets
    ]
    return reduce(DataFrame.unionByName, parts)


def has_rows(df: DataFrame) -> bool:
    """Empty-input guard: stops at the first row found."""
    return not df.isEmpty()
