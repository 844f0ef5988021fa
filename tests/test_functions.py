from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from checks.roles import TEST_RULES
from martloom.functions import (
    collate_text, concat_blank, date_key, day_window, divide, fold_key, month_start, month_window, next_month,
    parse_number, trimmed, ym, ym_back,
)
from martloom.plans import volume
from martloom.rules import DEFAULT_RULES
from martloom.sinks.store import window_month
from tests import traps


def one(spark, expr, **values):
    columns = ", ".join(f"{v} AS {k}" for k, v in values.items()) or "1 AS one"
    return spark.sql(f"SELECT {columns}").select(expr.alias("v")).first()["v"]


def test_concat_reads_null_as_blank(spark):
    assert one(spark, concat_blank(F.col("a"), F.col("b")), a="'x'", b="CAST(NULL AS STRING)") == "x"


@pytest.mark.parametrize("key,expected", [("202412", "202501"), ("202401", "202402"), ("202411", "202412")])
def test_next_month(spark, key, expected):
    assert one(spark, next_month(F.lit(key))) == expected


@pytest.mark.parametrize("back,expected", [(0, "202503"), (2, "202501"), (3, "202412"), (5, "202410")])
def test_months_back(spark, back, expected):
    as_of = date(2025, 3, 31)
    assert one(spark, ym_back(as_of, back)) == expected == window_month(as_of, back)
    assert one(spark, month_start(as_of, back)).day == 1


def test_keys(spark):
    assert one(spark, ym(F.col("d")), d="DATE'2024-01-31'") == "202401"
    assert one(spark, date_key(F.col("d")), d="TIMESTAMP'2024-01-31 23:59:59'") == "20240131"
    assert one(spark, month_window(F.lit("202001"), date(2025, 1, 1), None)) is True
    assert one(spark, day_window(F.col("d"), date(2024, 2, 5), 5), d="TIMESTAMP'2024-01-31 00:00:00'") is True
    assert one(spark, day_window(F.col("d"), date(2024, 2, 5), 5), d="TIMESTAMP'2024-01-30 23:00:00'") is False


def test_divide(spark):
    zero = {"a": "CAST(7 AS DECIMAL(18,4))", "b": "CAST(0 AS DECIMAL(18,4))"}
    assert one(spark, divide(F.col("a"), F.col("b")), **zero) is None
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        one(spark, divide(F.col("a"), F.col("b"), strict=True), **zero)
    assert float(one(spark, divide(F.col("a"), F.lit(2)), a="CAST(7 AS DECIMAL(18,4))")) == 3.5


@pytest.mark.parametrize("text,number", [("12.5", 12.5), (" 7 ", 7.0), ("n/a", None), ("", None)])
def test_parse_number(spark, text, number):
    assert one(spark, parse_number(F.lit(text))) == number


def test_text(spark):
    assert one(spark, trimmed(F.lit(12))) == "12"
    assert one(spark, fold_key(F.lit("Est  "))) == one(spark, fold_key(F.lit("eST")))


def test_bucket(spark):
    got = spark.createDataFrame([("Est",), ("est",), (None,), ("Oishi Green Tea",)], "b string").select(
        DEFAULT_RULES.bucket(F.col("b")).alias("v")).collect()
    assert [r["v"] for r in got] == ["Est", "Other Brand", "Other Brand", "Oishi Green Tea"]


def test_collated_mart_ignores_case_and_trailing_blanks(spark):
    """The same job on messy spellings of collated tables equals the job on clean spellings."""
    tables = traps.rows(5)
    def mess(v, n):
        if not isinstance(v, str) or not v or v[0].isdigit():
            return v
        return [v.upper(), v.lower(), v + "  "][n % 3]
    messy = {
        name: [tuple(mess(v, i + j) for j, v in enumerate(row)) for i, row in enumerate(data)]
        for name, data in tables.items()
    }
    def total(source, wrap):
        t = {k: wrap(v) for k, v in traps.frames(spark, source).items()}
        df = volume.volume_by_brand(
            t["f_invoice"], t["d_reason"], t["d_customer"], t["d_material"], months=None, rules=TEST_RULES)
        df = df.withColumns({
            f.name: F.lower(F.rtrim(F.collate(F.col(f.name), "UTF8_BINARY")))
            for f in df.schema.fields if f.dataType.typeName() == "string"})
        return traps.canonical([tuple(r) for r in df.collect()], df.columns)
    clean = total({k: [tuple(v.lower() if isinstance(v, str) else v for v in r) for r in d]
                   for k, d in tables.items()}, collate_text)
    assert clean and total(messy, collate_text) == clean
