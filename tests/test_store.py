from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from martloom.functions import collate_text
from martloom.operators import replace_keys
from martloom.sinks import Mart


@pytest.fixture
def mart(spark, tmp_path):
    return Mart(spark, str(tmp_path / "mart"))


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, v string, ym string")


def held(mart, table="t"):
    return sorted((r["ym"], r["k"], r["v"]) for r in mart.read(table).select("ym", "k", "v").collect())


def files(mart, ym):
    return sorted(os.listdir(f"{mart.path('t')}/ym={ym}"))


OLD = [("a", "1", "202401"), ("b", "1", "202402"), ("c", "1", "202403")]


def test_window_replace(spark, mart):
    assert mart.append("t", frame(spark, OLD), "ym") == 3
    before = files(mart, "202401")
    late = frame(spark, [("c", "2", "202403"), ("d", "2", "202403")])
    # 202402 became empty, 202401 is outside the window and must not change.
    assert mart.replace_window("t", late, "ym", "202402") == 2
    expected = [("202401", "a", "1"), ("202403", "c", "2"), ("202403", "d", "2")]
    assert held(mart) == expected and files(mart, "202401") == before
    mart.replace_window("t", late, "ym", "202402")
    assert held(mart) == expected


def test_window_replace_creates_the_table(spark, mart):
    mart.replace_window("t", frame(spark, OLD), "ym", "202401")
    assert [r[0] for r in held(mart)] == ["202401", "202402", "202403"]


@pytest.mark.parametrize("ym", ["202401", None])
def test_a_row_outside_the_window_fails_and_changes_nothing(spark, mart, ym):
    mart.append("t", frame(spark, OLD), "ym")
    with pytest.raises(Exception, match="outside the window"):
        mart.replace_window("t", frame(spark, [("c", "2", "202403"), ("late", "2", ym)]), "ym", "202402")
    assert held(mart) == sorted((ym, k, v) for k, v, ym in OLD)


def test_frame_and_store_forms_agree_on_keys(spark, mart):
    """Stored rows without a key stay, whatever comes in."""
    old = frame(spark, [("keep-me", "1", None), ("b", "1", "202402"), ("c", "1", "202403")])
    for rows in ([("new", "2", None), ("x", "2", "202402")], [("y", "3", "202403")], [("z", "4", None)]):
        new = frame(spark, rows)
        want = replace_keys(old, new, ["ym"])
        mart.overwrite("t", old, "ym")
        mart.replace_partitions("t", new, "ym")
        kept = sorted(map(str, ((r["k"], r["v"], r["ym"]) for r in mart.read("t").collect())))
        assert kept == sorted(map(str, ((r["k"], r["v"], r["ym"]) for r in want.collect())))


def test_read_gives_declared_types_and_order(spark, mart):
    rows = spark.createDataFrame([("r", "b", "s", "t", "d", 202401)], "Route string, BranchVL string, SalesMan string, "
                                 "TDM string, DM string, YM int")
    mart.replace_partitions("FactRouteSalesman", rows, "YM")
    back = mart.read("FactRouteSalesman")
    assert dict(back.dtypes)["YM"] == "int" and back.columns == rows.columns and back.collect() == rows.collect()


def test_collated_rows_can_be_stored(spark, mart):
    rows = collate_text(frame(spark, OLD))
    mart.overwrite("t", rows, "ym")
    mart.replace_window("t", rows.filter("ym = '202403'"), "ym", "202403")
    assert len(held(mart)) == 3


def test_window_in_the_second_partition_column(spark, mart):
    schema = "k string, YM string, etl_date string"
    rows = spark.createDataFrame([("a", "202401", "2024-02-01"), ("b", "202401", "2024-02-05"), ("c", None, "2024-02-06")], schema)
    mart.append("d", rows, ("YM", "etl_date"))
    new = spark.createDataFrame([("B", "202402", "2024-02-05")], schema)
    mart.replace_window("d", new, ("YM", "etl_date"), "2024-02-03")
    assert sorted(r["k"] for r in mart.read("d").collect()) == ["B", "a"]


def test_key_set_replace_by_partition(spark, mart):
    mart.append("t", frame(spark, OLD), "ym")
    landing = frame(spark, [("n", "3", "202402"), ("n", "3", "202405")])
    for _ in range(2):
        mart.replace_partitions("t", landing, "ym")
        assert held(mart) == [("202401", "a", "1"), ("202402", "n", "3"), ("202403", "c", "1"), ("202405", "n", "3")]


def test_key_set_replace_without_partitions(spark, mart):
    mart.append("t", frame(spark, OLD))
    mart.replace_by_keys("t", frame(spark, [("b", "9", "202402"), ("x", "9", "202409")]), ["ym"])
    assert held(mart) == [("202401", "a", "1"), ("202402", "b", "9"), ("202403", "c", "1"), ("202409", "x", "9")]


def bucket_files(mart):
    return {d: sorted(os.listdir(f"{mart.path('t')}/{d}")) for d in os.listdir(mart.path("t")) if d.startswith("key_bucket=")}


def test_key_buckets_leave_other_buckets_alone(spark, mart):
    old = frame(spark, [(f"k{i}", str(i), f"m{i % 40}") for i in range(400)] + [("none", "0", None)])
    mart.overwrite_in_buckets("t", old, ["ym"], 16)
    assert mart.read("t").columns == ["k", "v", "ym"] and len(bucket_files(mart)) > 8
    for rows in ([("n", "1", "m3"), ("n", "2", "m3"), ("n", "3", "new")], [("x", "9", None)], [("y", "8", "m7")]):
        new, before = frame(spark, rows), bucket_files(mart)
        want = replace_keys(mart.read("t"), new, ["ym"]).select("k", "v", "ym").collect()
        mart.replace_by_keys("t", new, ["ym"], buckets=16)
        assert sorted(map(str, mart.read("t").collect())) == sorted(map(str, want))
        after = bucket_files(mart)
        assert 1 <= sum(before.get(d) != after.get(d) for d in before.keys() | after.keys()) <= 2
    before = bucket_files(mart)
    assert mart.replace_by_keys("t", frame(spark, []), ["ym"], buckets=16) == 0 and bucket_files(mart) == before
    with pytest.raises(Exception, match="not stored in 7 buckets"):
        mart.replace_by_keys("t", frame(spark, [(f"a{i}", "1", f"m{i}") for i in range(9)]), ["ym"], buckets=7)
    assert bucket_files(mart) == before


def test_a_table_moves_into_buckets(spark, mart):
    mart.append("t", frame(spark, OLD))
    for _ in range(2):
        mart.replace_by_keys("t", frame(spark, [("b", "9", "202402"), ("x", "9", "202409")]), ["ym"], buckets=4)
        assert held(mart) == [("202401", "a", "1"), ("202402", "b", "9"), ("202403", "c", "1"), ("202409", "x", "9")]
    assert bucket_files(mart)


def test_keys_that_compare_as_equal_share_a_bucket(spark, mart):
    mart.overwrite_in_buckets("t", collate_text(frame(spark, [("a", "1", "North"), ("b", "1", "South")])), ["ym"], 64)
    mart.replace_by_keys("t", collate_text(frame(spark, [("c", "2", "NORTH ")])), ["ym"], buckets=64)
    assert sorted(r["k"] for r in mart.read("t").collect()) == ["b", "c"]


def test_full_refresh_may_read_its_own_table(spark, mart):
    mart.overwrite("t", frame(spark, OLD), "ym")
    mart.overwrite("t", mart.read("t").filter("k <> 'a'"), "ym")
    assert [r[1] for r in held(mart)] == ["b", "c"]


def failing(spark):
    return frame(spark, OLD).withColumn("v", F.when(F.col("k") == "b", F.raise_error(F.lit("boom"))).otherwise("9"))


@pytest.mark.parametrize("write", [
    lambda m, df: m.overwrite("t", df, "ym"),
    lambda m, df: m.replace_window("t", df, "ym", "202401"),
    lambda m, df: m.replace_partitions("t", df, "ym"),
])
def test_failed_write_leaves_the_old_rows(spark, mart, write):
    mart.overwrite("t", frame(spark, OLD), "ym")
    with pytest.raises(Exception, match="boom"):
        write(mart, failing(spark))
    assert held(mart) == sorted((ym, k, v) for k, v, ym in OLD)


def test_crash_between_renames_is_repaired(spark, mart):
    mart.overwrite("t", frame(spark, OLD), "ym")
    os.rename(mart.path("t"), f"{mart.root}/_t.old")
    assert len(held(mart)) == 3  # readable meanwhile
    mart.overwrite("t", frame(spark, OLD[:1]), "ym")
    assert [r[1] for r in held(mart)] == ["a"]


def test_day_partitions(spark, mart):
    rows = spark.createDataFrame([("a", "2024-02-01"), ("b", "2024-02-05")], "k string, etl_date string")
    mart.append("d", rows, "etl_date")
    mart.replace_window("d", rows.filter("k = 'b'").withColumn("k", F.lit("B")), "etl_date", "2024-02-03")
    assert sorted(r["k"] for r in mart.read("d").collect()) == ["B", "a"]
