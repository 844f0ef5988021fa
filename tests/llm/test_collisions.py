"""Texts made to collide under hashes by powers of one base; columns that bear the operators' own names."""

from __future__ import annotations

import hashlib

import pytest

from martloom.llm import common, decontaminate, mixing, near_dedup, passages, substrings
from tests.llm.conftest import story


def twins(order: int, a: str = "a", b: str = "b") -> tuple[str, str]:
    """Two texts of 2**order letters, of which every power sum agrees modulo 2**64 for a large order."""
    x, y = a, b
    for _ in range(order):
        x, y = x + y, y + x
    return x, y


def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING").repartition(3)


def test_passages_of_twin_words_differ(spark):
    x, y = twins(10)
    rest = " ".join(f"w{i}" for i in range(12))
    got = {r["id"]: r["n_removed"] for r in passages.dedup_digests(docs(spark, [f"{x} {rest}", f"{y} {rest}"])).collect()}
    assert got == {0: 0, 1: 0}
    again = passages.dedup_digests(docs(spark, [f"{x} {rest}", f"{y} {rest}", f"{x} {rest}"])).collect()
    assert {r["id"]: r["n_removed"] for r in again} == {0: 0, 1: 0, 2: 13}


def test_near_copies_of_twin_words_differ(spark):
    x, y = twins(10)
    got = {r["id"]: r["component_id"] for r in near_dedup.classes(docs(spark, [x, y, x])).collect()}
    assert got == {0: 0, 1: 1, 2: 0}


def test_substrings_of_twins_differ(spark):
    texts = []
    for i, (a, b) in enumerate(["ab", "cd", "xy", "ef", "gh"] * 4):
        x, y = twins(8, a, b)
        tail = "".join(chr(97 + (i * 7 + j * j) % 26) for j in range(144))
        texts += [x + tail, y + tail]
    seen, unique = {}, list(dict.fromkeys(texts))
    found = substrings.digests(docs(spark, unique), 400).collect()
    for i, t in enumerate(unique):
        for j in range(len(t) - 399):
            seen.setdefault(t[j: j + 400], []).append(i)
    assert all(len(v) == 1 for v in seen.values())
    assert {r["n_removed"] for r in found} == {0}
    assert {r["kept_sha256"] for r in found} == {hashlib.sha256(t.encode()).hexdigest() for t in unique}


@pytest.mark.parametrize("names", [["text_key", "_spans", "_domain", "_lang", "_source", "_h", "_made_0", "_MADE_1", "item", "cut"]])
def test_columns_may_bear_any_name(spark, names):
    passage = story(3, 60)
    rows = [(1, passage, "en", "s"), (2, story(4, 30) + " " + passage, "en", "s"), (3, story(5, 50), None, None)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, source STRING")
    for i, n in enumerate(names):
        from pyspark.sql import functions as F
        df = df.withColumn(n, F.lit(f"v{i}"))
    cut = passages.without_repeats(df)
    assert cut.columns == df.columns and {r["doc_id"]: r["text"] == t for r in cut.collect() for i, t, *_ in rows if i == r["doc_id"]} \
        == {1: True, 2: False, 3: True}
    bench = spark.createDataFrame([(1, passage)], "item_id BIGINT, text STRING")
    left = decontaminate.clean(df, bench, decontaminate.Rule(whole=True))
    assert left.columns == df.columns and {r["doc_id"] for r in left.collect()} == {3}
    mix = mixing.mixed(df, mixing.Recipe())
    assert mix.columns == [*df.columns, "copies"] and {r[names[0]] for r in mix.collect()} <= {"v0"}


def test_no_folder_of_one_machine_on_a_cluster(monkeypatch, spark):
    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda *_: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        common.shared_folder(Session())
