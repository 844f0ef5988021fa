
from __future__ import annotations

import pytest

from martloom.llm import decontaminate
from tests.llm.conftest import story
from tests.llm.test_tables import ITEM

WHOLE = decontaminate.Rule(whole=True)


def found(spark, items: list[str], texts: list[str], rule: decontaminate.Rule = WHOLE) -> set[int]:
    """Numbers of the texts that hold an item."""
    bench = spark.createDataFrame(list(enumerate(items)), "item_id BIGINT, text STRING")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    return set(range(len(texts))) - {r["doc_id"] for r in decontaminate.clean(docs, bench, rule).collect()}


SUM = "the small shop sold 12 red apples and then 7 green pears to one old man who paid for all of them at once"
TWICE = story(31, 12) + " about 40 of them " + story(32, 14) + " and again 40 more " + story(33, 12)


def test_values_agree_by_window(spark):
    texts = [SUM.replace("12", "5").replace("7", "5"), ITEM.replace("Boston", "Denver").replace("Maria", "Denver"),
             TWICE.replace("again 40", "again 41"), SUM.replace(" apples", ", apples").replace("12", "(12)"),
             story(34, 60)]
    assert found(spark, [SUM, ITEM, TWICE], texts) == {0, 1, 2, 3}
    assert found(spark, [SUM, ITEM, TWICE], texts, decontaminate.Rule()) == {0, 2, 3}  # two names become one


TOM = "Tom has 5 coins in a box. Tom gives 2 of these coins to a friend. Tom then puts the box back."


def test_case_and_blanks(spark):
    texts = [ITEM.lower(), ITEM.upper(), ITEM.title(), ITEM.replace(" ", "\n"), ITEM.replace(" ", "  "),
             ITEM.replace("Boston", "Denver").replace("Maria", "Olga").replace(" ", "\t"), TOM.replace("Tom", "Zoe"),
             story(35, 60)]
    assert found(spark, [ITEM, TOM], texts) == {0, 1, 2, 3, 4, 5, 6}


def test_shifted_words(spark):
    texts = [ITEM.replace("Boston", "New York").replace("Maria", "Maria Lopez"), ITEM.replace("120 km", "120km"),
             SUM.replace("to one", "yesterday to one"), ITEM.replace("Boston", "Rio").replace("120 km", "85km") + " " + ITEM,
             story(36, 60), "Word " * 100_000 + "1,2" * 100_000]
    items = [ITEM + " She pays 30 dollars for it.", SUM]
    assert found(spark, items, texts) == {0, 1, 2, 3}


def test_items_of_few_words(spark):
    items = ["What is 5 plus 7?", "4 5 6 7 8 9 10 11 12 13", "three tiny words", "1 + 2 + 3 + 4 + 5 + 6 + 7 + 8 + 9 is 45"]
    texts = [story(37, 9) + " what is 5 plus 7 " + story(38, 9), "so 4 5 6 7 8 9 10 11 12 13 it is", "Three, tiny words",
             items[3], "What is 6 plus 7?", "4 5 6 7 8 10 9 11 12 13", "three words", story(39, 60)]
    assert found(spark, items, texts) == {0, 1, 2, 3}


def test_texts_are_not_shuffled_to_find_the_few_that_are_read(spark, monkeypatch):
    """The keys of the texts asked for are a table by themselves, of a size that the planner knows."""
    items = [(i, " ".join(f"{w}{i}" for w in "the old river runs over seven green stones".split()) + f" near Town on {i} days "
              + " ".join(f"x{i}y{j}" for j in range(20))) for i in range(40)]
    docs = spark.createDataFrame([(i, f"start {t} end " + "filler " * 200) for i, t in items] * 2, "doc_id BIGINT, text STRING")
    benchmark = spark.createDataFrame(items, "item_id BIGINT, text STRING")
    plans, keep = {}, decontaminate.stored

    def noted(df, what):
        plans[what] = df._jdf.queryExecution().executedPlan().toString()
        return keep(df, what)
    monkeypatch.setattr(decontaminate, "stored", noted)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "5000")
    try:
        found = decontaminate.hits(docs, benchmark, decontaminate.Rule(whole=True))
        assert found.count() == 40
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    semi = [line for line in plans["slots"].splitlines() if "LeftSemi" in line]
    assert "placed-texts" in plans and len(semi) == 1 and "BroadcastHashJoin" in semi[0]
