"""The language model's counts reach the driver as columns."""

from __future__ import annotations

import numpy as np

from martloom.llm import language_id


def test_counts_are_handed_over_as_columns(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    def refused(self):
        raise AssertionError("rows of the counts on the driver")
    docs = spark.createDataFrame(
        [(1, "the cat and the hat " * 4, "en"), (2, "der Hund und das Haus " * 4, "de"), (3, None, "fr"), (4, "", "xx")],
        "doc_id long, text string, lang string")
    monkeypatch.setattr(DataFrame, "toPandas", refused)
    model = language_id.train(docs)
    assert model.langs == ["de", "en", "xx"]
    told = {r["doc_id"]: r["lang_pred"] for r in language_id.predict(
        docs, model, text="text", names=("lang_pred", "score", "bits")).collect()}
    assert told[1] == "en" and told[2] == "de"
    assert all(np.isfinite(b).all() for b in model.gram_bits)
