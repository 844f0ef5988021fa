"""The sample that languages are learned from."""

from __future__ import annotations

from martloom.llm import language_id


def test_every_language_is_sampled(spark):
    rows = [(i, "der hund und die katze gehen heim " * 40, "de") for i in range(3)]
    rows += [(10 + i, "the dog and the cat walk home again " * 40, "en") for i in range(3)] + [(20, "", "en"), (21, "", "fr")]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING")
    for seed in range(3):  # a share near 0: chance alone draws nothing
        model = language_id.train(df, sample_bytes=1, seed=seed)
        got = {r["doc_id"]: r["lang_pred"] for r in language_id.predict(df, model).filter("text <> ''").collect()}
        assert got == {i: lang for i, text, lang in rows if text}
