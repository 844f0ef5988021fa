"""The language stage of the pipeline: what it keeps without a model, and what its learned bound rejects."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from martloom.llm import language_id
from martloom.llm.common import held_out, table
from tests.llm.conftest import awkward_rows


def test_without_labels_texts_with_a_letter_stay(spark, awkward):
    plain = awkward.withColumn("lang", F.lit(None).cast("string"))
    model = language_id.train(plain)
    assert model is None
    kept = language_id.keep_known(plain, model)
    lettered = {n for n, r in enumerate(awkward_rows()) if r[1] is not None and any(c.isalpha() for c in r[1])}
    assert kept.columns == plain.columns and {r["h"] for r in kept.collect()} == lettered and len(lettered) > 10


def test_the_learned_bound_rejects_noise_and_keeps_clean_texts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs.filter(~held_out(F.col("doc_id"))))
    clean = docs.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    assert language_id.keep_known(clean, model).count() == clean.count() > 100
    r = random.Random(1)
    noise = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz0123456789 ") for _ in range(3000)), "привет как дела " * 80]
    short = ["Qwzx Vbkj 77", "Ångström-Øre"]  # names and numbers that training has not seen, too short to tell
    rows = spark.createDataFrame([(i, t, "s") for i, t in enumerate(noise + short)], "doc_id BIGINT, text STRING, lang STRING")
    assert {x["doc_id"] for x in language_id.keep_known(rows, model).collect()} == {2, 3}
