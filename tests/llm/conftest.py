from __future__ import annotations

import random

import duckdb
import pytest

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, score STRING, id STRING, h INT, copies STRING"


def story(seed: int, n: int, words: str = "the of and river stone walks over green hill under cold light again") -> str:
    """n words, mostly new ones, with sentence marks and line ends."""
    r = random.Random(seed)
    out = []
    for i in range(n):
        w = r.choice(words.split()) if r.random() < 0.3 else "".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(3, 9)))
        out.append(w + (".\n" if i % 17 == 16 else "," if i % 11 == 10 else "") + "")
    return " ".join(out)


def awkward_rows() -> list[tuple]:
    base, passage = story(1, 120), story(2, 90)
    near = base.split(" ")
    near[60] = "changed"
    # far text, copies, near copies, a shared passage, the same passage twice in one text, nulls, blanks, one word
    texts = [
        (10, base), (11, base), (12, " ".join(near)), (13, None), (14, ""), (15, " \n\t "), (16, "word"),
        (17, story(3, 40) + " " + passage + " " + story(4, 30)), (18, passage + " " + story(5, 50)),
        (19, passage + "\n" + passage), (20, "ÄÖÜ straße été mañana\x1c x \x85 y " + story(6, 30)), (21, story(7, 20_000)),
        (None, base), (None, None), (16, "word"), (22, "x " * 700), (23, "$$$ !!! 123 <|endoftext|> \U0001f600"),
        (5, " ".join(near)), (24, story(8, 12)), (25, story(8, 13)),
    ]
    return [(i, t, None if n % 5 == 4 else ("en", "de")[n % 2], None if n % 7 == 3 else f"s{n % 3}", None, "x", None, n, "c")
            for n, (i, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA).coalesce(2)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def duck():
    """Rows of a statement over the test tables of a folder."""
    def rows(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
        con = duckdb.connect()
        for t in ("documents", "embeddings", "benchmark", "labels", "conversations"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
        cur = con.execute(sql)
        return [d[0] for d in cur.description], cur.fetchall()
    return rows
