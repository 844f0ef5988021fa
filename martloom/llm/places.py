"""Asking where a string stands again: packed questions to groups, packed answers back to texts.

A task hashes the strings of its texts, asks about each distinct hash once per group, and gets back the places to mark.
Questions and answers travel as sorted arrays in a few rows, so a shuffle moves little more than the hashes. A string
that a third of all texts share is one question per task. Chunks are named by what they hold, so a task that runs
again after a loss asks the same questions; the texts must come from a stored table, whose tasks read the same rows
each time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import U64

NO_ID = np.iinfo(np.int64).max
QUESTION = "bin INT, chunk STRING, hashes BINARY, at BINARY, ids BINARY, keys BINARY, starts BINARY"
ANSWER = "chunk STRING, at BINARY, ids BINARY, keys BINARY, starts BINARY"
SPANS = "id BIGINT, key BIGINT, spans ARRAY<INT>"


def pack(x: np.ndarray) -> bytes:
    """Bytes of equal rank together, compressed: sorted or small numbers then take little room."""
    return deflate(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes())


def unpack(b: bytes, kind) -> np.ndarray:
    size, b = np.dtype(kind).itemsize, inflate(b)
    n = len(b) // size
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(size, n).T).view(kind).reshape(n)


def deflate(b: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b)


def inflate(b: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(b)


def keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """id, key, text: a text is known by its id and a hash of itself, so that repeated ids do not mix."""
    content = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(key).cast("long").alias("id"), F.xxhash64(content).alias("key"), content.alias("text"))


def chunk_name(n: int, ids: np.ndarray, keys: np.ndarray) -> str:
    """The same name for the same texts, so that a task that runs again asks under the names it had."""
    part = TaskContext.get().partitionId()
    return f"{part}-{n}-{hashlib.blake2b(ids.tobytes() + keys.tobytes(), digest_size=8).hexdigest()}"


def own_bin(chunk: str) -> int:
    """A bin for the row of a chunk that is no question."""
    return -1 - int(chunk[-6:], 16)


def question_rows(bins, at, hashes, ids, keys, starts, chunk: str, sure: np.ndarray) -> Iterator[dict]:
    """Rows of one chunk. bins, at, hashes: questions in order of bin and hash; sure: places marked already.

    Questions name the ids of their texts; the row that is no question holds the table of texts.
    """
    yield {"bin": own_bin(chunk), "chunk": chunk, "hashes": None, "at": pack(sure.astype(np.uint32)),
           "ids": pack(ids), "keys": pack(keys), "starts": pack(starts.astype(np.int64))}
    cuts = np.flatnonzero(np.diff(bins, prepend=-1)).tolist() + [len(bins)]
    for a, b in zip(cuts[:-1], cuts[1:]):
        places = at[a:b]
        which = np.unique(np.searchsorted(starts, places, "right") - 1)
        yield {"bin": int(bins[a]), "chunk": chunk, "hashes": pack(hashes[a:b]), "at": pack(places.astype(np.uint32)),
               "ids": pack(ids[which]), "keys": None, "starts": pack(starts[which].astype(np.int64))}


def question_batch(rows: Iterator[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(list(rows), schema=pa.schema(
        [("bin", pa.int32()), ("chunk", pa.string())]
        + [(c, pa.binary()) for c in ("hashes", "at", "ids", "keys", "starts")]))


def answered(questions: DataFrame, judge) -> DataFrame:
    """Answers of all groups. judge(hashes, ids) -> which are marked."""
    def run(part: pd.DataFrame) -> pd.DataFrame:
        told = part[part["hashes"].isna()][["chunk", "at", "ids", "keys", "starts"]]
        asked = part[part["hashes"].notna()]
        if not len(asked):
            return told
        hashes, ids, at = [], [], []
        for row in asked.itertuples():
            places = unpack(row.at, np.uint32)
            text = np.searchsorted(unpack(row.starts, np.int64), places, "right") - 1
            hashes.append(unpack(row.hashes, U64))
            ids.append(unpack(row.ids, np.int64)[text])
            at.append(places)
        ends = np.cumsum([len(x) for x in at])
        marked = np.split(judge(np.concatenate(hashes), np.concatenate(ids)), ends[:-1])
        out = [(c, pack(x[m]), None, None, None) for c, x, m in zip(asked["chunk"], at, marked) if m.any()]
        return pd.concat([told, pd.DataFrame(out, columns=told.columns)])
    return questions.groupBy("bin").applyInPandas(run, ANSWER)


def text_table(part: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ids, keys and starts of the texts of a chunk."""
    have = part[part["keys"].notna()]
    if not len(have):
        raise RuntimeError("answers without their texts: the input changed between two runs of a task")
    row = have.iloc[0]
    return unpack(row["ids"], np.int64), unpack(row["keys"], np.int64), unpack(row["starts"], np.int64)


def marked_spans(answers: DataFrame, width: int) -> DataFrame:
    """id, key, spans (start, end, start, end, ...) of every text with marked places; a place covers `width` units."""
    def run(part: pd.DataFrame) -> pd.DataFrame:
        ids, keys, starts = text_table(part)
        at = np.unique(np.concatenate([unpack(x, np.uint32) for x in part["at"]])).astype(np.int64)
        text = np.searchsorted(starts, at, "right") - 1
        # Places nearer than the width make one run; runs end at a change of text.
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] - at[:-1] > width) | (text[1:] != text[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(at)) - 1
        spans: dict[int, list] = {}
        for t, a, b in zip(text[first].tolist(), at[first].tolist(), at[last].tolist() if len(at) else []):
            s = int(starts[t])
            spans.setdefault(t, []).extend((a - s, b - s + width))
        return pd.DataFrame([(None if ids[t] == NO_ID else int(ids[t]), int(keys[t]), x) for t, x in spans.items()],
                            columns=["id", "key", "spans"])
    return answers.groupBy("chunk").applyInPandas(run, SPANS)


def packed(texts: DataFrame) -> DataFrame:
    """id, key and the compressed text: a join moves about half of what plain text takes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = [deflate(t.encode()) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("key"), pa.array(blobs, pa.binary())],
                                             ["id", "key", "blob"])
    return texts.mapInArrow(run, "id BIGINT, key BIGINT, blob BINARY")


def with_spans(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """id, blob (see packed) and the marked spans of every text, null if it has none."""
    lists = spans.groupBy("id", "key").agg(F.flatten(F.collect_list("spans")).alias("spans")) \
        .withColumnRenamed("id", "_id").withColumnRenamed("key", "_key")
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key"))
    return packed(texts).join(lists, same, "left").select("id", "blob", "spans")


def covered(n: int, spans: list[int] | None) -> np.ndarray:
    """Which of n units lie in a span."""
    if not spans:
        return np.zeros(n, bool)
    edge = np.zeros(n + 1, np.int64)
    both = np.asarray(spans).reshape(-1, 2)
    np.add.at(edge, both[:, 0], 1)
    np.add.at(edge, both[:, 1], -1)
    return np.cumsum(edge)[:n] > 0
