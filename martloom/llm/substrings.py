"""Removal of repeated substrings of bytes, by hashes of windows picked by q-grams.

Strings of `length` bytes are equal when their 64-bit hashes are: there is no suffix order, no bucket identifiers are
sorted at later offsets, and equality is not confirmed on the bytes. Three things keep that small:

* Of the q-grams inside a string of `length` bytes, the smallest by hash (leftmost of equals) speaks for it. Equal strings have
  equal speakers at equal places, so only speakers are put into buckets: about two of `length` positions.
* A bucket is split once by a hash of the bytes up to half the length beside the speaker, on the side that every string of the
  stretch contains; a stretch alone in its refined bucket can repeat nowhere.
* Stretches of neighbouring strings with one speaker go as one: if the whole stretch has a twin, all its strings repeat.
  Only where a bucket holds different stretches are their strings told apart one by one.

Bucket identifiers are 64-bit hashes made from running sums, so an identifier of any length is put together from those of
its parts. A task keeps at most two stretches per bucket to ask about, whatever it holds of it: two different ones
already tell everyone to look closer. Questions and answers travel as in places.

Cases: null and empty texts have no bytes; texts shorter than `length` lose nothing; matches never cross texts; rows that
share an id or are copies of each other are separate places; null ids stay; very long texts are read whole; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.common import U64, byte_sums, bytes_key, mix, pieces, stored, table, text_bytes
from martloom.llm.places import (NO_ID, QUESTION, answered, chunk_name, covered, inflate, keyed, marked_spans, own_bin,
                                 pack, packed, question_batch, question_rows, text_table, unpack, with_spans)

Q = 32
CHUNK_BYTES = 8 << 20
PIECE_BYTES = 1 << 20
BIN_BYTES = 192 << 20
STRETCH = "bin INT, chunk STRING, contexts BINARY, wholes BINARY, lows BINARY, highs BINARY, codes BINARY, " \
          "ids BINARY, keys BINARY, starts BINARY"
RANGES = "id BIGINT, key BIGINT, marks ARRAY<INT>, asks ARRAY<INT>"
MARK, ASK = 1, 2


def smallest(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every `width` neighbours, by doubling."""
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[: len(x) - (width - have)], x[width - have:]) if width > have else x


def stretches(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """context, whole, low, high of every stretch: strings starting at low..high share a speaker and a side of it."""
    if len(data) < length:
        return (np.zeros(0, U64),) * 2 + (np.zeros(0, np.int64),) * 2
    sums = byte_sums(data)
    n = len(data) - Q + 1
    grams = bytes_key(sums, np.arange(n), np.arange(Q, n + Q))
    ranked = (grams & U64(0xFFFFFFFF00000000)) | np.arange(n, dtype=U64)
    speaker = (smallest(ranked, length - Q + 1) & U64(0xFFFFFFFF)).astype(np.int64)
    edge = np.zeros(len(data) + 1, np.int64)
    np.add.at(edge, np.maximum(offsets[1:] - length + 1, offsets[:-1]), 1)
    np.add.at(edge, offsets[1:], -1)
    inside = np.flatnonzero(np.cumsum(edge)[: len(speaker)] == 0)
    if not len(inside):
        return (np.zeros(0, U64),) * 2 + (np.zeros(0, np.int64),) * 2
    who = speaker[inside]
    half = (length - Q) // 2
    left = inside + half <= who  # the string reaches at least half to the left of its speaker
    new = np.ones(len(inside), bool)
    new[1:] = (np.diff(inside) != 1) | (np.diff(who) != 0) | (left[1:] != left[:-1])
    first = np.flatnonzero(new)
    low, high = inside[first], inside[np.append(first[1:], len(inside)) - 1]
    at, side = who[first], left[first]
    context = mix(bytes_key(sums, np.where(side, at - half, at), np.where(side, at + Q, at + Q + half)) ^ side.astype(U64))
    whole = mix(bytes_key(sums, low, high + length) ^ ((high - low).astype(U64) << U64(40))
                ^ ((at - low).astype(U64) << U64(20)))
    return context, whole, low, high


def told_apart(contexts: np.ndarray, wholes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """In order of context and whole: the order, first of its whole, how many share the whole, which whole of the context."""
    order = np.lexsort((wholes, contexts))
    c, w = contexts[order], wholes[order]
    bucket = np.ones(len(c), bool)
    bucket[1:] = c[1:] != c[:-1]
    kind = bucket.copy()
    kind[1:] |= w[1:] != w[:-1]
    number = np.cumsum(kind) - 1
    count = np.bincount(number, minlength=1)[number] if len(c) else number
    first_kind = np.maximum.accumulate(np.where(bucket, number, 0)) if len(c) else number
    return order, kind, count, number - first_kind


def several(contexts: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Whether the bucket of each entry (sorted) holds more than one whole."""
    bucket = np.ones(len(contexts), bool)
    bucket[1:] = contexts[1:] != contexts[:-1]
    number = np.cumsum(bucket) - 1
    most = np.zeros(number[-1] + 1 if len(number) else 0, np.int64)
    np.maximum.at(most, number, place)
    return most[number] > 0


def judge_stretches(contexts: np.ndarray, wholes: np.ndarray) -> np.ndarray:
    """MARK where a whole has a twin, ASK where its bucket holds other wholes."""
    order, _, count, place = told_apart(contexts, wholes)
    out = np.zeros(len(order), np.uint8)
    out[order] = np.where(count > 1, MARK, 0) | np.where(several(contexts[order], place), ASK, 0)
    return out


def ask_stretches(texts: DataFrame, length: int, bins: int) -> DataFrame:
    schema = pa.schema([("bin", pa.int32()), ("chunk", pa.string())] + [
        (c, pa.binary()) for c in ("contexts", "wholes", "lows", "highs", "codes", "ids", "keys", "starts")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n_bytes, n = [], 0, 0
        for part in pieces(batches, "text", PIECE_BYTES):
            data, offsets = text_bytes(part.column("text"))
            context, whole, low, high = stretches(data, offsets, length)
            ids = part.column("id").fill_null(NO_ID).to_numpy(zero_copy_only=False)
            held.append((context, whole, low + n_bytes, high + n_bytes, offsets[:-1] + n_bytes, ids,
                         part.column("key").to_numpy()))
            n_bytes += len(data)
            if n_bytes >= CHUNK_BYTES:
                yield settle(held, n)
                held, n_bytes, n = [], 0, n + 1
        if held:
            yield settle(held, n)

    def settle(held: list, n: int) -> pa.RecordBatch:
        context, whole, low, high, starts, ids, keys = (np.concatenate(x) for x in zip(*held))
        filled = np.flatnonzero(np.append(starts[1:] > starts[:-1], True))
        starts, ids, keys = starts[filled], ids[filled], keys[filled]
        order, first, count, place = told_apart(context, whole)
        context, whole, low, high = context[order], whole[order], low[order], high[order]
        code = np.where(count > 1, MARK, 0) | np.where(several(context, place) & first, ASK, 0)
        chunk, rows = chunk_name(n, ids, keys), []

        def row(bin_no: int, pick: np.ndarray, codes: np.ndarray, **more: bytes) -> None:
            rows.append({"bin": bin_no, "chunk": chunk, "contexts": pack(context[pick]), "wholes": pack(whole[pick]),
                         "lows": pack(low[pick].astype(np.uint32)), "highs": pack(high[pick].astype(np.uint32)),
                         "codes": pack(codes.astype(np.uint8)), **more})
        settled = np.flatnonzero(code)
        row(own_bin(chunk), settled, code[settled], ids=pack(ids), keys=pack(keys), starts=pack(starts.astype(np.int64)))
        sent = np.flatnonzero(first & (place < 2))
        to = (mix(context[sent]) % U64(bins)).astype(np.int64)
        by = np.argsort(to, kind="stable")
        cuts = np.flatnonzero(np.diff(to[by], prepend=-1)).tolist() + [len(by)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            row(int(to[by[a]]), sent[by[a:b]], np.zeros(b - a))
        return pa.RecordBatch.from_pylist(rows, schema=schema)
    return texts.mapInArrow(run, STRETCH)


def answer_stretches(questions: DataFrame) -> DataFrame:
    """The rows that have something to say, with their codes filled in."""
    def run(part: pd.DataFrame) -> pd.DataFrame:
        if part["bin"].iloc[0] < 0:
            return part
        both = [(unpack(c, U64), unpack(w, U64)) for c, w in zip(part["contexts"], part["wholes"])]
        code = judge_stretches(*(np.concatenate(x) for x in zip(*both)))
        ends = np.cumsum([len(c) for c, _ in both])
        part["codes"] = [pack(x) for x in np.split(code, ends[:-1])]
        return part
    return questions.groupBy("bin").applyInPandas(run, STRETCH).drop("contexts", "wholes")


def ranges(answers: DataFrame, length: int) -> DataFrame:
    """Per text: bytes marked and string starts to be told apart, both as start, end, ..."""
    def run(part: pd.DataFrame) -> pd.DataFrame:
        ids, keys, starts = text_table(part)
        out: dict[int, tuple[list, list]] = {}
        for row in part.itertuples():
            code = unpack(row.codes, np.uint8)
            some = np.flatnonzero(code)
            low = unpack(row.lows, np.uint32).astype(np.int64)[some]
            high = unpack(row.highs, np.uint32).astype(np.int64)[some]
            text = np.searchsorted(starts, low, "right") - 1
            low, high = low - starts[text], high - starts[text]
            for t, a, b, c in zip(text.tolist(), low.tolist(), high.tolist(), code[some].tolist()):
                marks, asks = out.setdefault(t, ([], []))
                if c & MARK:
                    marks += (a, b + length)
                if c & ASK:
                    asks += (a, b + 1)
        return pd.DataFrame([(None if ids[t] == NO_ID else int(ids[t]), int(keys[t]), m, a) for t, (m, a) in out.items()],
                            columns=["id", "key", "marks", "asks"])
    return answers.groupBy("chunk").applyInPandas(run, RANGES)


def ask_strings(texts: DataFrame, length: int, bins: int) -> DataFrame:
    """Questions about single strings. texts: id, key, blob, asks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n_bytes, n = [], 0, 0
        for batch in batches:
            for i, key, blob, asks in zip(*(batch.column(c) for c in ("id", "key", "blob", "asks"))):
                data = np.frombuffer(inflate(blob.as_py()), np.uint8)
                pick = np.flatnonzero(covered(len(data), asks.as_py()))
                sums = byte_sums(data)
                held.append((bytes_key(sums, pick, pick + length), pick + n_bytes, np.array([n_bytes]),
                             np.array([NO_ID if i.as_py() is None else i.as_py()]), np.array([key.as_py()])))
                n_bytes += len(data)
                if n_bytes >= CHUNK_BYTES:
                    yield settle(held, n)
                    held, n_bytes, n = [], 0, n + 1
        if held:
            yield settle(held, n)

    def settle(held: list, n: int) -> pa.RecordBatch:
        hashes, at, starts, ids, keys = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(hashes, kind="stable")
        h, at = hashes[order], at[order]
        first = np.ones(len(h), bool)
        first[1:] = h[1:] != h[:-1]
        twin = ~first
        twin[:-1] |= ~first[1:]
        sure = np.sort(at[twin])
        h, at = h[first], at[first]
        to = (mix(h) % U64(bins)).astype(np.int64)
        by = np.argsort(to, kind="stable")
        return question_batch(question_rows(to[by], at[by], h[by], ids, keys, starts, chunk_name(n, ids, keys), sure))
    return texts.mapInArrow(run, QUESTION)


def stands_twice(hashes: np.ndarray, ids: np.ndarray) -> np.ndarray:
    order = np.argsort(hashes, kind="stable")
    same = hashes[order][1:] == hashes[order][:-1]
    out = np.zeros(len(order), bool)
    out[order[1:]] |= same
    out[order[:-1]] |= same
    return out


def repeats(texts: DataFrame, length: int) -> DataFrame:
    """id, key, spans of bytes covered by a string of `length` bytes that stands somewhere else too. texts: id, key, text."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bins = max(16, -(-size // BIN_BYTES))
    found = stored(ranges(answer_stretches(ask_stretches(texts, length, bins)), length), "stretches")
    asks = found.filter(F.size("asks") > 0).groupBy(F.col("id").alias("_id"), F.col("key").alias("_key")).agg(
        F.flatten(F.collect_list("asks")).alias("asks"))
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key"))
    closer = packed(texts).join(asks, same).select("id", "key", "blob", "asks")
    single = marked_spans(answered(ask_strings(closer, length, bins * 4), stands_twice), length)
    return found.filter(F.size("marks") > 0).select("id", "key", F.col("marks").alias("spans")).unionByName(single)


def op7_repeated_substrings(spark: SparkSession, sf_dir: str, length: int = 400) -> DataFrame:
    """All documents, strings of 400 bytes."""
    return digests(table(spark, sf_dir, "documents"), length)


def digests(docs: DataFrame, length: int, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    texts = keyed(docs, key, text)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            n, gone, runs, digest = [], [], [], []
            for blob, spans in zip(part.column("blob"), part.column("spans")):
                raw, spans = inflate(blob.as_py()), spans.as_py()
                drop = covered(len(raw), spans)
                kept = raw if not spans else np.frombuffer(raw, np.uint8)[~drop].tobytes()
                n.append(len(raw))
                gone.append(int(drop.sum()))
                runs.append(int((drop & ~np.append(False, drop[:-1])).sum()) if len(raw) else 0)
                digest.append(hashlib.sha256(kept).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(runs, pa.int64()),
                 pa.array(digest, pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    return with_spans(texts, repeats(texts, length)).mapInArrow(
        read, "doc_id BIGINT, n_bytes BIGINT, n_removed BIGINT, n_spans BIGINT, kept_sha256 STRING")
