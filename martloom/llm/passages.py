"""Removal of repeated passages, by hashes of word windows.

Every word starts a window of `depth` words, and windows are equal when their 64-bit hashes are (keyed cryptographic hashes of the
words, mixed one after another): no suffix tree is built, no suffixes are sorted, and equality is not confirmed on the words. The smallest document that holds a window keeps its words;
the others lose them. Neighbouring windows that are marked together make the maximal repeats, which are returned as spans.

Counting passes over fixed slots of 1-, 2-, 4-, ... word prefixes show how many windows share a prefix; a window goes to the bin
of its shortest prefix that fits in memory. Prefixes only choose the bin. A task settles what it can see alone and asks
about the rest (see places).

Cases: null and empty texts have no words; texts shorter than the window lose nothing; a null id counts as larger than all
others; rows that share an id are no smaller documents to each other, and keep or lose by their own text; very long texts
are read whole; an empty table gives an empty result; extra columns are ignored, or kept by `without_repeats`.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.llm.common import U64, free_names, mix, pieces, run_keys, table, text_bytes, word_keys, words
from martloom.llm.places import (NO_ID, QUESTION, answered, chunk_name, covered, inflate, keyed, marked_spans,
                                 question_batch, question_rows, with_spans)

GROUP_SUFFIXES = 1_200_000
CHUNK_WORDS = 2_000_000
PIECE_BYTES = 1 << 20


def levels(depth: int) -> list[int]:
    """Prefix lengths tried, up to the whole window."""
    return [p for p in (1, 2, 4, 8) if p < depth] + [depth]


def suffixes(texts: pa.Array, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of all words, first word of each text, and the words that start a whole window."""
    data, offsets = text_bytes(texts)
    starts, ends, first = words(data, offsets)
    keys = word_keys(data, starts, ends)
    whole = np.ones(len(starts), bool)
    edge = np.zeros(len(starts) + 1, np.int64)
    np.add.at(edge, np.maximum(first[1:] - depth + 1, first[:-1]), 1)
    np.add.at(edge, first[1:], -1)
    whole = np.cumsum(edge)[:-1] == 0
    return keys, first, np.flatnonzero(whole)


def prefix(keys: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    return run_keys(keys, at, length)


def full_slots(texts: DataFrame, depth: int, slots: int) -> list[np.ndarray]:
    """For every prefix length, the slots whose prefixes open more suffixes than a group may hold."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(levels(depth)), slots), np.int64)
        for part in pieces(batches, "text", PIECE_BYTES):
            keys, _, at = suffixes(part.column("text"), depth)
            for i, p in enumerate(levels(depth)[:-1]):
                total[i] += np.bincount((prefix(keys, at, p) % U64(slots)).astype(np.int64), minlength=slots)
        level, slot = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(level.astype(np.int32)), pa.array(slot.astype(np.int64)),
                                          pa.array(total[level, slot])], ["level", "slot", "n"])
    counted = texts.select("text").mapInArrow(count, "level INT, slot BIGINT, n BIGINT") \
        .groupBy("level", "slot").agg(F.sum("n").alias("n")).filter(F.col("n") > GROUP_SUFFIXES)
    out = [np.zeros(slots, bool) for _ in levels(depth)]
    for row in counted.collect():  # at most suffixes / GROUP_SUFFIXES a level
        out[row["level"]][row["slot"]] = True
    return out


def bins_of(keys: np.ndarray, at: np.ndarray, depth: int, full: list[np.ndarray], bins: int) -> np.ndarray:
    """The bin of every suffix: that of its group, the shortest prefix whose slot is not full."""
    out = np.zeros(len(at), np.int64)
    left = np.arange(len(at))
    for i, p in enumerate(levels(depth)):
        slot = (prefix(keys, at[left], p) % U64(len(full[i]))).astype(np.int64)
        fits = ~full[i][slot] if p < depth else np.ones(len(left), bool)
        group = mix(slot[fits].astype(U64) + U64(i * len(full[i])))
        out[left[fits]] = (group % U64(bins)).astype(np.int64)
        left = left[~fits]
        if not len(left):
            break
    return out


def repeats(texts: DataFrame, depth: int) -> DataFrame:
    """id, key, spans of words that a document with a smaller id has too, in windows of `depth` words."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bins = max(16, -(-size // (6 * GROUP_SUFFIXES)))  # about a word in six bytes
    slots = 1 << max(10, (8 * bins - 1).bit_length())
    shared = texts.sparkSession.sparkContext.broadcast(full_slots(texts, depth, slots))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full, held, n_words, n = shared.value, [], 0, 0
        for part in pieces(batches, "text", PIECE_BYTES):
            words_, first, at = suffixes(part.column("text"), depth)
            ids = part.column("id").fill_null(NO_ID).to_numpy(zero_copy_only=False)
            held.append((prefix(words_, at, depth), bins_of(words_, at, depth, full, bins).astype(np.uint32),
                         (at + n_words).astype(np.uint32), first[:-1] + n_words, ids, part.column("key").to_numpy()))
            n_words += len(words_)
            if n_words >= CHUNK_WORDS:
                yield settle(held, n)
                n_words, n = 0, n + 1
        if held:
            yield settle(held, n)

    def settle(held: list, n: int) -> pa.RecordBatch:
        hashes, bin_no, at, starts, ids, keys = (np.concatenate(x) for x in zip(*held))
        held.clear()
        filled = np.flatnonzero(np.append(starts[1:] > starts[:-1], True))  # of empty texts at one place, the last
        starts, ids, keys = starts[filled], ids[filled], keys[filled]
        marked = smaller_elsewhere(hashes, ids[np.searchsorted(starts, at, "right") - 1])
        sure = np.sort(at[marked])
        hashes, bin_no, at = hashes[~marked], bin_no[~marked], at[~marked]
        order = np.lexsort((hashes, bin_no))
        return question_batch(question_rows(bin_no[order].astype(np.int64), at[order], hashes[order], ids, keys, starts,
                                            chunk_name(n, ids, keys), sure))
    return marked_spans(answered(texts.mapInArrow(ask, QUESTION), smaller_elsewhere), depth)


def smaller_elsewhere(hashes: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Leaves of a deep node below which a smaller id stands."""
    order = np.argsort(hashes, kind="stable")
    h = hashes[order]
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    least = np.minimum.reduceat(ids[order], np.flatnonzero(new)) if len(h) else ids[:0]
    out = np.zeros(len(h), bool)
    out[order] = ids[order] > least[np.cumsum(new) - 1]
    return out


def dedup_digests(docs: DataFrame, depth: int = 13, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_words, n_removed, kept_sha256 and the spans removed, of every row."""
    texts = keyed(docs, key, text)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            n, gone, digest = [], [], []
            for blob, spans in zip(part.column("blob"), part.column("spans")):
                found, spans = inflate(blob.as_py()).split(), spans.as_py()  # bytes split at just the blanks meant here
                drop = covered(len(found), spans)
                kept = found if not spans else itertools.compress(found, ~drop)
                n.append(len(found))
                gone.append(int(drop.sum()))
                digest.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()),
                                              pa.array(digest, pa.string())], ["id", "n_words", "n_removed", "kept_sha256"])
    return with_spans(texts, repeats(texts, depth)).mapInArrow(
        read, "id BIGINT, n_words BIGINT, n_removed BIGINT, kept_sha256 STRING")


def without_repeats(docs: DataFrame, depth: int = 13, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with the repeated words cut out of their texts; other words and the blanks after them stay as they are.

    A text that loses nothing is unchanged. A text whose every word goes is dropped: it holds nothing of its own.
    """
    spans = repeats(keyed(docs, key, text), depth)
    names = docs.columns
    own_id, own_key, id_, key_, list_, emptied_ = free_names(names, 6)
    hashed = docs.withColumns({own_id: F.col(f"`{key}`").cast("long"),
                               own_key: F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit("")))})
    lists = spans.groupBy(F.col("id").alias(id_), F.col("key").alias(key_)).agg(
        F.flatten(F.collect_list("spans")).alias(list_))
    same = F.col(own_id).eqNullSafe(F.col(id_)) & (F.col(own_key) == F.col(key_))
    joined = hashed.join(lists, same, "left").select(*[F.col(f"`{c}`") for c in names], list_)
    schema = T.StructType([*docs.schema.fields, T.StructField(emptied_, T.BooleanType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, text):
            said, emptied = [], []
            for whole, spans_ in zip(part.column(text).to_pylist(), part.column(list_).to_pylist()):
                new = cut_words(whole, spans_) if spans_ else whole
                said.append(new)
                emptied.append(bool(spans_) and not new.strip())
            columns = [pa.array(said, pa.string()) if c == text else part.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(emptied)], [*names, emptied_])
    return joined.mapInArrow(cut, schema).filter(~F.col(emptied_)).drop(emptied_)


def cut_words(text: str, spans: list[int]) -> str:
    raw = text.encode()
    data = np.frombuffer(raw, np.uint8)
    starts, _, _ = words(data, np.array([0, len(data)]))
    drop = covered(len(starts), spans)
    edges = np.append(starts, len(data))
    keep = [raw[: starts[0]]] if len(starts) else [raw]
    keep += [raw[edges[i]: edges[i + 1]] for i in np.flatnonzero(~drop).tolist()]
    return b"".join(keep).decode()


def op5_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, windows of 13 words."""
    return dedup_digests(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
