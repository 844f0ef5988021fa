"""Shared folders, whole-text byte columns, and vectorised string hashes of the operators."""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
WORD_BASE, TEXT_BASE = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95


def ship(spark: SparkSession) -> None:
    """Give the workers this package, once a session: they may start anywhere and without it on their path."""
    context = spark.sparkContext
    if any(os.path.basename(path) == "martloom.zip" for path in context._python_includes or []):
        return
    root = Path(__file__).resolve().parents[2]
    path = os.path.join(tempfile.mkdtemp(prefix="martloom-code-"), "martloom.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as bundle:
        for file in sorted((root / "martloom").rglob("*.py")):
            bundle.write(file, file.relative_to(root))
    context.addPyFile(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as the session names it; one of our own only where none is named."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
        if not base:
            if not spark.sparkContext.master.startswith("local["):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            base = tempfile.mkdtemp(prefix="martloom-")
            spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def stored(df: DataFrame, what: str) -> DataFrame:
    """Write a table to a new place in the shared folder and read it back.

    This cuts the lineage, makes later reads the same whichever executor is lost, and gives the
    planner the real size of the table.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_names(taken: list[str], n: int) -> list[str]:
    """n column names that no given column has, whatever the case."""
    used, out, i = {c.lower() for c in taken}, [], 0
    while len(out) < n:
        if f"_made_{i}" not in used:
            out.append(f"_made_{i}")
        i += 1
    return out


def part_of(id_column: Column, folds: int = 5) -> Column:
    """crc32 of an id as text, modulo folds; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def held_out(id_column: Column) -> Column:
    return part_of(id_column) == 0


# ---- text columns as bytes ----

def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts on end, and where each text starts (one more offset than texts); null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "").cast(pa.large_binary())
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset: column.offset + n + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[at[0]: at[-1]], at - at[0]


def pieces(batches: Iterator[pa.RecordBatch], text: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about `most` bytes of text; one longer text stands alone, whole."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        filled = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            base = filled[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(filled, base + most, "right")))
            yield batch.slice(start, end - start)
            start = end


# ---- keyed hashes of words and bytes, for equality ----

KEY = b"martloom words"


def letters_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The words as an array of byte strings."""
    sizes = ends - starts
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    places = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], sizes)
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[places]))])


def word_keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64 bits of a keyed cryptographic hash of every word; each distinct word is hashed once."""
    if not len(starts):
        return np.zeros(0, U64)
    encoded = letters_of(data, starts, ends).dictionary_encode()
    keys = np.array([int.from_bytes(hashlib.blake2b(w, digest_size=8, key=KEY).digest(), "little")
                     for w in encoded.dictionary.to_pylist()], U64)
    return keys[encoded.indices.to_numpy(zero_copy_only=False)]


def run_keys(keys: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Hash of the `length` words from each place on: word after word, with a mix that is not linear in any of them."""
    out = np.full(len(at), length, U64)
    for j in range(length):
        out = mix(out * U64(WORD_BASE) + keys[at + j])
    return out


WINDOW = 8


def byte_sums(data: np.ndarray) -> np.ndarray:
    """Prefix sums over the mixed values of all 8-byte windows, for `bytes_key`."""
    padded = np.concatenate([data, np.zeros(WINDOW, np.uint8)])
    value = np.ndarray((len(data),), "<u8", padded.tobytes(), strides=(1,)).astype(U64)
    return prefix_sums(mix(value ^ U64(0xA5B85C5E198ED849)), TEXT_BASE)


def bytes_key(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes from start to end, eight at least, through the windows that lie within."""
    return mix(stretch(sums, start, end - (WINDOW - 1), TEXT_BASE))


# ---- hashes modulo 2**64 ----

_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse for i < n."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)

        def run(x: int) -> np.ndarray:
            steps = np.full(size, x, U64)
            steps[0] = 1
            return np.multiply.accumulate(steps)
        have = run(base), run(pow(base, -1, 1 << 64))
        if size <= 1 << 23:
            _POWERS[base] = have
    return have[0][:n], have[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of each value (a one-to-one map)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def prefix_sums(values: np.ndarray, base: int) -> np.ndarray:
    """Sums of value * base**i; differences give the hash of any stretch."""
    up, _ = powers(base, len(values))
    out = np.zeros(len(values) + 1, U64)
    np.cumsum((values.astype(U64) + U64(1)) * up, out=out[1:])
    return out


def stretch(sums: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Hash of values[start:end]; equal stretches have equal hashes wherever they stand."""
    _, down = powers(base, len(sums))
    return (sums[end] - sums[start]) * down[start]


def words(
    data: np.ndarray, offsets: np.ndarray, gap: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and where each text's words start.

    `gap` marks the bytes between words; by default those are 0x20 and 0x09-0x0D.
    """
    if gap is None:
        gap = (data == 32) | ((data >= 9) & (data <= 13))
    edges = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    before = np.ones(len(data), bool)
    before[1:] = gap[:-1]
    before[edges] = True
    after = np.ones(len(data), bool)
    after[:-1] = gap[1:]
    after[edges - 1] = True
    starts = np.flatnonzero(~gap & before)
    ends = np.flatnonzero(~gap & after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, most: int = 1 << 18) -> np.ndarray:
    """Hash of the bytes of every word. Sums are kept for `most` bytes at a time (more only for one longer word): a
    word's hash does not depend on where they start, and eight bytes for each of a chunk add up."""
    out = np.empty(len(starts), U64)
    start = 0
    while start < len(starts):
        base = starts[start]
        end = max(start + 1, int(np.searchsorted(ends, base + most, "right")))
        a, b = starts[start:end] - base, ends[start:end] - base
        sums = prefix_sums(data[base: ends[end - 1]], TEXT_BASE)
        out[start:end] = mix(stretch(sums, a, b, TEXT_BASE) ^ ((b - a).astype(U64) << U64(48)))
        start = end
    return out
