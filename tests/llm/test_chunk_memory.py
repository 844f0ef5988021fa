"""Word hashes are made block by block: the same values, and no eight bytes for every byte of a chunk."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa

from martloom.llm.collocations import CHUNK, Chunk
from martloom.llm.common import word_hashes, words


def test_hashes_do_not_depend_on_blocks():
    data = np.frombuffer(("a bb ccc " * 50 + "x" * 300 + " bb a").encode(), np.uint8)
    starts, ends, _ = words(data, np.array([0, len(data)]))
    whole = word_hashes(data, starts, ends, len(data))
    for most in (1, 7, 64):
        assert np.array_equal(word_hashes(data, starts, ends, most), whole)
    assert whole[1] == whole[-2] and whole[0] == whole[-1] and len(set(whole.tolist())) == 4
    assert len(word_hashes(data, starts[:0], ends[:0])) == 0


def test_a_chunk_of_text_takes_little_beside_itself():
    texts = pa.array(["some words, of a text that is not long. " * 52] * (CHUNK // 2080))
    tracemalloc.start()
    chunk = Chunk(texts, ["en"] * len(texts))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert chunk.n > 700_000
    assert peak < 40 * CHUNK  # an array of 64 bits a byte takes eight
