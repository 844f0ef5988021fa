"""Token counts through a digest cache.

The cache is a table of (tokenizer digest, text digest, tokens). A run joins the digests of its texts with it,
encodes each missing text once, appends the new counts, and answers every document from the cache.

Texts are digested as they are, null as the empty text: the tokenizer sees every byte, so folding case or blanks
before the digest would change counts. Cases: null and empty texts have 0 tokens; repeated rows and ties are each
answered; null ids stay; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.common import pieces, shared_folder, table

CACHE_SCHEMA = "tokenizer STRING, digest BINARY, n_tokens BIGINT"
# One blank between two other characters starts a piece of every byte-level split, so counts add up over such pieces.
CUT = re.compile(r"(?<=\S) (?=\S)")
KNOWN_MOST = 600_000
_READY: dict[str, tuple] = {}


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenizer_digest(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def byte_level(tokenizer) -> bool:
    """Whether texts may be cut at single blanks: byte-level split by pattern, nothing changed before it."""
    kind = tokenizer.pre_tokenizer
    return tokenizer.normalizer is None and type(kind).__name__ == "ByteLevel" and kind.use_regex \
        and not kind.add_prefix_space


def counter(path: str):
    """text list -> token counts, by the library of the file."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()

    def encode(texts: list[str]) -> list[int]:
        return [len(e.ids) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    if not byte_level(tokenizer):
        return encode
    known: dict[str, int] = {}

    def count(text: str) -> int:
        parts = CUT.split(text)
        parts[1:] = [" " + p for p in parts[1:]]
        total = 0
        for at in range(0, len(parts), 50_000):
            some = parts[at: at + 50_000]
            try:
                total += sum(map(known.__getitem__, some))
            except KeyError:
                new = [p for p in set(some) if p not in known]
                if len(known) + len(new) > KNOWN_MOST:
                    known.clear()
                    new = list(set(some))
                known.update(zip(new, encode(new)))
                total += sum(map(known.__getitem__, some))
        return total
    return lambda texts: [count(t) for t in texts]


def _ready(path: str):
    if path not in _READY:
        _READY[path] = counter(path)
    return _READY[path]


def read_cache(spark: SparkSession, cache: str, tokenizer: str) -> DataFrame:
    """Counts of one tokenizer version; an entry appended twice by two runs counts once."""
    return spark.read.schema(CACHE_SCHEMA).parquet(cache).filter(F.col("tokenizer") == tokenizer) \
        .groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def open_cache(spark: SparkSession, cache: str) -> None:
    """Make the cache table if it is not there."""
    spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").parquet(cache)


def fill_cache(docs: DataFrame, cache: str, path: str, text: str = "text") -> None:
    """Encode the distinct texts that the cache lacks and append their counts.

    Copies meet before the shuffle (first text per digest in each task) and after it, so that a text carried by a
    third of all rows is one row a task. The cache is joined on the partitioning of that same shuffle.
    """
    spark, version = docs.sparkSession, tokenizer_digest(path)
    content = F.coalesce(F.col(text), F.lit(""))
    distinct = docs.select(F.unhex(F.sha2(content.cast("binary"), 256)).alias("digest"), content.alias("content")) \
        .groupBy("digest").agg(F.first("content").alias("content"))
    missing = distinct.join(read_cache(spark, cache, version).hint("merge"), "digest", "left_anti")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _ready(path)
        for part in pieces(batches, "content"):
            n = count(part.column("content").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [pa.array([version] * len(n), pa.string()), part.column("digest"), pa.array(n, pa.int64())],
                ["tokenizer", "digest", "n_tokens"])

    missing.mapInArrow(encode, CACHE_SCHEMA).write.mode("append").parquet(cache)


def count_tokens(
    docs: DataFrame, cache: str, path: str, *, key: str = "doc_id", text: str = "text", limit: int = 512,
) -> DataFrame:
    """key, n_bytes, n_tokens and over_limit of every row, all counts read from the cache."""
    spark = docs.sparkSession
    open_cache(spark, cache)
    fill_cache(docs, cache, path, text)
    content = F.coalesce(F.col(text), F.lit("")).cast("binary")
    asked = docs.select(F.col(key), F.octet_length(content).cast("long").alias("n_bytes"),
                        F.unhex(F.sha2(content, 256)).alias("digest"))
    found = read_cache(spark, cache, tokenizer_digest(path))
    return asked.join(found, "digest").select(
        F.col(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents under the 50k byte-level vocabulary, from a cache that starts empty."""
    cache = f"{shared_folder(spark)}/token-cache-{uuid.uuid4().hex}"
    return count_tokens(table(spark, sf_dir, "documents"), cache, tokenizer_path("byte_bpe_50k.json"))
