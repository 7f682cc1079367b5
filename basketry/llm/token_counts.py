"""Token counts through a digest cache.

A text's key is the SHA-256 of its normalised content (null becomes empty; an
optional ``normalise`` expression may fold more, as long as it keeps counts)
together with the digest of the tokenizer file. Stored counts are joined on
that key; only the distinct texts without an entry are encoded and appended to
the cache table.

Scale: texts are reduced to one per digest map-side before the only shuffle
that carries text, so a text that fills a third of the table moves once per
map task. Everything after it moves 32-byte digests. The cache is a Parquet
table in a shared folder; appends go through Spark's committer, so a lost
executor leaves no half-written entry, and entries that two writers both
appended are merged on reading.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.common import stored, text_or_empty

CACHE_SCHEMA = "digest binary, tokenizer string, n_tokens long"
BATCH_CHARS = 1 << 20  # texts handed to the tokenizer at once


def tokenizer_digest(path: str) -> str:
    """SHA-256 of the tokenizer file: another version has other cache entries."""
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def counter(path: str) -> Callable[[list[str]], list[int]]:
    """Counts without begin, end or added special tokens, no truncation or padding."""
    if path.endswith(".model"):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in sp.encode(texts, add_bos=False, add_eos=False, num_threads=1)]
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return lambda texts: [len(e.ids) for e in tok.encode_batch(texts, add_special_tokens=False)]


def count_texts(texts: list[str], counts: Callable[[list[str]], list[int]]) -> list[int]:
    """Token counts of ``texts``, given to ``counts`` in batches of bounded size."""
    out, batch, size = [], [], 0
    for t in texts:
        batch.append(t)
        size += len(t)
        if size >= BATCH_CHARS:
            out += counts(batch)
            batch, size = [], 0
    return out + (counts(batch) if batch else [])


def _read_cache(spark: SparkSession, cache: str) -> DataFrame:
    try:
        return spark.read.schema(CACHE_SCHEMA).parquet(cache)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], CACHE_SCHEMA)


def cached_counts(spark: SparkSession, cache: str, tokenizer: str) -> DataFrame:
    """(digest, n_tokens) of one tokenizer version; doubled entries are merged."""
    own = _read_cache(spark, cache).where(F.col("tokenizer") == tokenizer)
    return own.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(
    docs: DataFrame,
    model: str,
    cache: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 4096,
    normalise: Callable[[Column], Column] = lambda c: c,
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_bytes``, ``n_tokens``, ``over_limit``.

    ``model`` is a tokenizer file that every executor can open (.json or
    .model), ``cache`` a folder that all share. Misses are encoded and stored
    when this function is called; the result joins the stored counts. A null
    text counts as empty; null ids and repeated rows stay; other columns are
    ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    version = tokenizer_digest(model)
    text = normalise(text_or_empty(text_col))
    digest = F.unhex(F.sha2(text.cast("binary"), 256))
    texts = docs.select(digest.alias("digest"), text.alias("text"))
    distinct = texts.groupBy("digest").agg(F.first("text").alias("text"))
    misses = distinct.join(cached_counts(spark, cache, version), "digest", "left_anti")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counter(model)
        for b in batches:
            n = count_texts(b.column(1).to_pylist(), counts)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([version] * len(n), pa.string()), pa.array(n, pa.int64())],
                names=["digest", "tokenizer", "n_tokens"],
            )

    misses.mapInArrow(encode, CACHE_SCHEMA).write.mode("append").parquet(cache)
    keyed = docs.select(
        F.col(f"`{id_col}`").alias(id_col),
        digest.alias("digest"),
        F.octet_length(text_or_empty(text_col)).cast("long").alias("n_bytes"),
    )
    # a table of its own: the join then meets plain rows on both sides, so the copies of one text can be split
    counts = stored(cached_counts(spark, cache, version), "token-counts")
    return keyed.join(counts, "digest").select(
        id_col, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
