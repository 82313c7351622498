"""Token counts through a cache keyed by content digest and tokenizer version."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.wordcache import cache_for, slices

CACHE = "content binary, n_tokens long, tokenizer string"


def tokenizer_version(path: str) -> str:
    """Digest of the vocabulary file and of the library's version."""
    import tokenizers

    with open(path, "rb") as file:
        return hashlib.sha256(file.read() + tokenizers.__version__.encode()).hexdigest()


def _counted(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    cache = cache_for(path)
    for batch in batches:
        texts = batch.column(1).to_pylist()
        counts = [cache.encode(texts[lo:hi])[1] for lo, hi in slices(texts)]
        total = np.concatenate(counts) if counts else np.empty(0, np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(total, pa.int64())], ["content", "n_tokens"])


def count_tokens(docs: DataFrame, tokenizer_path: str, cache_path: str, limit: int = 1024,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) per row of ``docs``.

    The normalised content is the text itself with null as the empty text, as any other change
    could change the count.  Contents absent from the Parquet cache at ``cache_path`` for this
    tokenizer version are encoded once each and appended there; every count then comes from the
    cache.  Equal texts are merged before they are shuffled, and the join back moves digests
    only, in a form whose hot keys Spark's skew handling splits.  The cache takes one writer at
    a time.  Null and empty texts have 0 bytes and 0 tokens; repeated rows and null ids give a
    row each; an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    version = tokenizer_version(tokenizer_path)
    text = F.coalesce(docs[text_col], F.lit(""))
    digest = F.unhex(F.sha2(text.cast("binary"), 256)).alias("content")
    # an empty append makes the cache readable on its first use
    spark.createDataFrame([], CACHE).write.mode("append").parquet(cache_path)
    known = spark.read.schema(CACHE).parquet(cache_path).where(F.col("tokenizer") == version)
    misses = (
        docs.select(digest, text.alias("text")).dropDuplicates(["content"])
        .join(known.select("content"), "content", "left_anti")
    )
    (
        misses.mapInArrow(lambda it: _counted(it, tokenizer_path), "content binary, n_tokens long")
        .withColumn("tokenizer", F.lit(version))
        .write.mode("append").parquet(cache_path)
    )
    stored = spark.read.schema(CACHE).parquet(cache_path).where(F.col("tokenizer") == version)
    asked = docs.select(docs[id_col].alias(id_col), F.octet_length(text).cast("long").alias("n_bytes"), digest)
    return asked.join(stored.select("content", "n_tokens"), "content").select(
        id_col, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
