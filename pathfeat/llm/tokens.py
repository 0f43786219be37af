"""Token counts of whole texts, kept in a cache of digests.

A content is known by the digest of its normalised text and by the digest of the
tokenizer's file; a count, once stored, is never computed again. A run joins the
digests of the documents to the cache, encodes each missing content once, appends the
new counts and reads every document's count from the cache. Texts follow only where
their digest is missing; into an empty cache they go with their digests, in one pass.

The tokenizers this serves normalise nothing, so the normalised content of a text is its
UTF-8 bytes, with null as the empty text.

Defined results: null and empty texts have 0 bytes and 0 tokens; a null id stays null;
repeated rows give repeated rows; an empty table gives no rows; columns other than the
two named are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..plans.staging import CHECKPOINT_DIR, Staging, stage, staging_root
from .bpe import encoder
from .columns import column, text_bytes

CACHE_SCHEMA = "version string, digest binary, n_tokens bigint"


def tokenizer_version(path: str) -> str:
    """Digest of the tokenizer's file."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def new_cache(df: DataFrame) -> str:
    """A place for a cache that nothing else uses, in the folder that executors share."""
    root = staging_root(df.sparkSession)
    if root is None:
        raise ValueError(f"a cache needs a folder that executors share: give one, or set {CHECKPOINT_DIR}")
    return f"{root}/pathfeat/token-cache-{uuid.uuid4().hex}"


def read_cache(df: DataFrame, path: str, version: str) -> DataFrame:
    """``digest, n_tokens`` of one version. Runs that raced may have stored a content
    twice, with the same count."""
    spark = df.sparkSession
    try:
        stored = spark.read.schema(CACHE_SCHEMA).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        stored = spark.createDataFrame([], CACHE_SCHEMA)
    own = stored.where(F.col("version") == version)
    return own.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def _digest() -> F.Column:
    return F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)).alias("digest")


def append_misses(docs: DataFrame, path: str, tokenizer: str, text: str = "text") -> None:
    """Encode each content that the cache lacks once and append its count.

    The first aggregation runs before the shuffle, so of any number of copies a task
    sends one.
    """
    version = tokenizer_version(tokenizer)
    known = read_cache(docs, path, version).select("digest")
    own = Staging(staging_root(docs.sparkSession))
    contents = docs.select(column(docs, text, "text")).select(_digest(), "text")
    if known.head(1):
        with own:
            missing = contents.select("digest").distinct().join(known, "digest", "left_anti")
            missing = stage(missing, "missing")
        contents = contents.join(missing, "digest", "left_semi")
    contents = contents.groupBy("digest").agg(F.first("text").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        for batch in batches:
            n = own.counts(*text_bytes(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([version] * batch.num_rows, pa.string()),
                    batch.column("digest"),
                    pa.array(n, pa.int64()),
                ],
                names=["version", "digest", "n_tokens"],
            )

    contents.mapInArrow(count, CACHE_SCHEMA).write.mode("append").parquet(path)
    own.close()


def token_counts(
    docs: DataFrame,
    tokenizer: str,
    cache: str | None = None,
    limit: int = 1024,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``key, n_bytes, n_tokens, over_limit`` of every row.

    ``tokenizer`` is a file of the tokenizers library that every executor can read at
    that path. ``cache`` is a folder that all executors share; without one the run gets
    a cache of its own, which is deleted. The misses are encoded when this is called.
    """
    if cache is None:
        own = Staging(staging_root(docs.sparkSession))
        own.add(docs.sparkSession, cache := new_cache(docs))
        result = stage(token_counts(docs, tokenizer, cache, limit, key, text), "token-counts")
        own.close()
        return result
    append_misses(docs, cache, tokenizer, text)
    stored = read_cache(docs, cache, tokenizer_version(tokenizer))
    keyed = docs.select(column(docs, key, "key"), column(docs, text, "text")).select(
        "key", _digest(), F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes")
    )
    return keyed.join(stored, "digest").select(
        F.col("key").alias(key),
        "n_bytes",
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )
