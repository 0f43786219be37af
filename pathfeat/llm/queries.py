"""Every operator of this package as a query over its whole table, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import quality, toxicity
from .chat import chat_texts
from .collocations import collocations
from .decontaminate import contamination
from .main_text import main_texts
from .minhash import near_duplicates
from .oracles import ORACLES as ORACLES
from .packing import packed
from .repeats import repeats_removed
from .sampling import share
from .secrets import secret_spans, span_digest
from .tokens import token_counts
from .top_k import top_k
from .whitening import whitened_vectors

TOKENIZER = "byte_bpe_50k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents linked by a similarity of 0.85 or more."""
    return near_duplicates(_table(spark, sf_dir, "documents"), threshold=(85, 100), width=5)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that earlier ones hold in strings of 50."""
    cut = repeats_removed(
        _table(spark, sf_dir, "documents"),
        length=50,
        outputs=("n_bytes", "n_removed", "n_spans", "kept_sha256"),
    )
    return cut.select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return main_texts(_table(spark, sf_dir, "pages"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document, from a cache that starts empty."""
    return token_counts(
        _table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), limit=1024
    )


def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten largest integer products of every hundredth vector with all others."""
    return top_k(_table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, k=10, scale=1024)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learnt from four fifths of the labels."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels, share("key", 5) != 0, per_class=3000)
    return _judged(quality.quality(docs, model), share("doc_id", 5) == 0, 0.3)


def _judged(scored: DataFrame, held_out: F.Column, least: float) -> DataFrame:
    return scored.select("row.doc_id", "score").select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= least).cast("int").alias("predicted"),
    )


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut and packed into sequences of 2048 tokens."""
    return packed(
        _table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), 2048, end_id=1
    )


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from two thirds of the labels."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels, share("key", 3) != 1, per_class=3000)
    return _judged(toxicity.toxicity(docs, model), share("doc_id", 3) == 1, 0.7)


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maximal conversations as training texts."""
    return chat_texts(_table(spark, sf_dir, "conversations"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows of 13 words in every document."""
    found = contamination(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), window=13, share=20
    )
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"
    )


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the eight leading components, whitened."""
    return whitened_vectors(_table(spark, sf_dir, "embeddings"), most=8)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best phrases of two and three words in each language."""
    return collocations(_table(spark, sf_dir, "documents"), least=10, most=2000)


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, weak ones where their parts meet."""
    found = span_digest(secret_spans(_table(spark, sf_dir, "documents")))
    return found.select("row.doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


QUERIES = {
    "op1_minhash": op1_minhash,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_main_text": op3_main_text,
    "op4_token_counts": op4_token_counts,
    "op5_top_k": op5_top_k,
    "op6_quality": op6_quality,
    "op7_packing": op7_packing,
    "op8_toxicity": op8_toxicity,
    "op9_chat_format": op9_chat_format,
    "op10_decontamination": op10_decontamination,
    "op11_whitening": op11_whitening,
    "op12_collocations": op12_collocations,
    "op13_secrets": op13_secrets,
}
