"""The stages that turn raw documents into packed training sequences.

Each stage takes the documents its predecessor kept and returns the columns of the
documents, the last one the packed pieces. A stage's result is written and read again
before the next one starts, and deleted once that one has written its own.

Defined results of every stage: a null text is an empty one, and only packing shows it, as
a document of its end id alone; an empty table gives no rows; columns beside ``doc_id`` and
``text`` are carried as they are and read by no stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathfeat.llm import toxicity
from pathfeat.llm.columns import column
from pathfeat.llm.decontaminate import decontaminated
from pathfeat.llm.minhash import near_duplicates
from pathfeat.llm.packing import packed
from pathfeat.llm.queries import TOKENIZER
from pathfeat.llm.repeats import without_repeats
from pathfeat.llm.sampling import share
from pathfeat.plans.staging import Staging, stage, staging_root

TOXIC = 0.7

# Bits for the ids that near-dedup drops, one megabyte whatever the input, and how many of
# them ``bitmap_construct_agg`` puts in a row.
_SLOTS = 1 << 23
_ROW_BITS = 1 << 15


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below ``TOXIC``. Rows that repeat an id are each judged
    by their own text; empty texts have the score of texts without any known word."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels, share("key", 3) != 1, per_class=3000)
    scored = toxicity.toxicity(docs, model, carry=docs.columns)
    return scored.where(F.col("score") < TOXIC).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one of least id. Rows without
    an id stay, and rows that repeat an id stay or go together.

    Only rows whose id has the bit of a dropped one are joined with the dropped ids; the
    others stay where they are read, so the texts that are kept aren't shuffled."""
    found = near_duplicates(docs, threshold=(85, 100), width=5)
    gone = found.where(~F.col("kept")).select("doc_id").distinct()
    return _without(docs, gone)


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id isn't in ``gone``."""
    bucket, bits = "bucket", "bits"
    while bucket in docs.columns or bits in docs.columns:
        bucket, bits = bucket + "_", bits + "_"
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(_SLOTS))
    row, at = F.shiftright(slot, 15).alias(bucket), slot % _ROW_BITS
    maps = gone.select(row, at.alias("at")).groupBy(bucket).agg(F.bitmap_construct_agg("at").alias(bits))
    byte = F.conv(F.hex(F.substr(bits, (F.shiftright(at, 3) + 1).cast("int"), F.lit(1))), 16, 10)
    bit = F.call_function("getbit", byte.cast("int"), (at % 8).cast("int"))
    marked = docs.withColumn(bucket, row).join(F.broadcast(maps), bucket, "left")
    suspect, names = F.coalesce(bit == 1, F.lit(False)), [column(docs, c) for c in docs.columns]
    left = marked.where(suspect).select(names).join(gone, "doc_id", "left_anti").select(names)
    return marked.where(~suspect).select(names).union(left)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 50 bytes that documents of smaller id hold. Texts that
    are cut in the middle of a character lose its remaining bytes; rows without an id and
    rows of one id take nothing from one another."""
    return without_repeats(docs, length=50)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated texts without the passages they share with the benchmark. Repeated rows
    and rows without an id are each searched; an empty benchmark changes nothing."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminated(docs, benchmark, window=13, share=20)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed pieces of what is left; repeated rows are packed each."""
    return packed(docs, public_tokenizers.path(TOKENIZER), 2048, end_id=1)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("suffix_dedup", cut_repeats),
    ("decontamination", cut_benchmark),
    ("packing", pack),
]

# The classifier, the tokenizer and the sequences can't be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), Staging()
    for name, step in STAGES[:-1]:
        kept = step(spark, docs, sf_dir)
        scope = Staging(staging_root(spark))
        with scope:
            docs = stage(kept, f"pipeline-{name}")
        before.close()
        before = scope
    return STAGES[-1][1](spark, docs, sf_dir)
