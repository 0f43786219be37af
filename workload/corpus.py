"""Arc corpora and label lists derived from the given text tables.

The tables hold no parsed corpus, so one is derived from the whole of every text by
a fixed rule that SQL can state too: words in groups of four (the last group of a
text may be shorter), the part of speech and the label from the word's length, the
pointer from its first letter. Token 1 is the root and the head.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pathfeat.operators.parse import parse_arcs, parse_labels

GROUP = 4
LONG = 12


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Spread a table of few splits over the cores; a table with enough stays as read."""
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(2 * cores)


def _grouped(df: DataFrame, key: str, words: Column) -> DataFrame:
    """``key, line_no, ws``: consecutive groups of words, whole text."""
    return (
        df.select(key, words.alias("_all"))
        .select(
            key,
            F.posexplode(
                F.transform(
                    F.when(
                        F.size("_all") > 0,
                        F.sequence(F.lit(1), F.size("_all"), F.lit(GROUP)),
                    ),
                    lambda at: F.slice("_all", at, F.lit(GROUP)),
                )
            ).alias("line_no", "ws"),
        )
    )


def _pos(word: Column) -> Column:
    rest = F.length(word) % 3
    return F.when(rest == 0, "VB").when(rest == 1, "NN").otherwise("NNS")


def _label(word: Column) -> Column:
    return F.when(F.length(word) % 2 == 0, "prep").otherwise("pobj")


def _pointer(word: Column, index: Column) -> Column:
    return F.when(index == 0, 0).otherwise((F.ascii(word) + F.length(word)) % (index + 1))


def arcs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed arcs ``doc_id, line_no, head, toks`` from the words of ``documents``."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    groups = _grouped(docs, "doc_id", F.regexp_extract_all("text", F.lit(r"(\p{L}+)"), F.lit(1)))
    return groups.select(
        "doc_id",
        "line_no",
        F.get("ws", F.lit(0)).alias("head"),
        F.transform(
            "ws",
            lambda w, i: F.struct(
                w.alias("word"),
                _pos(w).alias("pos"),
                _label(w).alias("label"),
                _pointer(w, i).cast("int").alias("ptr"),
            ),
        ).alias("toks"),
    )


def arc_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw arc lines ``doc_id, line_no, value`` from the blank-separated ``documents``.

    Tokens keep their punctuation, so many lines are invalid; the head is the first
    token without it and may be empty. Each line ends in a tail of counts.
    """
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    groups = _grouped(
        docs, "doc_id", F.regexp_extract_all("text", F.lit(r"([^ \t\n\x0B\f\r]+)"), F.lit(1))
    )
    token = lambda w, i: F.concat(
        w, F.lit("/"), _pos(w), F.lit("/"), _label(w), F.lit("/"), _pointer(w, i).cast("string")
    )
    return groups.select(
        "doc_id",
        "line_no",
        F.concat(
            F.regexp_replace(F.get("ws", F.lit(0)), r"[^\p{L}]", ""),
            F.lit("\t"),
            F.array_join(F.transform("ws", token), " "),
            F.concat(F.lit("\t"), F.size("ws").cast("string"), F.lit("\t1999,"), F.col("line_no")),
        ).alias("value"),
    )


def long_arc_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw arc lines ``doc_id, line_no, value`` of one to ``LONG`` words.

    Sentences end at full stops and line ends; each is cut into lines after every
    ``LONG`` words, and none is dropped. Pointers may run forward and form cycles;
    a word of 13 letters points past the end, one of 15 has a part too many, and the
    head is any word of the line, often not one with pointer 0. A line of one word has a
    head and no tokens.
    """
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    sentences = docs.select(
        "doc_id", F.posexplode(F.split("text", "[.\n]")).alias("line_no", "sentence")
    )
    words = F.regexp_extract_all("sentence", F.lit(r"([^ \t\x0B\f\r,]+)"), F.lit(1))
    cut = F.transform(
        F.when(F.size("_all") > 0, F.sequence(F.lit(1), F.size("_all"), F.lit(LONG))),
        lambda at: F.slice("_all", at, F.lit(LONG)),
    )
    split = (
        sentences.select("doc_id", "line_no", words.alias("_all"))
        .select("doc_id", "line_no", F.posexplode(cut).alias("_part", "ws"))
        .withColumn("line_no", F.col("line_no") * 100_000 + F.col("_part"))
    )
    size = F.size("ws")

    def token(w: Column, i: Column) -> Column:
        ahead = (F.ascii(w) + 3 * F.length(w)) % (size + 1)
        pointer = F.when(F.length(w) == 13, size + 1).when(i == 0, 0).otherwise(ahead)
        more = F.when(F.length(w) == 15, "/x").otherwise("")
        return F.concat(
            w, F.lit("/"), _pos(w), F.lit("/"), _label(w), F.lit("/"), pointer.cast("string"), more
        )

    head = F.get("ws", F.length(F.get("ws", size - 1)) % size)
    tokens = F.when(size > 1, F.transform("ws", token)).otherwise(F.array().cast("array<string>"))
    return split.select(
        "doc_id",
        "line_no",
        F.concat(
            F.regexp_replace(head, r"[^\p{L}]", ""), F.lit("\t"), F.array_join(tokens, " ")
        ).alias("value"),
    )


def long_arcs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_arcs(long_arc_lines(spark, sf_dir))


def label_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw label lines from neighbouring words of ``conversations`` and ``benchmark``.

    Marks inside a word become blanks, so some lines have another number of fields.
    The label says whether both words have the same length modulo 3, which the tags
    at the ends of a path follow.
    """
    texts = (
        table(spark, sf_dir, "conversations")
        .select("text")
        .unionByName(table(spark, sf_dir, "benchmark").select("text"))
    )
    words = F.regexp_extract_all("text", F.lit(r"([^ \t\n\x0B\f\r]+)"), F.lit(1))
    pairs = (
        spread(texts)
        .select(words.alias("ws"))
        .select(
            F.inline(
                F.zip_with(
                    F.slice("ws", F.lit(1), F.size("ws") - 1),
                    F.slice("ws", F.lit(2), F.size("ws") - 1),
                    lambda x, y: F.struct(x.alias("x"), y.alias("y")),
                )
            )
        )
    )
    letters = lambda w: F.length(F.regexp_replace(w, r"[^\p{L}]", ""))
    blanks = lambda w: F.regexp_replace(w, r"[^\p{L}]", " ")
    truth = F.when(letters("x") % 3 == letters("y") % 3, "true").otherwise("false")
    return pairs.select(F.concat_ws(" ", blanks("x"), blanks("y"), truth).alias("value"))


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_labels(label_lines(spark, sf_dir))
