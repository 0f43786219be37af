"""Text sources and sinks: arc corpora, label lists and tab-separated tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.parse import parse_arcs, parse_labels


def read_lines(
    spark: SparkSession, paths: str | list[str], partitions: int | None = None
) -> DataFrame:
    """Lines of files, directories or globs as ``line_id, value``.

    Line ids are unique within one read and cost no shuffle. ``partitions`` spreads the
    lines by a shuffle; it is for files that can't be split (gzip) or few small ones.
    """
    lines = spark.read.text(paths)
    if partitions is not None:
        lines = lines.repartition(partitions)
    return lines.select(F.monotonically_increasing_id().alias("line_id"), "value")


def read_arcs(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Valid arcs of a corpus as ``line_id, head, toks``."""
    return parse_arcs(read_lines(spark, paths))


def read_labels(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Labelled pairs of a list as ``w1, w2, label``."""
    return parse_labels(spark.read.text(paths))


def write_tsv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write the columns as tab-separated text. A null is an empty field; a null in the
    last column is left out with its tab."""
    texts = [F.col(c).cast("string") for c in df.columns]
    fields = [F.coalesce(t, F.lit("")) for t in texts[:-1]]
    df.select(F.concat_ws("\t", *fields, texts[-1]).alias("value")).write.mode(mode).text(path)


def read_tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Read what ``write_tsv`` wrote; empty and missing fields are null."""
    columns = spark.createDataFrame([], schema).schema
    parts = spark.read.text(path).select(F.split("value", "\t").alias("_p"))
    return parts.select(
        *[
            F.nullif(F.get("_p", F.lit(i)), F.lit("")).cast(f.dataType).alias(f.name)
            for i, f in enumerate(columns)
        ]
    )
