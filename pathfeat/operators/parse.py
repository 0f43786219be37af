"""Text lines to typed arcs, labels and rejects.

An arc line is ``head <ws> word/POS/label/pointer ... [total year,count ...]``.
Every function works line by line: no shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import fields, trim_control
from ..functions.tokens import has_special, keeps_field, pointer, token_parts


def _with_parts(lines: DataFrame, value: str) -> DataFrame:
    """Add ``head`` and ``parts`` (the ``/``-parts of each token, count tail removed)."""
    split = lines.withColumn("_f", fields(F.col(value)))
    kept = split.withColumn(
        "_kept", F.filter(F.slice("_f", F.lit(2), F.size("_f")), keeps_field)
    ).withColumn("head", F.regexp_replace(F.get("_f", F.lit(0)), r"^[\x00-\x20]+", ""))
    # The line is trimmed once the tail is gone, so control characters at the end
    # of the last token go as well.
    size = F.size("_kept")
    last = F.get("_kept", size - 1)
    trimmed = F.when(
        last.rlike(r"[\x00-\x20]$"),
        F.concat(
            F.slice("_kept", F.lit(1), size - 1),
            F.array(F.regexp_replace(last, r"[\x00-\x20]+$", "")),
        ),
    ).otherwise(F.col("_kept"))
    return kept.withColumn("parts", F.transform(trimmed, token_parts)).drop("_f", "_kept")


def _token(parts: Column) -> Column:
    return F.struct(
        F.get(parts, F.lit(0)).alias("word"),
        F.get(parts, F.lit(1)).alias("pos"),
        F.get(parts, F.lit(2)).alias("label"),
        pointer(F.get(parts, F.lit(3))).alias("ptr"),
    )


def _reason() -> Column:
    """Why a line is no arc: the first failing check, or null."""
    parts, size = F.col("parts"), F.size("parts")

    def bad_pointer(token: Column) -> Column:
        value = pointer(F.get(token, F.lit(3)))
        return value.isNull() | (value < 0) | (value > size)

    return (
        F.when(F.col("head") == "", "empty head")
        .when(size == 0, "no tokens")
        .when(F.exists(parts, lambda p: F.size(p) != 4), "token arity")
        .when(F.exists(parts, lambda p: has_special(F.get(p, F.lit(0)))), "special character")
        .when(F.exists(parts, bad_pointer), "pointer")
    )


def parse_arcs(lines: DataFrame, value: str = "value") -> DataFrame:
    """Valid lines as ``head, toks``; other columns of ``lines`` are carried along.

    The row is emitted by a generator of zero or one element: a filter would be
    pushed below the projection that parses the line and parse it twice.
    """
    keys = [c for c in lines.columns if c != value]
    arc = F.struct("head", F.transform("parts", _token).alias("toks"))
    return (
        _with_parts(lines, value)
        .select(*keys, F.inline(F.when(_reason().isNull(), F.array(arc))))
    )


def reject_arcs(lines: DataFrame, value: str = "value") -> DataFrame:
    """Lines that are no arc, with the reason; blank lines included.

    The row comes from a generator, as in ``parse_arcs``.
    """
    keys = [c for c in lines.columns if c != value]
    reject = F.array(F.struct(value, "reason"))
    return (
        _with_parts(lines, value)
        .select(*keys, value, _reason().alias("reason"))
        .select(*keys, F.inline(F.when(F.col("reason").isNotNull(), reject)))
    )


def route_arcs(lines: DataFrame, value: str = "value") -> DataFrame:
    """Every line as an arc or a reject: ``head, toks`` of arcs, the text and ``reason`` of
    rejects, and ``kind``, which says which it is."""
    keys = [c for c in lines.columns if c != value]
    is_arc = F.col("reason").isNull()
    parsed = _with_parts(lines, value).withColumn("reason", _reason())
    return parsed.select(
        *keys,
        F.when(is_arc, F.col("head")).alias("head"),
        F.when(is_arc, F.transform("parts", _token)).alias("toks"),
        F.when(~is_arc, F.col(value)).alias(value),
        "reason",
        F.when(is_arc, "arc").otherwise("reject").alias("kind"),
    )


def parse_labels(lines: DataFrame, value: str = "value") -> DataFrame:
    """``w1 w2 true|false`` lines as ``w1, w2, label``."""
    keys = [c for c in lines.columns if c != value]
    third = F.get("_f", F.lit(2))
    label = F.struct(
        F.get("_f", F.lit(0)).alias("w1"),
        F.get("_f", F.lit(1)).alias("w2"),
        F.lower(third).contains("true").alias("label"),
    )
    return lines.withColumn("_f", fields(trim_control(F.col(value)))).select(
        *keys, F.inline(F.when((F.size("_f") == 3) & _is_label(third), F.array(label)))
    )


def reject_labels(lines: DataFrame, value: str = "value") -> DataFrame:
    """Label lines with another number of fields or no truth value."""
    keys = [c for c in lines.columns if c != value]
    reason = F.when(F.size("_f") != 3, "field count").when(
        ~_is_label(F.get("_f", F.lit(2))), "no truth value"
    )
    return (
        lines.withColumn("_f", fields(trim_control(F.col(value))))
        .select(*keys, value, reason.alias("reason"))
        .where(F.col("reason").isNotNull())
    )


def _is_label(text: Column) -> Column:
    return F.lower(text).rlike("true|false")
