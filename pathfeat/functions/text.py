"""Whitespace and trimming with the exact character sets of the text formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITESPACE = r"[ \t\n\x0B\f\r]+"


def fields(line: Column) -> Column:
    """Split on whitespace runs; a leading run leaves an empty first field."""
    return F.split(line, WHITESPACE)


def trim_control(text: Column) -> Column:
    """Drop every character up to U+0020 at both ends (``trim`` drops spaces only)."""
    return F.regexp_replace(text, r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def lpad_index(index: Column, size: Column) -> Column:
    """Zero-pad an index to the digits of the vector size, so text order is numeric.

    A size of 10 pads to two digits although 9 is the largest index.
    """
    digits = F.length(size.cast("string"))
    text = index.cast("string")
    return F.concat(F.repeat(F.lit("0"), F.greatest(digits - F.length(text), F.lit(0))), text)
