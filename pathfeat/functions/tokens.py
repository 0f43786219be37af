"""Token-level expressions over ``word/POS/label/pointer`` tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that make a word invalid.
SPECIAL_CHARACTERS = "!@#$%^&*()_+-=,./;:'[{}]\"\\|"
SPECIAL_PATTERN = "[" + "".join("\\" + c for c in SPECIAL_CHARACTERS) + "]"


def keeps_field(field: Column) -> Column:
    """False for the count tail: fields with fewer than two ``/``-parts."""
    return field.rlike("/[^/]")


def token_parts(field: Column) -> Column:
    """``/``-parts of a token, trailing empty parts dropped."""
    return F.split(F.rtrim(field, F.lit("/")), "/")


def has_special(word: Column) -> Column:
    return word.rlike(SPECIAL_PATTERN)


def pointer(text: Column) -> Column:
    """Integer pointer, null when the text is no integer."""
    return F.when(text.rlike("^[+-]?[0-9]+$"), text.try_cast("int"))


def is_noun(token: Column, noun_on: str = "descriptor") -> Column:
    """``NN`` anywhere in the token, or in its part of speech only."""
    if noun_on == "pos":
        return token["pos"].contains("NN")
    return token["pos"].contains("NN") | token["word"].contains("NN") | token["label"].contains("NN")
