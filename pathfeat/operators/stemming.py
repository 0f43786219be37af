"""Stemming of the nouns of a line and of labelled pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.stemmer import stem, stems_or_null
from ..functions.tokens import is_noun
from ..options import Options


def stem_arcs(
    arcs: DataFrame, options: Options = Options(), pairs_only: bool = False
) -> DataFrame:
    """Replace every noun of a line by its stem.

    The head is stemmed too when it equals a noun token with pointer 0. Nouns are
    stemmed in place, line by line: a join with a table of stems would shuffle the
    whole corpus twice to save some regular expressions. With ``pairs_only`` a line
    with fewer than two nouns loses its tokens instead: it holds no pair to find.
    """
    toks = F.col("toks")
    if options.lower:
        toks = F.transform(toks, lambda t: t.withField("word", F.lower(t["word"])))
        arcs = arcs.withColumn("head", F.lower("head")).withColumn("toks", toks)
        toks = F.col("toks")
    rest = [c for c in arcs.columns if c not in ("head", "toks")]
    # A stemmed head has the stem of the noun it equals.
    head_noun = F.get(
        F.filter(
            F.transform(
                toks,
                lambda t, i: F.when(
                    (t["ptr"] == 0) & (t["word"] == F.col("head")) & is_noun(t, options.noun_on), i
                ),
            ),
            lambda i: i.isNotNull(),
        ),
        F.lit(0),
    )
    nouns = F.transform(toks, lambda t: F.when(is_noun(t, options.noun_on), t["word"]))
    wanted = "_nouns"
    if pairs_only:
        wanted = "CASE WHEN size(filter(_nouns, w -> w IS NOT NULL)) > 1 THEN _nouns END"
    return (
        arcs.select(*rest, "head", "toks", head_noun.alias("_at"), nouns.alias("_nouns"))
        .select(*rest, "head", "toks", "_at", stems_or_null(wanted).alias("_stems"))
        .select(
            *rest,
            F.coalesce(F.get("_stems", F.col("_at")), "head").alias("head"),
            F.zip_with("toks", "_stems", _replaced(options)).alias("toks"),
        )
    )


def _replaced(options: Options):
    def word_only(token: Column, stem: Column) -> Column:
        return F.struct(
            F.coalesce(stem, token["word"]).alias("word"),
            token["pos"].alias("pos"),
            token["label"].alias("label"),
            token["ptr"].alias("ptr"),
        )

    def everywhere(token: Column, stem: Column) -> Column:
        def swap(field: Column) -> Column:
            return F.when(
                stem.isNotNull() & (token["word"] != ""), F.replace(field, token["word"], stem)
            ).otherwise(field)

        return F.struct(
            F.coalesce(stem, token["word"]).alias("word"),
            swap(token["pos"]).alias("pos"),
            swap(token["label"]).alias("label"),
            token["ptr"].alias("ptr"),
        )

    return word_only if options.stem_scope == "word" else everywhere


def stem_labels(labels: DataFrame, options: Options = Options()) -> DataFrame:
    """``w1, w2, label`` with both words stemmed, as ``a, b, label``."""

    def prepared(name: str) -> str:
        return f"lower({name})" if options.lower else name

    rest = [c for c in labels.columns if c not in ("w1", "w2", "label")]
    return labels.select(
        *rest, stem(prepared("w1")).alias("a"), stem(prepared("w2")).alias("b"), "label"
    )
