"""The head graph of a line.

Positions count from 1. Tokens with equal descriptors are one node, named by the
first such position. A node's parent is the node its pointer names; pointer 0
names the root, the first token with the head's word and pointer 0. Parent 0 means
that there is none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.tokens import is_noun
from ..options import Options


def with_graph(arcs: DataFrame, options: Options = Options()) -> DataFrame:
    """Add ``_canon``, ``_par``, ``_noun`` (arrays by position) and ``_nouns`` (positions)."""
    # Only a repeated word can repeat a token. array_position outside generated code
    # leaves its loop by an exception, so it is kept for the lines that need it.
    canon = """CASE WHEN size(array_distinct(_words)) = size(_words) THEN sequence(1, size(toks))
        ELSE transform(toks, t -> cast(array_position(toks, t) AS int)) END"""
    root = """coalesce(get(filter(sequence(1, size(toks)),
        p -> get(toks, p - 1).ptr = 0 AND get(_words, p - 1) = head), 0), 0)"""
    noun = F.transform("toks", lambda t: is_noun(t, options.noun_on))
    return (
        arcs.withColumn("_words", F.col("toks.word"))
        .withColumns({"_canon": F.expr(canon), "_root": F.expr(root), "_noun": noun})
        .withColumns(
            {
                "_par": F.expr(
                    "transform(toks, t -> CASE WHEN t.ptr = 0 THEN _root ELSE get(_canon, t.ptr - 1) END)"
                ),
                "_nouns": F.expr("filter(sequence(1, size(toks)), p -> get(_noun, p - 1))"),
            }
        )
        .drop("_root", "_words")
    )


def head_graph(arcs: DataFrame, options: Options = Options()) -> DataFrame:
    """One row per token of a stemmed line: ``k, node, parent``."""
    rest = [c for c in arcs.columns if c not in ("head", "toks")]
    return with_graph(arcs, options).select(
        *rest,
        F.inline(
            F.zip_with(
                F.transform("_canon", lambda c, i: F.struct((i + 1).alias("k"), c.alias("node"))),
                "_par",
                lambda c, p: F.struct(c["k"].alias("k"), c["node"].alias("node"), p.alias("parent")),
            )
        ),
    )


def first_half_bound() -> Column:
    """Position of the last noun in the first half (rounded up) of a line's nouns."""
    half = F.ceil(F.size("_nouns") / 2).cast("int")
    return F.get("_nouns", half - 1)


def noun_pairs(arcs: DataFrame, options: Options = Options()) -> DataFrame:
    """Noun pairs of a stemmed line that are tested for a path, in both orders.

    ``i`` and ``j`` are positions of nouns with different words. With
    ``pair_scope='first_half'`` the earlier noun of the pair must be in the first
    half of the line's nouns.
    """
    rest = [c for c in arcs.columns if c not in ("head", "toks")]
    first = F.explode(F.coalesce("_nouns", F.array().cast("array<int>"))).alias("i")
    # All tests are inside the generator: a filter above it would be pushed, as a test
    # for nulls, below the projections that stem the line and stem it again.
    test = "p <> i AND get(_w, p - 1) <> get(_w, i - 1)"
    if options.pair_scope == "first_half":
        test += " AND least(p, i) <= _half"
    return (
        with_graph(arcs, options)
        .select(*rest, F.col("toks.word").alias("_w"), "_nouns", first_half_bound().alias("_half"), first)
        .select(*rest, "_w", "i", F.expr(f"explode(filter(_nouns, p -> {test})) AS j"))
        .select(
            *rest,
            "i",
            "j",
            F.get("_w", F.col("i") - 1).alias("a"),
            F.get("_w", F.col("j") - 1).alias("b"),
        )
    )
