"""Phrase collocations by best-first growth with admissible score bounds.

Phrases of two and three words of one language are scored by the weakest of their cuts:
a * a / (l * r), with a the occurrences of the phrase and l and r those of the two parts.
A phrase grows from its first two words, its prefix. It occurs at most as often as any
part of it, so no phrase of three words can score above

    count(prefix) / count(first word)

which is also no less than the prefix's own score. Prefixes are grown in the order of this
bound, best first: a round takes all whose bound reaches a level, counts their phrases of
three words, and those that end in a phrase of two words that itself reaches the level,
as these decide whether it survives. From then on every score at or above the level is
settled. A language is done when it has ``most`` surviving scores there, ties included;
the others go on at the level that lets four times as many phrases in, until nothing is
left to grow. Words and prefixes below ``least`` occurrences never grow.

The counts are aggregates over all texts, partial ones per task first, so a word or
phrase with a third of all occurrences sends one row per task. The frontier is looked up
in the tasks before the shuffle while its size, which is measured, is below
``broadcast_bytes``; beyond that phrases are counted first and joined by their parts. Both
give the same rows. Levels come from counts per score, of which there are a million at
most, and a language's rows are cut to ``most`` in parts before they meet.

Defined results: a null or empty text has no words; a null language is ``und``; repeated
rows count each time and ids are not read; ties of the score go to the larger count,
then to the smaller phrase in UTF-8 order; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from functools import reduce
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.staging import Staging, stage, staging_root
from .columns import column

# What parts pieces and words, and the scale of a score.
PIECE_ENDS = r"[.,;:!?\x0A-\x0D]"
WORD_GAPS = r"[\x20\x09]+"
SCALE = 1_000_000

_GROWTH = 4
_PARTS = 64
_ROW_BYTES = 64  # of a row in a broadcast table, beside its texts


def word_triples(docs: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """``lang, x, y, z``: every word with the two that follow it in its piece, or null."""
    lowered = F.translate(column(docs, text), ascii_uppercase, ascii_lowercase)
    language = F.coalesce(column(docs, lang).cast("string"), F.lit("und")).alias("lang")
    pieces = docs.select(language, F.explode(F.split(lowered, PIECE_ENDS)).alias("piece"))
    words = F.filter(F.split("piece", WORD_GAPS), lambda w: w != "").alias("w")
    after = lambda n: F.slice("w", F.lit(n + 1), F.size("w"))
    zipped = F.arrays_zip(F.col("w"), after(1).alias("y"), after(2).alias("z"))
    # The generator is fed by a projection of its own, which builds each array once.
    return pieces.select("lang", words).select("lang", F.inline(zipped).alias("x", "y", "z"))


def _frequent(rows: DataFrame, by: list[str], least: int) -> DataFrame:
    counted = rows.groupBy("lang", *by).agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= least)


def _bytes(keys: DataFrame) -> int:
    texts = sum((F.octet_length(c) for c in keys.columns), F.lit(_ROW_BYTES))
    return keys.agg(F.coalesce(F.sum(texts), F.lit(0)).alias("n")).first()["n"]


def _score(a: Column, left: Column, right: Column) -> Column:
    wide = lambda c: c.cast("decimal(19,0)")
    whole = (wide(a) * wide(a)).cast("decimal(31,0)") * F.lit(SCALE).cast("decimal(7,0)")
    return F.call_function("div", whole, (wide(left) * wide(right)).cast("decimal(38,0)"))


class _Growth:
    """The words and pairs of one search, and what rounds count from them."""

    def __init__(self, triples: DataFrame, least: int, broadcast_bytes: int) -> None:
        self.triples, self.least, self.broadcast_bytes = triples, least, broadcast_bytes
        all_words = stage(triples.groupBy("lang", "x").agg(F.count(F.lit(1)).alias("n")), "words")
        self.sizes = stage(all_words.groupBy("lang").agg(F.sum("n").alias("total")), "sizes")
        self.words = all_words.where(F.col("n") >= least)
        pairs = triples.where(F.col("y").isNotNull())
        known = self.words.select("lang", "x")
        if _bytes(known) <= broadcast_bytes:
            pairs = pairs.join(F.broadcast(known), ["lang", "x"], "left_semi")
            known = known.withColumnRenamed("x", "y")
            pairs = pairs.join(F.broadcast(known), ["lang", "y"], "left_semi")
        counted = _frequent(pairs, ["x", "y"], least)
        left = self.words.withColumnsRenamed({"n": "l"})
        right = self.words.withColumnsRenamed({"x": "y", "n": "r"})
        a, l, r = F.col("n"), F.col("l"), F.col("r")
        bound = F.call_function("div", a * SCALE, l)
        scored = counted.join(left, ["lang", "x"]).join(right, ["lang", "y"])
        self.pairs = stage(
            scored.select(
                "lang", "x", "y", a, l, r, _score(a, l, r).alias("score"), bound.alias("bound")
            ),
            "pairs",
        )

    def levels(self, size: int) -> DataFrame:
        """``lang, next``: the score that ``size`` pairs reach, none if there are fewer."""
        down = Window.partitionBy("lang").orderBy(F.desc("score"))
        scores = self.pairs.groupBy("lang", "score").agg(F.count(F.lit(1)).alias("n"))
        above = scores.select("lang", "score", F.sum("n").over(down).alias("upto"))
        return above.where(F.col("upto") >= size).groupBy("lang").agg(F.max("score").alias("next"))

    def grow(self, levels: DataFrame) -> DataFrame:
        """Counts of the phrases of three words that levels ``lang, level, before`` let in
        and those before did not."""
        pairs = self.pairs.join(levels, "lang")
        fresh = lambda c: (F.col(c) >= F.col("level")) & (F.col(c) < F.col("before"))
        heads = stage(pairs.where(fresh("bound")).select("lang", "x", "y"), "heads")
        tails = pairs.where(fresh("score")).select("lang", F.col("x").alias("y"), F.col("y").alias("z"))
        tails = stage(tails, "tails")
        rows = self.triples.where(F.col("z").isNotNull())
        small = _bytes(heads) + _bytes(tails) <= self.broadcast_bytes
        if not small:
            rows = _frequent(rows, ["x", "y", "z"], self.least)
        sides = [side.withColumn(f"_{i}", F.lit(True)) for i, side in enumerate((heads, tails))]
        for side in sides:
            on = side.columns[:3]
            rows = rows.join(F.broadcast(side) if small else side, on, "left")
        rows = rows.where(F.col("_0").isNotNull() | F.col("_1").isNotNull()).drop("_0", "_1")
        return _frequent(rows, ["x", "y", "z"], self.least) if small else rows

    def scored(self, counted: DataFrame) -> DataFrame:
        """Phrases of three words with the cut of least score, the earlier one of two."""
        n = F.col("n")
        pair = lambda x, y, c: self.pairs.select(
            "lang", F.col("x").alias(x), F.col("y").alias(y), F.col("n").alias(c)
        )
        word = lambda x, c: self.words.select("lang", F.col("x").alias(x), F.col("n").alias(c))
        rows = (
            counted.join(pair("x", "y", "l2"), ["lang", "x", "y"])
            .join(pair("y", "z", "r1"), ["lang", "y", "z"])
            .join(word("x", "l1"), ["lang", "x"])
            .join(word("z", "r2"), ["lang", "z"])
        )
        first, second = _score(n, F.col("l1"), F.col("r1")), _score(n, F.col("l2"), F.col("r2"))
        rows = rows.withColumns({"s1": first, "s2": second})
        one = F.col("s1") <= F.col("s2")
        pick = lambda a, b: F.when(one, F.col(a)).otherwise(F.col(b))
        return rows.select(
            "lang", "x", "y", "z", "n",
            pick("l1", "l2").alias("l"), pick("r1", "r2").alias("r"), pick("s1", "s2").alias("score"),
        )

    def survivors(
        self, phrases: DataFrame, levels: DataFrame, covered: tuple[int, int]
    ) -> DataFrame:
        """Every surviving phrase whose score reaches its language's level."""
        share, of = covered
        n, longer = F.col("n"), F.col("longer")
        inside = [
            phrases.select("lang", F.col(a).alias("x"), F.col(b).alias("y"), n.alias("longer"))
            for a, b in (("x", "y"), ("y", "z"))
        ]
        longest = inside[0].unionByName(inside[1]).groupBy("lang", "x", "y").agg(F.max("longer").alias("longer"))
        reaching = lambda rows: rows.join(levels, "lang").where(F.col("score") >= F.col("level"))
        pairs = reaching(self.pairs).join(longest, ["lang", "x", "y"], "left")
        pairs = pairs.where(longer.isNull() | (of * longer < share * n))
        value = ["lang", "n", "l", "r", "score"]
        name = lambda *c: F.concat_ws(" ", *c).alias("phrase")
        return pairs.select(name("x", "y"), *value).unionByName(
            reaching(phrases).select(name("x", "y", "z"), *value)
        )


def collocations(
    docs: DataFrame,
    least: int = 10,
    most: int = 2000,
    covered: tuple[int, int] = (50, 100),
    start: int | None = None,
    broadcast_bytes: int = 16 << 20,
    lang: str = "lang",
    text: str = "text",
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's first ``most`` phrases.

    ``covered`` is the share of a phrase's occurrences, as two numbers, that a longer one
    must have to drop it. ``start`` is the number of pairs the first round lets in, twice
    ``most`` unless given; it changes the number of rounds and not the result. Tables on
    the way are deleted.
    """
    own = Staging(staging_root(docs.sparkSession))
    with own:
        growth = _Growth(word_triples(docs, lang, text), least, broadcast_bytes)
        settled = _settled(growth, covered, most, start or 2 * most)
    result = stage(_ranked(settled, growth.sizes, most), "collocations")
    own.close()
    return result


def _settled(growth: _Growth, covered: tuple[int, int], most: int, size: int) -> DataFrame:
    level = F.col("level")
    state = growth.sizes.select(
        "lang", F.lit(SCALE + 1).cast("bigint").alias("level"), F.lit(True).alias("open")
    )
    parts: list[DataFrame] = []
    while True:
        # A settled language keeps its level, which lets nothing more in.
        lower = F.least(F.coalesce("next", F.lit(0)), level)
        levels = state.join(growth.levels(size), "lang", "left").select(
            "lang", F.when(F.col("open"), lower).otherwise(level).alias("level"), level.alias("before")
        )
        levels = stage(levels, "levels")
        parts.append(stage(growth.scored(growth.grow(levels)), "phrases"))
        phrases = reduce(DataFrame.unionByName, parts).dropDuplicates(["lang", "x", "y", "z"])
        settled = stage(growth.survivors(phrases, levels.select("lang", "level"), covered), "settled")
        have = settled.groupBy("lang").agg(F.count(F.lit(1)).alias("have"))
        left = (F.coalesce("have", F.lit(0)) < most) & (level > 0)
        state = stage(levels.join(have, "lang", "left").select("lang", "level", left.alias("open")), "state")
        if not state.where("open").head(1):
            return settled
        size *= _GROWTH


def _ranked(settled: DataFrame, sizes: DataFrame, most: int) -> DataFrame:
    """The first rows of every language, first of each part of it."""
    order = [F.desc("score"), F.desc("n"), F.col("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(_PARTS))
    first = settled.withColumn("_part", part)
    for by in (["lang", "_part"], ["lang"]):
        rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        first = first.withColumn("rank", rank).where(F.col("rank") <= most)
    return first.join(sizes, "lang").select(
        "lang", "rank", "phrase", F.col("n").alias("a"), "l", "r", F.col("total").alias("n"), "score"
    )
