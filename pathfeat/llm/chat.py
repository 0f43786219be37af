"""Logged conversations reduced to the longest ones and rendered as training text.

Logs often hold cumulative snapshots: a conversation is stored again with every turn. A
hash is rolled over the turns of each conversation, so each of its beginnings has a hash
of its own. A conversation whose whole hash is that of a beginning of a longer one is
left out by an anti-join, and of equal conversations the least id stays. What remains is
rendered turn by turn.

Two 64-bit hashes of every turn, salted with its place, are combined by exclusive or.
Beginnings are made distinct before they are shuffled, so one that a third of all
conversations share is sent once per task. Only DataFrame functions are used.

Defined results: rows without a conversation id are left out; rows that agree in id,
turn, role and text count once; turns are ordered by number, role and text, nulls first;
a null text is rendered as empty, a null role as ``none``, and both differ from the
literal values when conversations are compared; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .columns import column

TURN = "<|%s|>\n%s\n"


def _turns(conversations: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    return (
        conversations.select(
            column(conversations, key, "key"),
            column(conversations, turn, "turn"),
            column(conversations, role, "role"),
            column(conversations, text, "text"),
        )
        .where("key is not null")
        .distinct()
    )


def beginnings(turns: DataFrame) -> DataFrame:
    """``key, n, h1, h2, last``: the hashes of the first n turns of each conversation."""
    order = Window.partitionBy("key").orderBy("turn", "role", "text")
    rolled = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    content = [F.col("role").isNull(), F.col("text").isNull(), F.col("role"), F.col("text")]
    placed = turns.select(
        "key",
        "turn",
        "role",
        "text",
        F.row_number().over(order).alias("n"),
        F.lead(F.lit(False), 1, True).over(order).alias("last"),
    )
    return placed.select(
        "key",
        "n",
        "last",
        F.bit_xor(F.xxhash64("n", *content)).over(rolled).alias("h1"),
        F.bit_xor(F.xxhash64(F.lit(1), "n", *content)).over(rolled).alias("h2"),
    )


def maximal(turns: DataFrame) -> DataFrame:
    """``key, n_turns, n_copies`` of the conversations that no longer one begins with."""
    hashed = beginnings(turns)
    whole = (
        hashed.where("last")
        .groupBy("n", "h1", "h2")
        .agg(F.min("key").alias("key"), F.count("*").alias("n_copies"))
    )
    shorter = hashed.where("not last").select("n", "h1", "h2").distinct()
    kept = whole.join(shorter, ["n", "h1", "h2"], "left_anti")
    return kept.select("key", F.col("n").cast("bigint").alias("n_turns"), "n_copies")


def chat_texts(
    conversations: DataFrame,
    key: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """``key, n_turns, n_copies, text`` of every maximal conversation; ``n_copies`` counts
    the equal ones, and the text has ``TURN`` for each turn."""
    turns = _turns(conversations, key, turn, role, text)
    rows = turns.join(maximal(turns), "key").groupBy("key", "n_turns", "n_copies")
    head, middle, tail = TURN.split("%s")
    ordered = F.array_sort(
        F.collect_list(F.struct("turn", "role", "text")),
        lambda x, y: F.coalesce(
            *[_compared(x[c], y[c]) for c in ("turn", "role", "text")], F.lit(0)
        ),
    )
    rendered = F.transform(
        ordered,
        lambda t: F.concat(
            F.lit(head),
            F.coalesce(t["role"], F.lit("none")),
            F.lit(middle),
            F.coalesce(t["text"], F.lit("")),
            F.lit(tail),
        ),
    )
    return rows.agg(F.array_join(rendered, "").alias("text")).select(
        F.col("key").alias(key), "n_turns", "n_copies", "text"
    )


def _compared(x: F.Column, y: F.Column) -> F.Column:
    """-1 or 1 where values differ, nulls first; null where they don't."""
    return (
        F.when(x.eqNullSafe(y), F.lit(None))
        .when(x.isNull() | (x < y), F.lit(-1))
        .otherwise(F.lit(1))
        .cast("int")
    )
