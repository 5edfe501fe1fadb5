"""Chat formatting with Spark expressions only.

A turn is ``<|turn|>role<|text|>text<|end|>``. Adjacent turns of one role are
one turn of the output, their texts joined by ``<|next|>``, so that they can be
told apart again. Control strings inside roles and texts get a backslash after
their first character (one more, if they have some), which ``unescaped`` takes
away.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, TEXT, NEXT, END = "<|turn|>", "<|text|>", "<|next|>", "<|end|>"

#: What follows the first character of a control string, of this template or of common others.
FOLLOWS = r"\\*(?:\||/?s>|/?INST\]|</?SYS>>)"
ESCAPE = rf"([<\[])({FOLLOWS})"
UNESCAPE = rf"([<\[])\\({FOLLOWS})"

#: Turns whose order is settled in one group before the groups of a conversation are joined.
TURNS_PER_BLOCK = 64


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPE, r"$1\\$2")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, UNESCAPE, "$1$2")


def header(role: Column) -> Column:
    return F.concat(F.lit(TURN), role, F.lit(TEXT))


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def joined(units: Column) -> Column:
    """One unit of an array of them.

    A unit is (first, last, n, body, loss): roles of its first and last turn,
    number of turns, text from behind its first header up to its last end mark,
    and spans of the loss mask counted from the start of ``body``. Units that
    meet in the same role are merged.
    """

    def piece(units, unit, i):
        met = F.get(units, i - 1).getField("last") == unit.getField("first")
        apart = F.concat(F.lit(END), header(unit.getField("first")))
        return F.concat(F.when(i == 0, F.lit("")).when(met, F.lit(NEXT)).otherwise(apart), unit.getField("body"))

    def summed(lengths):
        return F.aggregate(
            lengths, F.array(F.lit(0)), lambda done, n: F.concat(done, F.array(F.element_at(done, -1) + n))
        )

    def moved(unit, start):
        return F.transform(
            unit.getField("loss"),
            lambda span: F.struct((span.getField("start") + start).alias("start"), span.getField("length").alias("length")),
        )

    def all_of(units, pieces, ends):
        # The body of a unit ends where its piece ends.
        start = lambda unit, i: F.get(ends, i + 1) - F.char_length(unit.getField("body"))
        return F.struct(
            F.get(units, F.lit(0)).getField("first").alias("first"),
            F.element_at(units, -1).getField("last").alias("last"),
            F.aggregate(units, F.lit(0).cast("long"), lambda n, unit: n + unit.getField("n")).alias("n"),
            F.array_join(pieces, "").alias("body"),
            F.flatten(F.transform(units, lambda unit, i: moved(unit, start(unit, i)))).alias("loss"),
        )

    return let(
        units,
        lambda u: let(
            F.transform(u, lambda unit, i: piece(u, unit, i)),
            lambda p: let(summed(F.transform(p, lambda x: F.char_length(x))), lambda e: all_of(u, p, e)),
        ),
    )


def format_chat(rows: DataFrame, learned: str = "assistant", turns_per_block: int = TURNS_PER_BLOCK) -> DataFrame:
    """conv_id, n_turns, formatted, loss (array of start, length in code points) of every conversation.

    Input: conv_id, turn, role, text; other columns are ignored. Turns are sorted
    by turn, equal ones by role and text; a null turn comes first, a null role or
    text is empty, rows without conv_id are one conversation. Repeated rows are
    turns of their own. ``loss`` covers each text of the role ``learned``, in order.
    A long conversation is sorted and joined in blocks of turns first.
    """
    role, text = (escaped(F.coalesce(F.col(c), F.lit(""))) for c in ("role", "text"))
    turn = F.struct("turn", role.alias("role"), text.alias("body"))
    as_unit = lambda t: F.struct(
        t.getField("role").alias("first"),
        t.getField("role").alias("last"),
        F.lit(1).cast("long").alias("n"),
        t.getField("body").alias("body"),
        F.when(
            t.getField("role") == F.lit(learned),
            F.array(F.struct(F.lit(0).alias("start"), F.char_length(t.getField("body")).alias("length"))),
        ).otherwise(F.array().cast("array<struct<start:int,length:int>>")).alias("loss"),
    )
    blocks = (
        rows.groupBy("conv_id", F.floor(F.col("turn") / turns_per_block).alias("block"))
        .agg(F.sort_array(F.collect_list(turn)).alias("turns"))
        .select("conv_id", "block", F.transform("turns", as_unit).alias("units"))
        .select("conv_id", "block", joined(F.col("units")).alias("unit"))
    )
    whole = (
        blocks.groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(F.struct("block", "unit"))).alias("blocks"))
        .select("conv_id", F.col("blocks.unit").alias("units"))
        .select("conv_id", joined(F.col("units")).alias("all"))
    )
    first = header(F.col("all.first"))
    return whole.select(
        "conv_id",
        F.col("all.n").alias("n_turns"),
        F.concat(first, F.col("all.body"), F.lit(END)).alias("formatted"),
        F.transform(
            "all.loss",
            lambda span: F.struct(
                (span.getField("start") + F.char_length(first)).alias("start"), span.getField("length").alias("length")
            ),
        ).alias("loss"),
    )


def turns_of(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text), merged ones apart again."""
    literal = lambda mark: rf"\Q{mark}\E"
    merged = F.filter(F.split(formatted, literal(END)), lambda part: part != "")
    split = F.transform(merged, lambda part: F.split(part, literal(TEXT)))
    return F.flatten(
        F.transform(
            split,
            lambda part: F.transform(
                F.split(part[1], literal(NEXT)),
                lambda text: F.struct(
                    unescaped(F.substr(part[0], F.lit(len(TURN) + 1))).alias("role"), unescaped(text).alias("text")
                ),
            ),
        )
    )


def learned_text(formatted: Column, loss: Column) -> Column:
    """The text under the loss mask, unescaped, nothing between its spans."""
    return F.array_join(
        F.transform(
            loss,
            lambda span: unescaped(F.substr(formatted, span.getField("start") + 1, span.getField("length"))),
        ),
        "",
    )
