"""Expressions over card arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def expand(counts: Column) -> Column:
    """[{cardId, quantity}] to a flat list of ids, one per copy, in list order."""
    return F.flatten(F.transform(counts, lambda c: F.array_repeat(c["cardId"], c["quantity"])))


def readable(counts: Column) -> Column:
    """Whether every entry has a card and a number; one that lacks either makes the whole deck unknown."""
    return F.forall(counts, lambda c: c["cardId"].isNotNull() & c["quantity"].isNotNull())


def flat_deck(counts: Column) -> Column:
    """Main deck as a sorted flat list; NULL counts give an empty list."""
    return F.coalesce(F.array_sort(expand(counts)), F.expr("cast(array() as array<bigint>)"))


def id_list_hash(ids: Column) -> Column:
    """SHA-256 of the JSON text of an id list, written as ``[1, 2]``."""
    return F.sha2(F.concat(F.lit("["), F.array_join(ids.cast("array<string>"), ", "), F.lit("]")), 256)


def count_list_hash(counts: Column) -> Column:
    """SHA-256 of ``[{"cardId": 7, "quantity": 2}]``; a missing list hashes as ``null``."""
    entries = F.transform(
        counts,
        lambda c: F.concat(
            F.lit('{"cardId": '), c["cardId"].cast("string"),
            F.lit(', "quantity": '), c["quantity"].cast("string"), F.lit("}"),
        ),
    )
    text = F.concat(F.lit("["), F.array_join(entries, ", "), F.lit("]"))
    return F.sha2(F.coalesce(text, F.lit("null")), 256)


def multiset_within(part: Column, whole: Column) -> Column:
    """Whether every card of ``part`` occurs at least as often in ``whole``."""
    return F.forall(
        F.array_distinct(part),
        lambda c: F.size(F.filter(part, lambda p: p == c)) <= F.size(F.filter(whole, lambda w: w == c)),
    )


def join_colors(letters: Column) -> Column:
    return F.coalesce(F.array_join(letters, ""), F.lit(""))


def before_query(uri: Column) -> Column:
    return F.substring_index(uri, "?", 1)
