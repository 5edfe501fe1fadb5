"""Distinct decks, and decks as (deck, card, copies) rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelspark.schemas import GAME

CONTENT = ["deck_hash", "side_hash"]
#: What tells stored decks apart if they also differ by name.
NAMED = ["deck_name", "deck_commander", *CONTENT]
FACTS = ["player_id", "match_key", "deck_name", "deck_list", "deck_sideboard", "deck_commander"]


def by_content(games: DataFrame, keys: list[str] = CONTENT) -> DataFrame:
    """Decks with equal ``keys`` (equal cards) are one deck; the first game keeps name and owner."""
    facts = [c for c in [*CONTENT, *FACTS] if c not in keys]
    return (
        games.groupBy(*keys)
        .agg(F.min_by(F.struct(*facts), F.struct(*GAME)).alias("d"))
        .select(*keys, F.lit("").alias("set_code"), "d.*")
    )


def by_name_and_content(games: DataFrame) -> DataFrame:
    """Decks also differ by name and commander; missing parts count as equal."""
    return (
        games.groupBy("deck_name", "deck_content")
        .agg(F.min_by(F.struct(*CONTENT, *FACTS), F.struct(*GAME)).alias("d"))
        .select(F.lit("").alias("set_code"), "d.*")
    )


def deck_cards(decks: DataFrame) -> DataFrame:
    """(deck_id, arena_id, copies)."""
    return (
        decks.select("deck_id", F.explode("deck_list").alias("arena_id"))
        .groupBy("deck_id", "arena_id")
        .agg(F.count("*").alias("copies"))
    )
