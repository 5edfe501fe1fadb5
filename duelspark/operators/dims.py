"""The card dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelspark.functions import cards as C

LOCAL_COLUMNS = [
    "arena_id", "oracle_id", "name", "released_at", "scryfall_uri", "mana_cost", "cmc", "colors",
    "color_identity", "type_line", "set", "set_name", "set_type", "rarity", "legalities",
]


def on_client(cards: DataFrame) -> DataFrame:
    """Cards that exist in the client."""
    return cards.filter(F.col("arena_id").isNotNull() & (F.col("arena_id") != 0))


def first_per_id(cards: DataFrame, order: list[str]) -> DataFrame:
    """One row per arena_id, the first in file order."""
    columns = [c for c in cards.columns if c not in order]
    return (
        cards.groupBy("arena_id")
        .agg(F.min_by(F.struct(*[c for c in columns if c != "arena_id"]), F.struct(*order)).alias("c"))
        .select("arena_id", "c.*")
    )


def dim_cards(cards: DataFrame) -> DataFrame:
    """Warehouse form: flat color strings and whole-number costs."""
    return on_client(cards).select(
        "arena_id",
        "oracle_id",
        F.col("name").alias("card_name"),
        C.before_query(F.col("scryfall_uri")).alias("scryfall_uri"),
        "mana_cost",
        F.col("cmc").cast("bigint").alias("cmc"),
        C.join_colors(F.col("colors")).alias("colors"),
        C.join_colors(F.col("color_identity")).alias("color_identity"),
        "type_line",
        F.col("set").alias("set_code"),
        "set_name",
        "set_type",
        "rarity",
    )


def local_cards(cards: DataFrame) -> DataFrame:
    """File form: all rows with an id, nested columns kept."""
    return (
        cards.filter(F.col("arena_id").isNotNull())
        .withColumn("scryfall_uri", C.before_query(F.col("scryfall_uri")))
        .select(*LOCAL_COLUMNS)
    )
