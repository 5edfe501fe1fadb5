"""Bronze events to single messages, and the first and last message of each game."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelspark.functions import payloads as P
from duelspark.schemas import GAME


def explode_messages(bronze: DataFrame) -> DataFrame:
    """One row per message, ordered by (row_ord, msg_pos); summarized payloads are dropped."""
    return bronze.filter(~P.is_summarized(F.col("payload"))).select(
        *GAME, "row_ord", "player_id", "timestamp", "event",
        F.posexplode_outer(P.messages(F.col("payload"))).alias("msg_pos", "message"),
    )


def first_last(bronze: DataFrame) -> DataFrame:
    """First and last message of each game, by row order.

    Game-state payloads are left out before the grouping: they are most of the
    bytes, neither end of a game is read from them, and none is parsed here.
    """
    rows = bronze.filter(~P.is_summarized(F.col("payload")))
    place = F.col("row_ord")
    text = F.when(F.col("event") != P.GAME_EVENT, F.col("payload"))
    ends = rows.groupBy(*GAME).agg(
        F.min_by("player_id", place).alias("player_id"),
        F.min_by("timestamp", place).alias("first_time"),
        F.max_by("timestamp", place).alias("last_time"),
        F.min_by(text, place).alias("first"),
        F.max_by(text, place).alias("last"),
        F.count("*").alias("rows"),
    )
    last = P.messages(F.col("last"))
    return ends.select(
        *GAME, "player_id", "first_time", "last_time",
        F.get(P.messages(F.col("first")), F.lit(0)).alias("first_message"),
        F.get(last, F.size(last) - 1).alias("last_message"),
        "rows",
    )
