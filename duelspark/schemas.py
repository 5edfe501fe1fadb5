"""Schemas of every relation, as DDL strings.

Payload schemas are narrow: they name only the fields that some operator
reads, so ``from_json`` skips the rest of each message.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StructType

LINES = "source_file STRING, block STRUCT<part: BIGINT, file: STRING, start: BIGINT>, pos BIGINT, line STRING"

BRONZE = (
    "source_file STRING, game_num INT, row_ord BIGINT, player_id STRING, "
    "timestamp STRING, event STRING, payload STRING"
)

# The columns of landed CSV files, in order.
LANDING = "game_num INT, player_id STRING, timestamp STRING, event STRING, payload STRING"

GAME = ["source_file", "game_num"]

CARD_COUNT = "ARRAY<STRUCT<cardId: BIGINT, quantity: INT>>"

DECK_REQUEST = (
    "Summary STRUCT<Name: STRING, Attributes: ARRAY<STRUCT<name: STRING, value: STRING>>>, "
    f"Deck STRUCT<MainDeck: {CARD_COUNT}, Sideboard: {CARD_COUNT}, CommandZone: {CARD_COUNT}>"
)

GAME_MESSAGE = (
    "type STRING, systemSeatIds ARRAY<INT>, gameStateMessage STRUCT<"
    "zones: ARRAY<STRUCT<zoneId: INT, type: STRING, objectInstanceIds: ARRAY<BIGINT>>>, "
    "gameObjects: ARRAY<STRUCT<instanceId: BIGINT, grpId: BIGINT>>, "
    "players: ARRAY<STRUCT<systemSeatNumber: INT, mulliganCount: INT>>, "
    "turnInfo: STRUCT<phase: STRING>>"
)

ROOM_INFO = (
    "gameRoomConfig STRUCT<matchId: STRING, reservedPlayers: "
    "ARRAY<STRUCT<userId: STRING, playerName: STRING, systemSeatId: INT, teamId: INT>>>, "
    "stateType STRING, "
    "finalMatchResult STRUCT<resultList: ARRAY<STRUCT<scope: STRING, winningTeamId: INT>>>"
)

CARD_BULK = (
    "arena_id BIGINT, oracle_id STRING, name STRING, released_at DATE, scryfall_uri STRING, "
    "mana_cost STRING, cmc DOUBLE, colors ARRAY<STRING>, color_identity ARRAY<STRING>, "
    "type_line STRING, `set` STRING, set_name STRING, set_type STRING, rarity STRING, "
    "legalities MAP<STRING, STRING>"
)


@dataclass(frozen=True)
class TableSpec:
    """One stored table: columns, key, columns that may not be NULL, file layout."""

    ddl: str
    key: tuple[str, ...]
    required: tuple[str, ...]
    layout: tuple[str, ...] = ()

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


BATCH = {
    "bronze": TableSpec(BRONZE, ("source_file", "row_ord"), ("source_file", "game_num", "row_ord")),
    "quarantine": TableSpec(
        "source_file STRING, game_num INT, row_ord BIGINT, reason STRING, line STRING",
        ("source_file", "row_ord"), ("source_file", "reason"),
    ),
    "manifest": TableSpec(
        "source_file STRING, games BIGINT, `rows` BIGINT, status STRING", ("source_file",), ("source_file", "status")
    ),
    # What the next lines of a log need to know of those before; one row per log and run.
    "state": TableSpec(
        "source_file STRING, length BIGINT, lines BIGINT, games INT, mark STRING, head STRING, deck STRING, tail BIGINT",
        ("source_file", "lines"), ("source_file", "length", "lines"),
    ),
}

RATE = "DECIMAL(38, 9)"

SILVER = {
    "players": TableSpec(
        "player_id STRING, display_name STRING", ("player_id",), ("player_id",)
    ),
    "dim_cards": TableSpec(
        "arena_id BIGINT, oracle_id STRING, card_name STRING, scryfall_uri STRING, "
        "mana_cost STRING, cmc BIGINT, colors STRING, color_identity STRING, type_line STRING, "
        "set_code STRING, set_name STRING, set_type STRING, rarity STRING",
        ("arena_id",),
        ("arena_id", "oracle_id"),
    ),
    "matches": TableSpec(
        "match_id BIGINT, deck_id BIGINT, player_id STRING, player_seat INT, "
        "start_time TIMESTAMP, duration_sec BIGINT, winner_seat INT, game_format STRING, "
        "draw_order ARRAY<STRUCT<cards: ARRAY<BIGINT>>>, match_key STRING",
        ("match_id",),
        ("match_id", "deck_id", "start_time"),
        ("player_id", "deck_id"),
    ),
    "decks": TableSpec(
        "deck_id BIGINT, player_id STRING, match_id BIGINT, set_code STRING, deck_name STRING, "
        "deck_list ARRAY<BIGINT>, deck_sideboard ARRAY<BIGINT>, deck_commander STRING, "
        "deck_hash STRING, side_hash STRING",
        ("deck_id",),
        ("deck_id", "player_id", "match_id"),
        ("player_id",),
    ),
    "turn1_hands": TableSpec(
        "hand_id BIGINT, player_id STRING, match_id BIGINT, initial_hand ARRAY<BIGINT>, "
        "mulliganCount INT, discarded ARRAY<BIGINT>, went_first BOOLEAN",
        ("hand_id",),
        ("hand_id", "player_id", "match_id"),
        ("match_id", "player_id"),
    ),
}

GOLD = {
    "player_metrics": TableSpec(
        "player_id STRING, display_name STRING, total_matches BIGINT, total_wins BIGINT, "
        f"total_losses BIGINT, win_rate {RATE}, win_rate_30d {RATE}, avg_duration_sec {RATE}, "
        f"avg_mulligans {RATE}, mulligan0_win_rate {RATE}, mulligan1_win_rate {RATE}, "
        f"mulligan2_win_rate {RATE}, most_played_deck_id BIGINT, most_played_deck_name STRING, "
        "time_last_played TIMESTAMP",
        ("player_id",),
        ("player_id",),
    ),
    "deck_metrics": TableSpec(
        "deck_id BIGINT, deck_name STRING, player_id STRING, display_name STRING, "
        f"avg_duration_sec {RATE}, total_matches BIGINT, total_wins BIGINT, win_rate {RATE}, "
        f"avg_mulligans {RATE}, mulligan0_win_rate {RATE}, mulligan1_win_rate {RATE}, "
        f"mulligan2_win_rate {RATE}, colors STRING, cmc_curve ARRAY<BIGINT>, cmc_avg {RATE}, "
        "matchup_winrate ARRAY<STRUCT<opp_colors: STRING, total_matches: BIGINT, "
        f"total_wins: BIGINT, total_losses: BIGINT, win_rate: {RATE}>>",
        ("deck_id",),
        ("deck_id",),
        ("player_id",),
    ),
    "card_metrics": TableSpec(
        "player_id STRING, deck_id BIGINT, arena_id BIGINT, card_name STRING, "
        f"win_rate_draw {RATE}, win_rate_opener {RATE}, total_in_deck BIGINT, draw_chance {RATE}",
        ("player_id", "deck_id", "arena_id"),
        ("player_id", "deck_id", "arena_id"),
        ("player_id", "deck_id"),
    ),
}

_COUNTS = ["matches", "wins", "losses", "duration", "timed", "mulligans", "handed"] + [
    f"{what}_m{n}" for what in ("matches", "wins") for n in (0, 1, 2)
]

#: Sums per player, deck and day that are kept up to date, and how far they go.
DAYS = {
    "player_deck_days": TableSpec(
        "run STRING, player_id STRING, deck_id BIGINT, day BIGINT, " + ", ".join(f"{c} BIGINT" for c in _COUNTS) + ", last_start TIMESTAMP",
        ("run", "player_id", "deck_id", "day"),
        ("run", "player_id", "deck_id"),
        ("player_id", "deck_id"),
    ),
    "gold_runs": TableSpec("run STRING, upto_match BIGINT, upto_hand BIGINT", ("run",), ("run", "upto_match", "upto_hand")),
}
