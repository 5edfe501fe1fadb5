"""Expressions over one raw log line."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the log format.
PREFIX = "[UnityCrossThreadLogger]"
DECK_CALL = PREFIX + "==> DeckUpsertDeckV2"
START_TEXTS = [
    PREFIX + 'STATE CHANGED {"old":"ConnectedToMatchDoor_ConnectedToGRE_Waiting","new":"Playing"}',
    PREFIX + 'STATE CHANGED {"old":"ConnectedToMatchDoor_ConnectingToGRE","new":"Playing"}',
]
END_TEXT = PREFIX + 'STATE CHANGED {"old":"Playing","new":"MatchCompleted"}'
UNWANTED = ["ClientToGreuimessage", "ClientToGremessage", "==>", "Client.TcpConnection.Close"]
# Characters that Python counts as whitespace.
WHITESPACE = "".join(
    chr(c)
    for c in [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
              0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)

# Line kinds, see ``kind``.
DECK, START, END = "deck", "start", "end"
INLINE, HEAD, BAD, SKIP, TEXT = "inline", "head", "bad", "skip", "text"


def strip(line: Column) -> Column:
    return F.btrim(line, F.lit(WHITESPACE))


def is_start(line: Column) -> Column:
    return line.startswith(START_TEXTS[0]) | line.startswith(START_TEXTS[1])


def is_end(line: Column) -> Column:
    return line.startswith(END_TEXT)


def is_deck(line: Column) -> Column:
    return line.contains(DECK_CALL)


def has_prefix(line: Column) -> Column:
    return line.startswith(PREFIX)


def is_unwanted(line: Column) -> Column:
    hit = F.lit(False)
    for word in UNWANTED:
        hit = hit | line.contains(word)
    return hit


def metadata(line: Column) -> Column:
    """Header text without the prefix, up to the first brace."""
    body = F.substr(line, F.lit(len(PREFIX) + 1))
    return F.substring_index(body, "{", 1)


def inline_payload(line: Column) -> Column:
    """Text from the first brace on; NULL when the line has none."""
    at = F.instr(line, "{")
    return F.when(at > 0, F.substr(line, at))


def metadata_parts(meta: Column) -> Column:
    return F.split(meta, ": ")


def header_fields(meta: Column) -> Column:
    """STRUCT(timestamp, player_id, event); NULL when there are fewer than three parts."""
    parts = metadata_parts(meta)
    words = F.split(F.get(parts, F.lit(1)), " ")
    player = F.when(F.size(words) == 3, F.get(words, F.lit(2))).otherwise(F.get(parts, F.lit(1)))
    return F.when(
        F.size(parts) >= 3,
        F.struct(
            F.get(parts, F.lit(0)).alias("timestamp"),
            player.alias("player_id"),
            F.get(parts, F.lit(2)).alias("event"),
        ),
    )


def kind(line: Column) -> Column:
    """What one line is, judged by itself.

    deck, start, end: markers. inline, head: event header with and without its
    JSON on the same line. bad: a header with too few parts. skip: a line with
    the prefix that no rule wants. text: anything else, perhaps a payload.
    """
    return (
        F.when(is_deck(line), DECK)
        .when(~has_prefix(line), TEXT)
        .when(is_start(line), START)
        .when(is_end(line), END)
        .when(is_unwanted(line), SKIP)
        .when(F.size(metadata_parts(metadata(line))) < 3, BAD)
        .when(F.instr(line, "{") > 0, INLINE)
        .otherwise(HEAD)
    )
