"""Expressions over event payloads (JSON text)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from duelspark import schemas

# Fixed values of the log format.
GAME_EVENT = "GreToClientEvent"
GAME_PATH = "$.greToClientEvent.greToClientMessages"
ROOM_EVENT = "MatchGameRoomStateChangedEvent"
ROOM_PATH = "$.matchGameRoomStateChangedEvent.gameRoomInfo"
DECK_EVENT = "deck_list"
SUMMARIZED = (
    "[Message summarized because one or more GameStateMessages exceeded the 50 GameObject or 50 Annotation limit.]"
)


def json_string(text: Column) -> Column:
    """The text as one quoted JSON string."""
    wrapped = F.to_json(F.array(text))
    return F.substring(wrapped, F.lit(2), F.length(wrapped) - 2)


def wrap_list(text: Column) -> Column:
    return F.concat(F.lit("["), text, F.lit("]"))


def is_json(text: Column) -> Column:
    """Whether the text is one whole JSON value and nothing else.

    A reader stops at the end of the first value. The text is therefore read as
    the only element of a list, and as a field with another one behind it.
    """
    alone = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
    ended = F.get_json_object(F.concat(F.lit('{"p":'), text, F.lit(',"e":1}')), "$.e") == "1"
    return F.coalesce(alone & ended, F.lit(False))


def project(event: Column, payload: Column) -> Column:
    """Payload kept for an event type.

    Text that is no JSON stays as a quoted string. NULL means that the JSON is
    fine but lacks the branch its event type must have.
    """
    return (
        F.when(payload.isNull(), None)
        .when(~is_json(payload), json_string(payload))
        .when(event == GAME_EVENT, F.get_json_object(payload, GAME_PATH))
        .when(event == ROOM_EVENT, wrap_list(F.get_json_object(payload, ROOM_PATH)))
        .otherwise(payload)
    )


def is_summarized(payload: Column) -> Column:
    """Whether a payload is the server's note, bare or as a JSON string, and not one that mentions it."""
    return payload.startswith(SUMMARIZED) | payload.startswith('"' + SUMMARIZED)


def messages(payload: Column) -> Column:
    """ARRAY<STRING> of the messages in a payload; a lone value is a list of one."""
    listed = F.when(payload.startswith("["), payload).otherwise(wrap_list(payload))
    return F.from_json(listed, "array<string>")


def game_message(text: Column) -> Column:
    return F.from_json(text, schemas.GAME_MESSAGE)


def room_info(text: Column) -> Column:
    return F.from_json(text, schemas.ROOM_INFO)


def deck_request(text: Column) -> Column:
    return F.from_json(text, schemas.DECK_REQUEST)


def last_where(items: Column, test) -> Column:
    """Last array element passing the test, or NULL."""
    return F.get(F.reverse(F.filter(items, test)), F.lit(0))


def first_where(items: Column, test) -> Column:
    """First array element passing the test, or NULL."""
    return F.get(F.filter(items, test), F.lit(0))
