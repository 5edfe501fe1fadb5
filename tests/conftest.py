import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from duelspark.functions import lines as L  # noqa: E402
from duelspark.functions.payloads import SUMMARIZED  # noqa: E402
from duelspark.session import build_session  # noqa: E402

P = L.PREFIX
START_B, START_A = L.START_TEXTS
END = L.END_TEXT
SUMMARY = SUMMARIZED


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "duelspark-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def deck_line(name="Sample", main=((102, 1), (101, 2)), side=(), command=(), fmt="Standard", **drop):
    count = lambda cards: [{"cardId": c, "quantity": q} for c, q in cards]
    deck = {"MainDeck": count(main), "Sideboard": count(side), "CommandZone": count(command)}
    if drop.get("no_command"):
        del deck["CommandZone"]
    request = {
        "Summary": {"Name": name, "Attributes": [{"name": "Version", "value": "1"}, {"name": "Format", "value": fmt}]},
        "Deck": deck,
    }
    return P + "==> DeckUpsertDeckV2 " + json.dumps({"id": "x", "request": json.dumps(request)})


def header(time, player, event):
    return f"{P}{time}: Match to {player}: {event}"


def gre(*messages):
    return json.dumps({"transactionId": "t", "greToClientEvent": {"greToClientMessages": list(messages)}})


def gsm(**state):
    return {"type": "GREMessageType_GameStateMessage", "systemSeatIds": [1], "gameStateMessage": state}


def hand_state(hand=None, limbo=None, objects=(), players=None, zone=31):
    zones = []
    if hand is not None:
        zones.append({"zoneId": zone, "type": "ZoneType_Hand", "objectInstanceIds": hand})
    if limbo is not None:
        zones.append({"zoneId": 30, "type": "ZoneType_Limbo", "objectInstanceIds": limbo})
    state = {"zones": zones, "gameObjects": [{"instanceId": i, "grpId": g} for i, g in objects]}
    if players is not None:
        state["players"] = players
    return gsm(**state)


def room(match_id="m-1", players=(("PLAYERA", "Ann", 1), ("PLAYERB", "Bob", 2)), game=2, match=1):
    reserved = [{"userId": u, "playerName": n, "systemSeatId": s, "teamId": s} for u, n, s in players]
    results = [{"scope": "MatchScope_Game", "winningTeamId": game}, {"scope": "MatchScope_Match", "winningTeamId": match}]
    info = {
        "gameRoomConfig": {"reservedPlayers": reserved, "matchId": match_id},
        "stateType": "MatchGameRoomStateType_MatchCompleted",
        "finalMatchResult": {"resultList": results},
    }
    return json.dumps({"matchGameRoomStateChangedEvent": {"gameRoomInfo": info}})


def golden_log():
    """Three games: a full one, one without a room event, one without rows."""
    seat1 = {"systemSeatNumber": 1}
    m1 = hand_state([1, 2], objects=[(1, 900)], players=[seat1])
    m2 = hand_state([11, 12], objects=[(11, 101), (12, 102)], players=[seat1])
    m3 = hand_state([13, 14, 99], objects=[(13, 101), (14, 101)], players=[{**seat1, "mulliganCount": 1}])
    m4 = hand_state([13], limbo=[14])
    m5 = gsm(turnInfo={"phase": "Phase_Beginning"})
    return [
        deck_line(),
        START_A,
        header("1/2/2026 1:00:00 PM", "PLAYERA", "GreToClientEvent"),
        gre(m1, m2),
        P + "1/2/2026 1:00:10 PM: PLAYERA to Match: ClientToGremessage",
        header("1/2/2026 1:00:20 PM", "PLAYERA", "GreToClientEvent"),
        gre(m3, m4, m5),
        header("1/2/2026 1:05:30 PM", "PLAYERA", "MatchGameRoomStateChangedEvent"),
        room(),
        END,
        START_B,
        header("1/2/2026 2:00:00 PM", "PLAYERA", "GreToClientEvent"),
        SUMMARY,
        P + 'STATE CHANGED {"old":"Playing","new":"Other"}',
        END,
        START_A,
        END,
    ]


def as_lines(spark, logs, block=None):
    """{source: [line]} to a line relation; ``block`` cuts logs into groups of that many lines."""
    from duelspark import schemas
    from duelspark.functions import lines as L

    rows = []
    for source, lines in logs.items():
        for n, line in enumerate(lines):
            rows.append((source, (0, "", (n // block) * block if block else 0), n, line))
    from pyspark.sql import functions as F

    return spark.createDataFrame(rows, schemas.LINES).withColumn("line", L.strip(F.col("line")))


def rows_of(df, *columns):
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
