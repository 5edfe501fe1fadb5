"""The driver's tables read as game logs and as silver relations.

Every relation is computed row by row or by plain grouping, so its size follows
the table it is made from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duelspark.functions import lines as L
from duelspark.functions import payloads as P
from duelspark.functions import times as T

# Events of one block of a log, as if a file were split; event ids rise with time.
BLOCK_EVENTS = 1 << 20

# Given schemas save one footer-reading job per table.
TABLES = {
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
        "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
        "l_shipdate TIMESTAMP_NTZ"
    ),
    "part": (
        "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE"
    ),
    "events": (
        "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
    ),
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def _json(template: str, **values: Column) -> Column:
    """Template text with ``<name>`` places filled by column values."""
    out, rest = [], template
    while "<" in rest:
        head, _, tail = rest.partition("<")
        name, _, rest = tail.partition(">")
        out += [F.lit(head), values[name].cast("string")]
    return F.concat(*out, F.lit(rest))


def classified_events(events: DataFrame) -> DataFrame:
    """Events with the part each one plays in its log."""
    kind, k = F.col("event_type"), F.col("k")
    return events.select(
        "event_id", "user_id", "ts", "event_type", F.get_json_object("props", "$.k").cast("int").alias("k")
    ).select(
        "*",
        (F.lit(1) + F.col("user_id") % 2).cast("int").alias("seat"),
        F.when((kind == "signup") & (k < 50), "start")
        .when(kind == "signup", "noise")
        .when((kind == "error") & (k < 50), "end")
        .when(kind == "error", "bad")
        .when(kind == "view", "deck")
        .when((kind == "click") & (k < 30), "unwanted")
        .when((kind == "click") & (k >= 90), "lone")
        .otherwise("record")
        .alias("what"),
        (k % 10).alias("r"),
    )


def _deck_request(k: Column) -> Column:
    counts = '[{"cardId":<c1>,"quantity":<q1>},{"cardId":<c2>,"quantity":2}]'
    attributes = F.when(k % 7 == 0, "").otherwise(
        F.when(k % 5 == 0, ',"Attributes":[{"name":"Version","value":"1"}]').otherwise(
            _json(',"Attributes":[{"name":"Version","value":"1"},{"name":"Format","value":"Format<f>"}]', f=k % 4)
        )
    )
    side = F.when(k % 2 == 0, "[]").otherwise('[{"cardId":7,"quantity":2}]')
    command = F.when(k % 11 == 0, "").otherwise(
        F.when(k % 3 == 0, _json(',"CommandZone":[{"cardId":<c>,"quantity":1}]', c=k % 2 + 900)).otherwise(
            ',"CommandZone":[]'
        )
    )
    deck = F.when(k % 13 == 0, "").otherwise(
        F.concat(
            F.lit(',"Deck":{"MainDeck":'),
            _json(counts, c1=k % 4 + 100, q1=k % 3 + 1, c2=k % 3 + 50),
            F.lit(',"Sideboard":'), side, command, F.lit("}"),
        )
    )
    return F.concat(_json('{"Summary":{"Name":"Deck <n>"', n=k % 6), attributes, F.lit("}"), deck, F.lit("}"))


def _room(me: dict[str, Column]) -> Column:
    final = F.when(F.col("r") == 2, "").otherwise(
        _json(
            ',"finalMatchResult":{"resultList":[{"scope":"MatchScope_Game","winningTeamId":1},'
            '{"scope":"MatchScope_Match","winningTeamId":<w>}]}',
            w=F.col("event_id") % 2 + 1,
        )
    )
    return F.concat(
        _json(
            '{"transactionId":"t<id>","matchGameRoomStateChangedEvent":{"gameRoomInfo":{"gameRoomConfig":'
            '{"reservedPlayers":[{"userId":"P<user>","playerName":"N<user>-<k>","systemSeatId":<seat>,"teamId":<seat>},'
            '{"userId":"OPP","playerName":"Opp","systemSeatId":<other>,"teamId":<other>}],"matchId":"M<id>"},'
            '"stateType":"Done"',
            **me,
        ),
        final,
        F.lit("}}}"),
    )


def _game_state(me: dict[str, Column]) -> Column:
    k, event = F.col("k"), F.col("event_id")
    first = (k % 2) * 2
    ids = {f"i{j}": first + j for j in (1, 2, 3)}
    cards = {f"g{j}": (event * 7 + j * 13 + k) % 2000 for j in (1, 2, 3)}
    values = {**me, **ids, **cards, "zone": F.when(F.col("seat") == 1, 31).otherwise(35)}
    limbo = F.when(k % 3 == 0, _json(',{"zoneId":30,"type":"ZoneType_Limbo","objectInstanceIds":[<i3>]}', **values)).otherwise("")
    count = F.when(k % 4 == 0, "").otherwise(_json(',"mulliganCount":<m>', m=k % 4))
    players = F.when(event % 4 == 0, "").otherwise(
        F.concat(_json(',"players":[{"systemSeatNumber":<seat>', **me), count, F.lit("}]"))
    )
    head = '{"type":"GREMessageType_GameStateMessage","systemSeatIds":[<seat>],"gameStateMessage":'
    shown = F.concat(
        _json(head + '{"zones":[{"zoneId":<zone>,"type":"ZoneType_Hand","objectInstanceIds":[<i1>,<i2>,<i3>]}', **values),
        limbo,
        _json('],"gameObjects":[{"instanceId":<i1>,"grpId":<g1>},{"instanceId":<i2>,"grpId":<g2>},{"instanceId":<i3>,"grpId":<g3>}]', **values),
        players,
        F.lit("}}"),
    )
    again = _json(head + '{"zones":[{"zoneId":<zone>,"type":"ZoneType_Hand","objectInstanceIds":[<i1>,3,7]}]}}', **values)
    turn = F.when(
        F.col("r") == 8, _json(head + '{"turnInfo":{"phase":"Phase_Beginning"}}}', **me)
    ).otherwise('{"type":"GREMessageType_UIMessage"}')
    body = F.concat(
        _json('{"transactionId":"t<id>","greToClientEvent":{"greToClientMessages":[', **me),
        shown, F.lit(","), again, F.lit(","), turn, F.lit("]}}"),
    )
    return F.when((F.col("r") == 9) & (event % 5 == 0), '{"greToClientEvent":{}}').otherwise(body)


def event_log(events: DataFrame) -> DataFrame:
    """One or two log lines per event; a log per user, ordered by event id."""
    e = classified_events(events)
    me = {
        "id": F.col("event_id"), "user": F.col("user_id"), "seat": F.col("seat"),
        "other": 3 - F.col("seat"), "k": F.col("k"),
    }
    prefix, what, r = F.lit(L.PREFIX), F.col("what"), F.col("r")
    header = F.concat(prefix, F.date_format("ts", T.LOG_TIME), _json(": Match to P<user>: ", **me))
    old = F.when(F.col("event_id") % 2 == 0, "ConnectingToGRE").otherwise("ConnectedToGRE_Waiting")
    start = F.concat(
        prefix, F.lit('STATE CHANGED {"old":"ConnectedToMatchDoor_'), old, F.lit('","new":"Playing"}')
    )
    deck = F.concat(
        F.lit(L.DECK_CALL), _json(' {"id":"<id>","request":', **me),
        F.regexp_replace(F.to_json(F.array(_deck_request(F.col("k")))), r"^\[|\]$", ""), F.lit("}"),
    )
    event = F.when(r <= 2, "MatchGameRoomStateChangedEvent").otherwise("GreToClientEvent")
    record = F.when(
        r == 3, F.array(F.concat(header, _json('QueueEvent{"queue":<k>,"transactionId":"t<id>"}', **me)))
    ).otherwise(
        F.array(
            F.concat(header, event),
            F.when(r <= 2, _room(me)).when(r == 4, P.SUMMARIZED).otherwise(_game_state(me)),
        )
    )
    lines = (
        F.when(what == "start", F.array(start))
        .when(what == "end", F.array(F.lit(L.END_TEXT + " ")))
        .when(what == "bad", F.array(F.lit(L.PREFIX + 'STATE CHANGED {"old":"Playing","new":"Other"}')))
        .when(what == "noise", F.array(_json("  scene <id> loaded", **me)))
        .when(what == "deck", F.array(deck))
        .when(what == "unwanted", F.array(F.concat(header, F.lit('ClientToGremessage{"a":1}'))))
        .when(what == "lone", F.array(F.concat(header, F.lit("GreToClientEvent"))))
        .otherwise(record)
    )
    return e.select(
        F.format_string("user-%d", "user_id").alias("source_file"),
        F.struct(
            F.lit(0).cast("bigint").alias("part"), F.lit("").alias("file"),
            F.floor(F.col("event_id") / BLOCK_EVENTS).cast("bigint").alias("start"),
        ).alias("block"),
        F.posexplode(lines).alias("n", "raw"),
        "event_id",
    ).select(
        "source_file", "block", (F.col("event_id") * 2 + F.col("n")).alias("pos"), L.strip(F.col("raw")).alias("line")
    )


def users(events: DataFrame) -> DataFrame:
    """One source per user."""
    return events.select(F.format_string("user-%d", "user_id").alias("source_file")).distinct()


def players(customer: DataFrame) -> DataFrame:
    return customer.select(F.col("c_custkey").cast("string").alias("player_id"), F.col("c_name").alias("display_name"))


def _deck_id() -> Column:
    return F.col("o_custkey") * 3 + F.col("o_orderkey") % 3


def matches(orders: DataFrame) -> DataFrame:
    seat = (F.col("o_orderkey") % 2 + 1).cast("int")
    status = F.col("o_orderstatus")
    return orders.select(
        F.col("o_orderkey").alias("match_id"),
        _deck_id().alias("deck_id"),
        F.col("o_custkey").cast("string").alias("player_id"),
        seat.alias("player_seat"),
        F.col("o_orderdate").cast("timestamp").alias("start_time"),
        (F.floor("o_totalprice") % 3600).cast("bigint").alias("duration_sec"),
        F.when(status == "F", seat).when(status == "O", 3 - seat).otherwise(0).cast("int").alias("winner_seat"),
        F.col("o_orderpriority").alias("game_format"),
        F.expr("array(named_struct('cards', cast(array() as array<bigint>)))").alias("draw_order"),
        F.col("o_orderkey").cast("string").alias("match_key"),
    )


def decks(orders: DataFrame) -> DataFrame:
    """Deck names and owners; a deck comes from its first order."""
    return orders.groupBy(_deck_id().alias("deck_id")).agg(
        F.min("o_orderkey").alias("match_id"), F.min(F.col("o_custkey")).cast("string").alias("player_id")
    ).withColumn("deck_name", F.format_string("Deck %d", "deck_id"))


def deck_cards(matches: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Cards of each deck: the line items of all its orders."""
    items = lineitem.select("l_orderkey", F.col("l_partkey").alias("arena_id"), "l_quantity")
    return (
        items.join(matches.select(F.col("match_id").alias("l_orderkey"), "deck_id"), "l_orderkey")
        .groupBy("deck_id", "arena_id")
        .agg(F.sum("l_quantity").cast("bigint").alias("copies"))
    )


def hands(lineitem: DataFrame) -> DataFrame:
    """Each line item is one hand of three neighbouring cards."""
    card, number = F.col("l_partkey"), F.col("l_linenumber")
    return lineitem.select(
        (number.cast("bigint") * 1_000_000_000_000 + card).alias("hand_id"),
        F.col("l_orderkey").alias("match_id"),
        F.array(card, card + 1, card + 2).alias("initial_hand"),
        (number % 3).cast("int").alias("mulliganCount"),
    )


def dim_cards(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").alias("arena_id"),
        F.col("p_name").alias("card_name"),
        F.col("p_size").cast("bigint").alias("cmc"),
        F.substring("p_type", 1, 1).alias("colors"),
        F.col("p_brand").alias("set_code"),
    )


def bulk_cards(part: DataFrame) -> DataFrame:
    """Parts as card objects with repeated, missing and zero ids, plus file order ``ord``."""
    key = F.col("p_partkey")
    letters = F.split(F.lit("W,U,B,R,G"), ",")
    colors = F.when(key % 4 == 0, F.lit(None)).otherwise(F.slice(letters, 1, (key % 3).cast("int")))
    return part.select(
        F.when(key % 10 == 0, F.lit(None)).when(key % 10 == 1, 0).otherwise(key - key % 3).cast("bigint").alias("arena_id"),
        F.format_string("o-%d", key).alias("oracle_id"),
        F.col("p_name").alias("name"),
        F.expr("date_add(date'2020-01-01', cast(p_size as int))").alias("released_at"),
        F.format_string("https://cards.example/%d?utm=%d", key, F.col("p_size")).alias("scryfall_uri"),
        F.format_string("{%d}", "p_size").alias("mana_cost"),
        (F.col("p_size") / 2.0).alias("cmc"),
        colors.alias("colors"),
        F.slice(letters, 1, (key % 5).cast("int")).alias("color_identity"),
        F.col("p_type").alias("type_line"),
        F.col("p_brand").alias("set"),
        F.col("p_brand").alias("set_name"),
        F.lit("core").alias("set_type"),
        F.when(key % 2 == 0, "common").otherwise("rare").alias("rarity"),
        F.create_map(F.lit("standard"), F.when(key % 2 == 0, "legal").otherwise("banned")).alias("legalities"),
        key.alias("ord"),
    )


def deck_counts(lineitem: DataFrame) -> DataFrame:
    """A small deck per line item, as {cardId, quantity} lists."""
    count = lambda card, n: F.struct(card.cast("bigint").alias("cardId"), n.cast("int").alias("quantity"))
    return lineitem.select(
        F.col("l_orderkey").alias("match_id"),
        F.col("l_linenumber").alias("line"),
        F.array(count(F.col("l_partkey"), F.col("l_linenumber")), count(F.col("l_suppkey"), F.lit(2))).alias("main"),
        F.when(F.col("l_returnflag") == "R", F.array(count(F.col("l_suppkey"), F.col("l_linenumber"))))
        .otherwise(F.expr("cast(array() as array<struct<cardId: bigint, quantity: int>>)"))
        .alias("side"),
    )
