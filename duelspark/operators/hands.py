"""Opening hands, one row per hand a player saw before the first turn."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelspark.functions import cards as C
from duelspark.functions import payloads as P
from duelspark.operators.running import carry_forward, next_value
from duelspark.schemas import GAME
from duelspark.session import stage

# Fixed values of the log format.
GAME_STATE = "GREMessageType_GameStateMessage"
HAND_ZONE = "ZoneType_Hand"
BEGINNING = "Phase_Beginning"
ZONE_IDS = {1: 31, 2: 35, 3: 30}  # seat-1 hand, seat-2 hand, returned cards

PLACE = ["row_ord", "msg_pos"]
# Rows of a game that one task orders at a time.
BLOCK_ROWS = 1 << 20


def _block() -> Column:
    return F.floor(F.col("row_ord") / BLOCK_ROWS).cast("bigint").alias("block")


def candidates(messages: DataFrame) -> DataFrame:
    """Game states that show a hand zone or begin the first turn."""
    state, text = F.col("m.gameStateMessage"), F.col("message")
    return (
        messages.filter(text.contains(GAME_STATE) & (text.contains(HAND_ZONE) | text.contains(BEGINNING)))
        .withColumn("m", P.game_message(F.col("message")))
        .filter(F.col("m.type") == GAME_STATE)
        .select(
            *GAME,
            *PLACE,
            "player_id",
            F.coalesce(F.exists(state["zones"], lambda z: z["type"] == HAND_ZONE), F.lit(False)).alias("is_hand"),
            F.coalesce(state["turnInfo"]["phase"] == BEGINNING, F.lit(False)).alias("is_beginning"),
            state["zones"].alias("zones"),
            state["gameObjects"].alias("objects"),
            state["players"].alias("players"),
        )
        .filter("is_hand or is_beginning")
    )


def opening(candidates: DataFrame) -> DataFrame:
    """Hand messages up to the first beginning phase, without the first one.

    Where a game never reaches that phase all its hands stay, marked ``unfinished``.
    """
    place = F.struct(*PLACE)
    bounds = candidates.groupBy(*GAME).agg(
        F.min(F.when(F.col("is_beginning"), place)).alias("begin"),
        F.min(F.when(F.col("is_hand"), place)).alias("first"),
    )
    return (
        candidates.filter("is_hand")
        .join(bounds, GAME)
        .filter((place > F.col("first")) & (F.col("begin").isNull() | (place <= F.col("begin"))))
        .withColumn("unfinished", F.col("begin").isNull())
        .drop("begin", "first", "is_hand", "is_beginning")
    )


def instance_map(hands: DataFrame) -> DataFrame:
    """(game, instance_id, arena_id); the latest message wins."""
    return (
        hands.select(*GAME, *PLACE, F.posexplode("objects").alias("obj_pos", "o"))
        .groupBy(*GAME, F.col("o.instanceId").alias("instance_id"))
        .agg(F.max_by("o.grpId", F.struct(*PLACE, "obj_pos")).alias("arena_id"))
    )


def zones(hands: DataFrame) -> DataFrame:
    """Instance ids per zone; the first zone with an id counts."""
    pick = lambda zone_id: P.first_where(F.col("zones"), lambda z: z["zoneId"] == zone_id)["objectInstanceIds"]
    mulligans = lambda seat: P.first_where(F.col("players"), lambda p: p["systemSeatNumber"] == seat)
    return hands.select(
        *GAME,
        *PLACE,
        "player_id",
        *[pick(zone_id).alias(f"zone{n}") for n, zone_id in ZONE_IDS.items()],
        *[
            F.when(mulligans(seat).isNotNull(), F.coalesce(mulligans(seat)["mulliganCount"], F.lit(0)))
            .alias(f"mulligan{seat}")
            for seat in (1, 2)
        ],
    )


def cards(zones: DataFrame, instances: DataFrame) -> DataFrame:
    """Zones as card ids in zone order; unknown instances are dropped, empty is NULL."""
    tagged = lambda n: F.coalesce(
        F.transform(
            f"zone{n}", lambda x, i: F.struct(F.lit(n).alias("zone"), i.alias("pos"), x.alias("instance_id"))
        ),
        F.expr("cast(array() as array<struct<zone: int, pos: int, instance_id: bigint>>)"),
    )
    keep = [*GAME, *PLACE, "player_id", "mulligan1", "mulligan2"]
    seen = (
        zones.select(*keep, F.explode(F.concat(*[tagged(n) for n in ZONE_IDS])).alias("z"))
        .select(*keep, "z.*")
        .join(instances, [*GAME, "instance_id"])
    )
    in_order = lambda n: F.transform(
        F.array_sort(F.collect_list(F.when(F.col("zone") == n, F.struct("pos", "arena_id")))),
        lambda x: x["arena_id"],
    )
    listed = seen.groupBy(*keep).agg(*[in_order(n).alias(f"cards{n}") for n in ZONE_IDS])
    return listed.select(
        *keep, *[F.when(F.size(f"cards{n}") > 0, F.col(f"cards{n}")).alias(f"cards{n}") for n in ZONE_IDS]
    )


def fill_mulligans(cards: DataFrame) -> DataFrame:
    """Adds ``mulliganCount``: of the visible hand's player, else the last known one, else 0."""
    known = F.when(F.col("cards1").isNotNull(), F.col("mulligan1")).when(
        F.col("cards2").isNotNull(), F.col("mulligan2")
    )
    filled = carry_forward(cards.select("*", _block()), GAME, "block", PLACE, known, "mulliganCount")
    return filled.withColumn("mulliganCount", F.coalesce("mulliganCount", F.lit(0))).drop("block")


def visible(filled: DataFrame) -> DataFrame:
    """One row per visible hand."""
    hand = lambda seat: F.when(
        F.col(f"cards{seat}").isNotNull(),
        F.struct(F.lit(seat).alias("seat"), F.col(f"cards{seat}").alias("initial_hand")),
    )
    return (
        filled.withColumn("h", F.explode(F.array_compact(F.array(hand(1), hand(2)))))
        .select(
            *GAME,
            *PLACE,
            "h.seat",
            "player_id",
            "h.initial_hand",
            "mulliganCount",
            F.coalesce("cards3", F.expr("cast(array() as array<bigint>)")).alias("discarded"),
            (F.col("h.seat") == 1).alias("went_first"),
        )
    )


def collapse_repeats(hands: DataFrame) -> DataFrame:
    """Drops a hand that the next hand of the game repeats in full or in part."""
    following = next_value(
        hands.select("*", _block()), GAME, "block", [*PLACE, "seat"], F.col("initial_hand"), "following"
    )
    repeated = C.multiset_within(F.col("following"), F.col("initial_hand"))
    return following.filter(F.col("following").isNull() | ~repeated).drop("following", "block")


def turn1_hands(opening: DataFrame, collapse: bool = False) -> DataFrame:
    """All opening hands of all games, from ``opening`` messages.

    Running values read their input twice, so it is written once before each.
    """
    listed = stage(cards(zones(opening), instance_map(opening)), "hand-cards")
    shown = visible(fill_mulligans(listed))
    return collapse_repeats(stage(shown, "hands")) if collapse else shown
