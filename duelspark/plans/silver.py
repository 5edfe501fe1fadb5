"""Bronze events to the silver tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelspark.functions import times as T
from duelspark.operators import decks as D
from duelspark.operators import games as G
from duelspark.operators import hands as H
from duelspark.operators import messages as M
from duelspark.operators.keys import assign_ids, highest
from duelspark.operators.quality import counts
from duelspark.schemas import GAME
from duelspark.session import stage
from duelspark.sources.store import Store


@dataclass
class Silver:
    """Silver relations under natural keys, before ids are given out."""

    games: DataFrame
    players: DataFrame
    matches: DataFrame
    decks: DataFrame
    hands: DataFrame
    deck_keys: list[str]


#: What makes two decks one.
DECK_KEYS = {"content": D.CONTENT, "content_and_name": D.NAMED}


def shape(
    bronze: DataFrame, zone: str | None = T.LOG_ZONE, collapse: bool = False, dedup_by: str = "content"
) -> Silver:
    """All silver relations. Game facts and the messages that may show a hand are written
    once each, since several tables read them and both are small next to the events.
    ``bronze`` is read twice and should be stored. ``dedup_by``: see DECK_KEYS."""
    keys = DECK_KEYS[dedup_by]
    games = stage(G.describe(M.first_last(bronze), zone), "games")
    opening = H.opening(stage(H.candidates(M.explode_messages(bronze)), "hand-candidates"))
    return Silver(
        games=games,
        players=G.players(games),
        matches=G.matches(games),
        decks=D.by_content(G.complete(games), keys),
        hands=H.turn1_hands(opening, collapse),
        deck_keys=keys,
    )


def load(store: Store, silver: Silver) -> None:
    """Appends what is not stored yet; loading the same logs again adds nothing.

    A run may stop between any two appends. Decks then point at a match id that
    no match has: no other match is given that id, and the next match with such a
    deck takes it, be it of the same logs or of others. Hands are added for stored
    matches that have none.
    """
    keys = silver.deck_keys
    store.append("players", G.absent(silver.players, store.read("players"), ["player_id"]))

    fresh = stage(G.absent(silver.matches, store.read("matches"), ["match_key"]), "new-matches")
    # Decks of the new matches only, so that each one has its first match at hand.
    used = stage(D.by_content(silver.games.join(fresh.select(*GAME), GAME, "left_semi"), keys), "used-decks")
    known = store.read("decks")
    waiting = known.join(store.read("matches").select("match_id"), "match_id", "left_anti").select("match_id", *keys)
    taken = used.join(waiting, keys).groupBy("match_key").agg(F.min("match_id").alias("match_id"))
    last = max(highest(store.read("matches"), "match_id"), highest(known, "match_id"))
    numbered = assign_ids(fresh.join(taken, "match_key", "left_anti"), GAME, "match_id", last)
    numbered = stage(numbered.unionByName(fresh.join(taken, "match_key")), "numbered-matches")
    unseen = G.absent(used, known, keys)
    decks = assign_ids(unseen, keys, "deck_id", highest(known, "deck_id")).join(
        numbered.select("match_key", "match_id"), "match_key"
    )
    store.append("decks", decks)

    # The keys are unique in ``decks``, so the lookup keeps the row count.
    ids = store.read("decks").select("deck_id", *keys)
    store.append("matches", numbered.join(ids, keys))

    # Hands go by the stored matches that have none yet, so a run that stopped
    # between the two appends is completed by the next one.
    known = store.read("matches").select("match_key", "match_id")
    linked = silver.matches.select(*GAME, "match_key").join(known, "match_key").join(
        store.read("turn1_hands").select("match_id"), "match_id", "left_anti"
    )
    hands = silver.hands.join(linked.select(*GAME, "match_id"), GAME)
    place = ["match_id", "row_ord", "msg_pos", "seat"]
    store.append(
        "turn1_hands", assign_ids(hands, place, "hand_id", highest(store.read("turn1_hands"), "hand_id"))
    )


def read_all(store: Store) -> dict[str, DataFrame]:
    return {name: store.read(name) for name in ("players", "matches", "decks", "turn1_hands", "dim_cards")}


def row_totals(store: Store) -> DataFrame:
    return counts(read_all(store)).orderBy(F.col("table_name"))
