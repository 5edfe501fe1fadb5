"""Silver tables to the gold tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelspark.operators import decks as D
from duelspark.operators import gold as X
from duelspark.session import stage
from duelspark.sources.store import Store


def build(silver: dict[str, DataFrame], as_of: Column | None = None) -> dict[str, DataFrame]:
    matches, decks, players = silver["matches"], silver["decks"], silver["players"]
    hands, dim = silver["turn1_hands"], silver["dim_cards"]
    # Both are read by two tables or more and small next to what they come from.
    stats = stage(X.player_deck_stats(matches, hands, as_of), "player-deck-stats")
    cards = stage(D.deck_cards(decks), "deck-cards")
    return {
        "player_metrics": X.player_metrics(stats, players, decks),
        "deck_metrics": X.deck_metrics(stats, decks, players, cards, dim),
        "card_metrics": X.card_metrics(stats, matches, X.opener_cards(hands), cards, dim),
    }


def reload(store: Store, silver: dict[str, DataFrame], as_of: Column | None = None) -> None:
    for table, rows in build(silver, as_of).items():
        store.overwrite(table, rows)


def update_days(store: Store) -> int:
    """Adds the sums of matches and hands that no earlier run has seen to ``player_deck_days``; gives their number.

    Ids grow with every load, so what is new lies behind the last run's ids. A
    run counts once its row in ``gold_runs`` is written, which comes last: the sums
    of a stopped run have no such row and are never read.
    """
    done = store.read("gold_runs").agg(F.max("upto_match").alias("match"), F.max("upto_hand").alias("hand")).first()
    matches, hands = store.read("matches"), store.read("turn1_hands")
    after = lambda column, upto: F.lit(True) if upto is None else F.col(column) > upto
    ids = matches.agg(F.max("match_id").alias("match"), F.count(F.when(after("match_id", done.match), 1)).alias("n")).first()
    last = hands.agg(F.max("hand_id").alias("hand"), F.count(F.when(after("hand_id", done.hand), 1)).alias("n")).first()
    if not ids.n and not last.n:
        return 0
    new_matches = matches.filter(after("match_id", done.match) & (F.col("match_id") <= ids.match))
    new_hands = hands.filter(after("hand_id", done.hand) & (F.col("hand_id") <= last.hand)) if last.n else hands.limit(0)
    run = uuid.uuid4().hex
    sums = X.day_sums(new_matches, new_hands, matches.filter(F.col("match_id") <= ids.match))
    missing = [c for c in store.specs["player_deck_days"].columns if c not in sums.columns]
    store.append("player_deck_days", sums.withColumns({c: F.lit(run) if c == "run" else F.lit(None) for c in missing}))
    upto = store.spark.range(1).select(
        F.lit(run).alias("run"), F.lit(ids.match).alias("upto_match"), F.lit(last.hand if last.hand is not None else -1).alias("upto_hand")
    )
    store.append("gold_runs", upto)
    return ids.n + last.n


def kept_days(store: Store) -> DataFrame:
    """The sums of all finished runs."""
    return store.read("player_deck_days").join(store.read("gold_runs").select("run"), "run", "left_semi")


def update(store: Store, as_of: Column | None = None) -> int:
    """Player and deck metrics after new matches or hands, from the sums per day; old matches and hands are not read.

    Card metrics need the hands themselves and stay with ``reload``.
    """
    new = update_days(store)
    stats = stage(X.stats_of_days(kept_days(store), store.read("matches"), as_of), "player-deck-stats")
    players, decks = store.read("players"), store.read("decks")
    cards = stage(D.deck_cards(decks), "deck-cards")
    store.overwrite("player_metrics", X.player_metrics(stats, players, decks))
    store.overwrite("deck_metrics", X.deck_metrics(stats, decks, players, cards, store.read("dim_cards")))
    return new
