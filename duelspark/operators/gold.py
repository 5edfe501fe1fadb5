"""Player, deck and card metrics.

Matches are summed once per (player, deck); player and deck metrics are sums of
those sums, so the wide fact table is shuffled for its grouping only once and a
player or deck with very many matches is reduced before any exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RATE = "decimal(38,9)"
MULLIGANS = (0, 1, 2)


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as a rate; NULL where the whole is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double")).cast(RATE)


def won() -> Column:
    return F.col("winner_seat") == F.col("player_seat")


def lost() -> Column:
    return (F.col("winner_seat") != 0) & ~won()


def match_mulligans(hands: DataFrame) -> DataFrame:
    """Mulligans taken per match."""
    return hands.groupBy("match_id").agg(F.max("mulliganCount").alias("mulligans"))


def player_deck_stats(
    matches: DataFrame, hands: DataFrame | None = None, as_of: Column | None = None
) -> DataFrame:
    """Additive measures per (player_id, deck_id)."""
    last_start = matches.select(F.max("start_time")).scalar() if as_of is None else as_of
    facts = matches
    if hands is not None:
        facts = matches.join(match_mulligans(hands), "match_id", "left")
    else:
        facts = matches.withColumn("mulligans", F.lit(None).cast("int"))
    recent = F.col("start_time") > F.col("as_of") - F.expr("interval 30 days")
    count_if = lambda test: F.sum(F.when(test, 1).otherwise(0)).cast("bigint")
    return (
        facts.withColumn("as_of", last_start)
        .groupBy("player_id", "deck_id")
        .agg(
            F.count("*").alias("matches"),
            count_if(won()).alias("wins"),
            count_if(lost()).alias("losses"),
            count_if(recent).alias("matches_30d"),
            count_if(recent & won()).alias("wins_30d"),
            F.sum("duration_sec").alias("duration"),
            F.count("duration_sec").alias("timed"),
            F.max("start_time").alias("last_start"),
            F.sum("mulligans").cast("bigint").alias("mulligans"),
            F.count("mulligans").alias("handed"),
            *[count_if(F.col("mulligans") == n).alias(f"matches_m{n}") for n in MULLIGANS],
            *[count_if((F.col("mulligans") == n) & won()).alias(f"wins_m{n}") for n in MULLIGANS],
        )
    )


_SUMS = [
    "matches", "wins", "losses", "matches_30d", "wins_30d", "duration", "timed", "mulligans", "handed",
    *[f"matches_m{n}" for n in MULLIGANS], *[f"wins_m{n}" for n in MULLIGANS],
]


_OF_MATCHES = ["matches", "wins", "losses", "duration", "timed"]
_OF_HANDS = ["mulligans", "handed", *[f"matches_m{n}" for n in MULLIGANS], *[f"wins_m{n}" for n in MULLIGANS]]


def day_of(time: Column) -> Column:
    """The day of an instant by UTC, whatever the session's zone."""
    return F.floor(F.unix_seconds(time) / 86_400).cast("bigint")


def day_sums(matches: DataFrame, hands: DataFrame, hand_matches: DataFrame) -> DataFrame:
    """Additive measures per (player_id, deck_id, day) of some matches, and of some hands whose matches are in ``hand_matches``.

    All hands of a match must be among ``hands`` together.
    """
    count_if = lambda test: F.sum(F.when(test, 1).otherwise(0)).cast("bigint")
    keys = ["player_id", "deck_id", day_of(F.col("start_time")).alias("day")]
    played = matches.groupBy(*keys).agg(
        F.count("*").alias("matches"), count_if(won()).alias("wins"), count_if(lost()).alias("losses"),
        F.sum("duration_sec").alias("duration"), F.count("duration_sec").alias("timed"), F.max("start_time").alias("last_start"),
    )
    handed = hand_matches.join(match_mulligans(hands), "match_id").groupBy(*keys).agg(
        F.sum("mulligans").cast("bigint").alias("mulligans"),
        F.count("mulligans").alias("handed"),
        *[count_if(F.col("mulligans") == n).alias(f"matches_m{n}") for n in MULLIGANS],
        *[count_if((F.col("mulligans") == n) & won()).alias(f"wins_m{n}") for n in MULLIGANS],
    )
    return played.unionByName(handed, allowMissingColumns=True)


def stats_of_days(days: DataFrame, matches: DataFrame, as_of: Column | None = None) -> DataFrame:
    """As ``player_deck_stats``, from ``day_sums``.

    The last 30 days are whole days but for the first one, of which the matches
    themselves are read: ``matches`` is filtered to that one day.
    """
    until = days.select(F.max("last_start")).scalar() if as_of is None else as_of
    since = until - F.expr("interval 30 days")
    edge = matches.filter((day_of(F.col("start_time")) == day_of(since)) & (F.col("start_time") > since))
    edge = edge.groupBy("player_id", "deck_id").agg(
        F.count("*").alias("matches_30d"), F.sum(F.when(won(), 1).otherwise(0)).cast("bigint").alias("wins_30d")
    )
    whole = F.col("day") > day_of(since)
    rows = days.withColumns({f"{c}_30d": F.when(whole, F.col(c)) for c in ("matches", "wins")}).drop("run", "day")
    zero = F.lit(0).cast("bigint")
    none_timed = lambda c: F.sum(c) if c in ("duration", "mulligans") else F.coalesce(F.sum(c), zero)
    return rows.unionByName(edge, allowMissingColumns=True).groupBy("player_id", "deck_id").agg(
        *[none_timed(c).alias(c) for c in _SUMS], F.max("last_start").alias("last_start")
    )


def _mulligan_rates() -> list[Column]:
    return [
        ratio(F.col("mulligans"), F.col("handed")).alias("avg_mulligans"),
        *[ratio(F.col(f"wins_m{n}"), F.col(f"matches_m{n}")).alias(f"mulligan{n}_win_rate") for n in MULLIGANS],
    ]


def player_metrics(stats: DataFrame, players: DataFrame, decks: DataFrame) -> DataFrame:
    """One row per player with matches; the smallest deck id wins a tie."""
    totals = stats.groupBy("player_id").agg(
        *[F.sum(c).alias(c) for c in _SUMS],
        F.max("last_start").alias("time_last_played"),
        F.max_by("deck_id", F.struct("matches", -F.col("deck_id"))).alias("most_played_deck_id"),
    )
    names = decks.select(
        F.col("deck_id").alias("most_played_deck_id"), F.col("deck_name").alias("most_played_deck_name")
    )
    return (
        totals.join(players, "player_id", "left")
        .join(names, "most_played_deck_id", "left")
        .select(
            "player_id",
            "display_name",
            F.col("matches").alias("total_matches"),
            F.col("wins").alias("total_wins"),
            F.col("losses").alias("total_losses"),
            ratio(F.col("wins"), F.col("matches")).alias("win_rate"),
            ratio(F.col("wins_30d"), F.col("matches_30d")).alias("win_rate_30d"),
            ratio(F.col("duration"), F.col("timed")).alias("avg_duration_sec"),
            *_mulligan_rates(),
            "most_played_deck_id",
            "most_played_deck_name",
            "time_last_played",
        )
    )


def deck_results(stats: DataFrame) -> DataFrame:
    """Match results per deck."""
    totals = stats.groupBy("deck_id").agg(*[F.sum(c).alias(c) for c in _SUMS])
    return totals.select(
        "deck_id",
        ratio(F.col("duration"), F.col("timed")).alias("avg_duration_sec"),
        F.col("matches").alias("total_matches"),
        F.col("wins").alias("total_wins"),
        ratio(F.col("wins"), F.col("matches")).alias("win_rate"),
        *_mulligan_rates(),
    )


def card_facts(cards: DataFrame, dim_cards: DataFrame) -> DataFrame:
    """(deck_id, arena_id, copies) with cost and colors; unknown cards have NULLs."""
    return cards.join(dim_cards.select("arena_id", "cmc", "colors"), "arena_id", "left")


def deck_makeup(facts: DataFrame) -> DataFrame:
    """Colors, cost curve and average cost per deck, from ``card_facts``.

    Cards are first summed per (deck, cost), so the last grouping sees at most
    one row per cost.
    """
    per_cost = facts.groupBy("deck_id", "cmc").agg(
        F.sum("copies").alias("n"), F.collect_set("colors").alias("colors")
    )
    letters = F.array_distinct(
        F.flatten(F.transform(F.flatten("colors"), lambda c: F.split(c, "")))
    )
    priced = F.col("cmc").isNotNull()
    return (
        per_cost.groupBy("deck_id")
        .agg(
            F.collect_list("colors").alias("colors"),
            F.map_from_entries(F.collect_list(F.when(priced, F.struct("cmc", "n")))).alias("counts"),
            F.max("cmc").alias("top"),
            F.sum(F.col("cmc") * F.col("n")).alias("cost"),
            F.sum(F.when(priced, F.col("n"))).alias("n"),
        )
        .select(
            "deck_id",
            F.array_join(F.array_sort(F.filter(letters, lambda c: c != "")), "").alias("colors"),
            F.when(
                F.col("top").isNotNull(),
                F.transform(
                    F.sequence(F.lit(0).cast("bigint"), F.col("top")),
                    lambda c: F.coalesce(F.element_at("counts", c), F.lit(0).cast("bigint")),
                ),
            ).alias("cmc_curve"),
            ratio(F.col("cost"), F.col("n")).alias("cmc_avg"),
        )
    )


def deck_metrics(
    stats: DataFrame, decks: DataFrame, players: DataFrame, cards: DataFrame, dim_cards: DataFrame
) -> DataFrame:
    """One row per deck; owner is the player who first used it."""
    no_matchups = F.expr(
        "cast(array() as array<struct<opp_colors: string, total_matches: bigint, total_wins: bigint, "
        "total_losses: bigint, win_rate: decimal(38,9)>>)"
    )
    return (
        decks.select("deck_id", "deck_name", "player_id")
        .join(deck_results(stats), "deck_id", "left")
        .join(deck_makeup(card_facts(cards, dim_cards)), "deck_id", "left")
        .join(players, "player_id", "left")
        .select(
            "deck_id",
            "deck_name",
            "player_id",
            "display_name",
            "avg_duration_sec",
            F.coalesce("total_matches", F.lit(0).cast("bigint")).alias("total_matches"),
            F.coalesce("total_wins", F.lit(0).cast("bigint")).alias("total_wins"),
            "win_rate",
            "avg_mulligans",
            *[f"mulligan{n}_win_rate" for n in MULLIGANS],
            "colors",
            "cmc_curve",
            "cmc_avg",
            no_matchups.alias("matchup_winrate"),
        )
    )


def opener_cards(hands: DataFrame) -> DataFrame:
    """(match_id, arena_id) of the hand each match was started with, the last one shown."""
    return (
        hands.groupBy("match_id")
        .agg(F.max_by("initial_hand", "hand_id").alias("hand"))
        .select("match_id", F.explode(F.array_distinct("hand")).alias("arena_id"))
    )


def opener_win_rate(openers: DataFrame, matches: DataFrame) -> DataFrame:
    """Win rate per (player, deck, card) over matches with the card in the opening hand."""
    facts = matches.select("match_id", "player_id", "deck_id", won().alias("won"))
    return (
        openers.join(facts, "match_id")
        .groupBy("player_id", "deck_id", "arena_id")
        .agg(F.sum(F.when(F.col("won"), 1).otherwise(0)).alias("w"), F.count("*").alias("n"))
        .select("player_id", "deck_id", "arena_id", ratio(F.col("w"), F.col("n")).alias("win_rate_opener"))
    )


def draw_chance(cards: DataFrame) -> DataFrame:
    """Copies of each card and its share of the deck."""
    size = cards.groupBy("deck_id").agg(F.sum("copies").alias("size"))
    return cards.join(size, "deck_id").select(
        "deck_id",
        "arena_id",
        F.col("copies").alias("total_in_deck"),
        ratio(F.col("copies"), F.col("size")).alias("draw_chance"),
    )


def card_metrics(
    stats: DataFrame, matches: DataFrame, openers: DataFrame, cards: DataFrame, dim_cards: DataFrame
) -> DataFrame:
    """One row per (player, deck, card): every card of a played deck, and any card seen in a hand."""
    grain = ["player_id", "deck_id", "arena_id"]
    played = stats.select("player_id", "deck_id").join(draw_chance(cards), "deck_id")
    return (
        played.join(opener_win_rate(openers, matches), grain, "full")
        .join(dim_cards.select("arena_id", "card_name"), "arena_id", "left")
        .select(
            *grain,
            "card_name",
            F.lit(None).cast(RATE).alias("win_rate_draw"),
            "win_rate_opener",
            "total_in_deck",
            "draw_chance",
        )
    )
