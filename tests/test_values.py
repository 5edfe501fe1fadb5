"""Scalar rules against plain Python."""

import datetime as dt
import hashlib
import json
import random
from collections import Counter

from conftest import rows_of
from pyspark.sql import functions as F

from duelspark.functions import cards as C
from duelspark.functions import times as T
from duelspark.operators import dims
from duelspark.operators import quality as Q
from duelspark.operators.keys import assign_ids
from duelspark.operators.running import carry_forward, next_value
from duelspark.plans import gold
from duelspark.schemas import SILVER
from duelspark.sources import card_bulk


def test_hashes_and_flat_lists(spark):
    rng = random.Random(1)
    decks = [[(rng.randint(1, 99), rng.randint(0, 4)) for _ in range(rng.randint(0, 6))] for _ in range(50)]
    df = spark.createDataFrame(
        [(i, [{"cardId": c, "quantity": q} for c, q in d]) for i, d in enumerate(decks)],
        "i int, counts array<struct<cardId: bigint, quantity: int>>",
    )
    flat = C.flat_deck(F.col("counts"))
    for i, ids, ids_hash, counts_hash in rows_of(
        df.select("i", flat.alias("f"), C.id_list_hash(flat), C.count_list_hash(F.col("counts")))
    ):
        want = sorted(c for c, q in decks[i] for _ in range(q))
        listed = [{"cardId": c, "quantity": q} for c, q in decks[i]]
        digest = lambda v: hashlib.sha256(json.dumps(v, sort_keys=True).encode()).hexdigest()
        assert (ids, ids_hash, counts_hash) == (want, digest(want), digest(listed))


def test_multiset_rule(spark):
    rng = random.Random(2)
    pairs = [([rng.randint(1, 4) for _ in range(rng.randint(1, 5))], [rng.randint(1, 4) for _ in range(rng.randint(1, 6))]) for _ in range(200)]
    df = spark.createDataFrame(pairs, "a array<bigint>, b array<bigint>")
    for a, b, within in rows_of(df.select("a", "b", C.multiset_within(F.col("a"), F.col("b")))):
        assert within == (not Counter(a) - Counter(b))


def test_times(spark):
    texts = [("1/2/2026 1:00:00 PM",), ("01/02/2026 01:00:00 PM",), ("11/1/2026 1:30:00 AM",), ("3/8/2026 2:30:00 AM",), ("bad",)]
    local = T.wall_clock(F.col("t"))
    got = rows_of(spark.createDataFrame(texts, "t string").select(T.instant(local), T.instant(local, None)))
    assert [g[0] for g in got] == [
        dt.datetime(2026, 1, 2, 18), dt.datetime(2026, 1, 2, 18), dt.datetime(2026, 11, 1, 5, 30),
        dt.datetime(2026, 3, 8, 7, 30), None,
    ]
    assert got[0][1] == dt.datetime(2026, 1, 2, 13)


def test_running_values_do_not_depend_on_blocks(spark):
    rng = random.Random(5)
    rows, carried, following = [], {}, {}
    for g in range(12):
        size, last = rng.choice([1, 2, 3, 100]), None
        values = [rng.choice([None, None, n]) for n in range(rng.randint(1, 15))]
        for n, value in enumerate(values):
            last = value if value is not None else last
            carried[g, n] = last
            following[g, n] = values[n + 1] if n + 1 < len(values) else None
            rows.append((g, n // size, n, value))
    df = spark.createDataFrame(rows, "g int, block int, n int, v int")
    got = rows_of(carry_forward(df, ["g"], "block", ["n"], F.col("v"), "out"), "g", "n", "out")
    assert {(g, n): v for g, n, v in got} == carried
    got = rows_of(next_value(df, ["g"], "block", ["n"], F.col("v"), "out"), "g", "n", "out")
    assert {(g, n): v for g, n, v in got} == following


def test_ids_are_dense_and_ordered(spark):
    rng = random.Random(4)
    keys = [(f"k{rng.random():.12f}" if n % 3 else "hot", n) for n in range(3000)]
    got = rows_of(assign_ids(spark.createDataFrame(keys, "k string, n int").repartition(7), ["k", "n"], "id", 50))
    by_id = sorted(got, key=lambda r: r[2])
    assert [r[2] for r in by_id] == list(range(51, 3051))
    assert [(r[0], r[1]) for r in by_id] == sorted(keys)


def test_cards(spark, tmp_path):
    base = {"oracle_id": "o", "name": "n", "scryfall_uri": "u?x=1", "released_at": "2026-01-01", "legalities": {"a": "b"}}
    cards = [
        {**base, "arena_id": 5, "cmc": 2.5, "colors": ["W", "U"], "color_identity": []},
        {**base, "cmc": 1.0},
        {**base, "arena_id": 5, "cmc": 9.0, "name": "later"},
        {**base, "arena_id": 6, "cmc": 0.0, "color_identity": ["G"]},
    ]
    (tmp_path / "bulk.json").write_text(json.dumps(cards))
    read = card_bulk.read_cards(spark, str(tmp_path / "bulk.json"))
    once = dims.dim_cards(dims.first_per_id(dims.on_client(read), ["file", "ord"]))
    cols = ["arena_id", "card_name", "cmc", "colors", "color_identity", "scryfall_uri"]
    assert sorted(rows_of(once, *cols)) == [(5, "n", 2, "WU", "", "u"), (6, "n", 0, "", "G", "u")]
    local = dims.local_cards(read)
    assert local.count() == 3
    card_bulk.write_cards(local, str(tmp_path / "csv"), "csv")
    back = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "csv"))
    assert {r.colors for r in back.collect()} == {'["W","U"]', None}
    card_bulk.write_cards(local, str(tmp_path / "pq"))
    assert spark.read.parquet(str(tmp_path / "pq")).schema["legalities"].dataType.typeName() == "map"


def test_column_tests(spark):
    df = spark.createDataFrame([(1,), (None,), (1,), (2,)], "id int")
    assert rows_of(Q.repeated(df, ["id"])) == [(1, 2)]
    assert rows_of(Q.null_counts(df, ["id"])) == [("id", 1)]
    assert rows_of(Q.orphans(df, "id", spark.createDataFrame([(2,)], "k int"), "k")) == [(1,), (1,)]
    spec = SILVER["players"]
    bad = Q.require(Q.conform(spark.createDataFrame([(None, "x")], "player_id string, display_name string"), spec), spec)
    try:
        bad.collect()
        raise AssertionError("a NULL key must fail")
    except Exception as error:
        assert "player_id" in str(error)


def test_gold_edges(spark):
    """Ties, unknown cards, decks without cards, matches without hands, draws."""
    start = dt.datetime(2026, 1, 31)
    matches = spark.createDataFrame(
        [(1, 10, "A", 1, start, 100, 1), (2, 11, "A", 1, start - dt.timedelta(days=40), 50, 2),
         (3, 12, "B", 2, start, 10, 0)],
        "match_id bigint, deck_id bigint, player_id string, player_seat int, start_time timestamp, duration_sec bigint, winner_seat int",
    )
    silver = {
        "matches": matches,
        "players": spark.createDataFrame([("A", "Ann")], "player_id string, display_name string"),
        "decks": spark.createDataFrame(
            [(10, "x", "A", [1, 1, 2, 99]), (11, "y", "A", []), (12, "z", "B", [99])],
            "deck_id bigint, deck_name string, player_id string, deck_list array<bigint>",
        ),
        "turn1_hands": spark.createDataFrame(
            [(1, 1, [2, 2], 0), (2, 1, [1, 7], 1)],
            "hand_id bigint, match_id bigint, initial_hand array<bigint>, mulliganCount int",
        ),
        "dim_cards": spark.createDataFrame(
            [(1, "one", 3, "UG"), (2, "two", 0, ""), (7, "seven", 1, "R")],
            "arena_id bigint, card_name string, cmc bigint, colors string",
        ),
    }
    tables = gold.build(silver)
    number = lambda v: None if v is None else float(v)
    p = {r.player_id: r for r in tables["player_metrics"].collect()}
    a, b = p["A"], p["B"]
    assert (a.total_matches, a.total_wins, a.total_losses, number(a.win_rate), number(a.win_rate_30d)) == (2, 1, 1, 0.5, 1.0)
    assert (number(a.avg_mulligans), number(a.mulligan1_win_rate), a.mulligan0_win_rate) == (1.0, 1.0, None)
    assert (a.most_played_deck_id, a.most_played_deck_name, a.time_last_played) == (10, "x", start)
    assert (b.display_name, b.total_wins, b.total_losses, b.avg_mulligans) == (None, 0, 0, None)
    d = {r.deck_id: r for r in tables["deck_metrics"].collect()}
    assert (d[10].colors, d[10].cmc_curve, number(d[10].cmc_avg)) == ("GU", [1, 0, 0, 2], 2.0)
    assert (d[11].colors, d[11].cmc_curve, d[11].total_matches) == (None, None, 1)
    assert (d[12].colors, d[12].cmc_curve, d[12].cmc_avg, d[12].matchup_winrate) == ("", None, None, [])
    c = {(r.player_id, r.deck_id, r.arena_id): r for r in tables["card_metrics"].collect()}
    assert sorted(c) == [("A", 10, 1), ("A", 10, 2), ("A", 10, 7), ("A", 10, 99), ("B", 12, 99)]
    assert (number(c["A", 10, 1].win_rate_opener), c["A", 10, 1].total_in_deck, number(c["A", 10, 1].draw_chance)) == (1.0, 2, 0.5)
    assert c["A", 10, 2].win_rate_opener is None
    assert (c["A", 10, 7].card_name, c["A", 10, 7].total_in_deck) == ("seven", None)
