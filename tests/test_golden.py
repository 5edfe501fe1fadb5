import datetime as dt
import hashlib
import json

import pytest
from conftest import as_lines, golden_log, rows_of

from duelspark.operators import bronze as B
from duelspark.operators import games as G
from duelspark.operators import messages as M
from duelspark.plans import gold, silver
from duelspark.sources.store import Store


@pytest.fixture(scope="module", params=[None, 3], ids=lambda b: f"block{b}")
def lines(spark, request):
    return as_lines(spark, {"a.log": golden_log()}, request.param)


def test_bronze_rows(lines):
    rows = B.bronze(lines).orderBy("row_ord").collect()
    assert [(r.game_num, r.player_id, r.timestamp, r.event) for r in rows] == [
        (1, "PLAYERA", "1/2/2026 1:00:00 PM", "deck_list"),
        (1, "PLAYERA", "1/2/2026 1:00:00 PM", "GreToClientEvent"),
        (1, "PLAYERA", "1/2/2026 1:00:20 PM", "GreToClientEvent"),
        (1, "PLAYERA", "1/2/2026 1:05:30 PM", "MatchGameRoomStateChangedEvent"),
        (2, "PLAYERA", "1/2/2026 2:00:00 PM", "GreToClientEvent"),
    ]
    assert isinstance(json.loads(rows[4].payload), str)
    assert len(json.loads(rows[1].payload)) == 2
    assert json.loads(rows[3].payload)[0]["gameRoomConfig"]["matchId"] == "m-1"
    assert "request" in json.loads(rows[0].payload)[0]


def test_quarantine_and_manifest(spark, lines):
    assert rows_of(B.quarantine(lines), "game_num", "reason") == [(2, "header")]
    files = spark.createDataFrame([("a.log",), ("empty.log",)], "source_file string")
    assert sorted(rows_of(B.file_manifest(files, lines))) == [
        ("a.log", 3, 4, "parsed"),
        ("empty.log", 0, 0, "no_games"),
    ]


@pytest.fixture(scope="module")
def shaped(lines):
    return silver.shape(B.bronze(lines))


def test_silver(lines, shaped):
    assert rows_of(shaped.players) == [("PLAYERA", "Ann")]
    (match,) = shaped.matches.collect()
    assert (match.player_seat, match.winner_seat, match.duration_sec, match.game_format) == (1, 1, 330, "Standard")
    assert match.start_time == dt.datetime(2026, 1, 2, 18, 0)
    (deck,) = shaped.decks.collect()
    assert (deck.deck_name, deck.deck_list, deck.deck_sideboard, deck.deck_commander) == ("Sample", [101, 101, 102], [], "")
    assert deck.deck_hash == hashlib.sha256(b"[101, 101, 102]").hexdigest()
    assert deck.side_hash == hashlib.sha256(b"[]").hexdigest()
    assert rows_of(G.incomplete(B.bronze(lines), shaped.games), "game_num") == [(2,)]


def test_hands(lines, shaped):
    cols = ("initial_hand", "mulliganCount", "discarded", "went_first")
    hands = rows_of(shaped.hands.orderBy("row_ord", "msg_pos"), *cols)
    assert hands == [([101, 102], 0, [], True), ([101, 101], 1, [], True), ([101], 1, [101], True)]
    from duelspark.operators import hands as H

    opening = H.opening(H.candidates(M.explode_messages(B.bronze(lines))))
    collapsed = rows_of(H.turn1_hands(opening, collapse=True).orderBy("row_ord", "msg_pos"), *cols)
    assert collapsed == [([101, 102], 0, [], True), ([101], 1, [101], True)]


def test_load_twice_and_gold(spark, shaped, tmp_path):
    store = Store(spark, "golden_" + tmp_path.name.replace("-", "_"))
    store.create(str(tmp_path / "db"), replace=True)
    for _ in range(2):
        silver.load(store, shaped)
        assert dict(rows_of(silver.row_totals(store))) == {
            "players": 1, "matches": 1, "decks": 1, "turn1_hands": 3, "dim_cards": 0,
        }
    store.append(
        "dim_cards",
        spark.createDataFrame([(101, "A", 2, "U"), (102, "B", 0, "G")], "arena_id bigint, card_name string, cmc bigint, colors string")
        .selectExpr("arena_id", "'o' oracle_id", "card_name", "'' scryfall_uri", "'' mana_cost", "cmc", "colors",
                    "'' color_identity", "'' type_line", "'' set_code", "'' set_name", "'' set_type", "'' rarity"),
    )
    gold.reload(store, silver.read_all(store))
    (p,) = store.read("player_metrics").collect()
    assert (p.total_matches, p.total_wins, p.total_losses, float(p.win_rate), float(p.avg_mulligans)) == (1, 1, 0, 1.0, 1.0)
    assert (p.mulligan0_win_rate, float(p.mulligan1_win_rate), p.most_played_deck_name) == (None, 1.0, "Sample")
    (d,) = store.read("deck_metrics").collect()
    assert (d.colors, d.cmc_curve, round(float(d.cmc_avg), 6)) == ("GU", [1, 0, 2], 1.333333)
    cards = {r.arena_id: r for r in store.read("card_metrics").collect()}
    assert {k: (r.total_in_deck, round(float(r.draw_chance), 6)) for k, r in cards.items()} == {
        101: (2, 0.666667), 102: (1, 0.333333)
    }
    assert float(cards[101].win_rate_opener) == 1.0 and cards[102].win_rate_opener is None
