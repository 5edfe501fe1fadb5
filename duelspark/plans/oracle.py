"""The registered queries as SQL, worked out from the tables' own columns.

The log queries do not build or parse any text here: they state which rows the
parser must give for the events the log was made from.
"""

from __future__ import annotations

from duelspark.functions.payloads import SUMMARIZED as SUMMARY

TIME = "strftime(ts, '%-m/%-d/%Y %-I:%M:%S %p')"


def _ratio(over: str, under: str) -> str:
    """A quotient of whole numbers at nine places, halves up, worked out in whole numbers; NULL over 0."""
    return f"(((2000000000::HUGEINT * ({over}) + ({under})) // (2 * nullif({under}, 0)))::DOUBLE / 1000000000)"


# Events by their part in the log; running state; headers; bronze rows.
LOG = f"""
WITH ev AS (
  SELECT event_id, user_id, ts, event_type, cast(regexp_extract(props, '([0-9]+)', 1) AS integer) AS k FROM events
), cl AS (
  SELECT *, k % 10 AS r, cast(1 + user_id % 2 AS integer) AS seat, 'P' || user_id AS player_id, {TIME} AS "timestamp",
    CASE WHEN event_type = 'signup' AND k < 50 THEN 'start' WHEN event_type = 'signup' THEN 'noise'
         WHEN event_type = 'error' AND k < 50 THEN 'end' WHEN event_type = 'error' THEN 'bad'
         WHEN event_type = 'view' THEN 'deck'
         WHEN event_type = 'click' AND k < 30 THEN 'unwanted' WHEN event_type = 'click' AND k >= 90 THEN 'lone'
         ELSE 'record' END AS what
  FROM ev
), st AS (
  SELECT *,
    cast(sum(CASE WHEN what = 'start' THEN 1 ELSE 0 END) OVER w AS integer) AS game_num,
    last_value(CASE WHEN what IN ('start', 'end') THEN what END IGNORE NULLS) OVER w AS mark,
    last_value(CASE WHEN what = 'deck' THEN event_id END IGNORE NULLS) OVER w AS deck_event,
    last_value(CASE WHEN what = 'deck' THEN k END IGNORE NULLS) OVER w AS deck_k,
    lead(what) OVER (PARTITION BY user_id ORDER BY event_id) AS next_what,
    lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS next_event
  FROM cl
  WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), hd AS (
  SELECT *, lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS before
  FROM st WHERE what IN ('record', 'lone') AND mark = 'start'
), br AS (
  SELECT user_id, game_num, player_id, "timestamp", ts, 'deck_list' AS event, cast(deck_event AS varchar) AS fact,
    event_id, 0 AS sub, -1 AS r, deck_k AS k, seat
  FROM hd WHERE deck_event IS NOT NULL AND (before IS NULL OR before < deck_event)
  UNION ALL
  SELECT user_id, game_num, player_id, "timestamp", ts,
    CASE WHEN r <= 2 THEN 'MatchGameRoomStateChangedEvent' WHEN r = 3 THEN 'QueueEvent' ELSE 'GreToClientEvent' END,
    CASE WHEN r <= 2 THEN 'M' || event_id WHEN r = 3 THEN 't' || event_id WHEN r = 4 THEN '{SUMMARY}'
         ELSE cast((event_id * 7 + 13 + k) % 2000 AS varchar) END,
    event_id, 1, r, k, seat
  FROM hd WHERE what = 'record' AND NOT (r = 9 AND event_id % 5 = 0)
  UNION ALL
  SELECT user_id, game_num, player_id, "timestamp", ts, 'GreToClientEvent', 'scene ' || next_event || ' loaded',
    event_id, 1, -2, k, seat
  FROM hd WHERE what = 'lone' AND next_what = 'noise'
)"""

FACTS = 'SELECT user_id, game_num, player_id, "timestamp", event, fact FROM br'

STATE = "'GREMessageType_GameStateMessage'"

MESSAGES = LOG + f""", ms AS (
  SELECT br.*, cast(p.pos AS integer) AS msg_pos,
    CASE WHEN r >= 5 AND (p.pos < 2 OR r = 8) THEN {STATE} WHEN r >= 5 THEN 'GREMessageType_UIMessage' END AS type
  FROM br JOIN (SELECT unnest([0, 1, 2]) AS pos) p ON p.pos = 0 OR r >= 5
  WHERE r <> 4
)"""

ENDS = MESSAGES + """, nu AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, game_num ORDER BY event_id, sub, msg_pos) AS n,
    count(*) OVER (PARTITION BY user_id, game_num) AS messages,
    count(CASE WHEN msg_pos = 0 THEN 1 END) OVER (PARTITION BY user_id, game_num) AS "rows"
  FROM ms
), en AS (
  SELECT f.user_id, f.game_num, f.player_id, f."timestamp" AS first_time, l."timestamp" AS last_time, f."rows",
    CASE WHEN f.r = -1 THEN f.fact END AS deck_event, CASE WHEN f.r = -1 THEN f.k END AS dk,
    CASE WHEN l.r BETWEEN 0 AND 2 THEN l.fact END AS room, l.r IN (0, 1) AS complete,
    l.event_id AS last_event, l.k AS last_k, f.seat, f.ts AS first_ts, l.ts AS last_ts
  FROM nu f JOIN nu l ON f.user_id = l.user_id AND f.game_num = l.game_num
  WHERE f.n = 1 AND l.n = l.messages
)"""

GAMES = ENDS + """, gm AS (
  SELECT *, 'user-' || user_id AS source_file, dk IS NOT NULL AND dk % 13 <> 0 AS has_deck,
    'N' || user_id || '-' || last_k AS display_name, cast(1 + last_event % 2 AS integer) AS winner_seat,
    room AS match_key,
    CASE WHEN dk IS NULL OR dk % 7 = 0 THEN 'Event' WHEN dk % 5 = 0 THEN NULL ELSE 'Format' || (dk % 4) END AS game_format
  FROM en
), dk AS (
  SELECT *,
    CASE WHEN has_deck THEN 'Deck ' || (dk % 6) ELSE 'Blank' END AS deck_name,
    CASE WHEN has_deck THEN list_concat([50 + dk % 3, 50 + dk % 3],
      list_transform(range(1 + dk % 3), lambda i: 100 + dk % 4)) ELSE [] END AS deck_list,
    CASE WHEN has_deck AND dk % 2 = 1 THEN '7,7' ELSE '' END AS deck_sideboard,
    CASE WHEN has_deck AND dk % 11 <> 0 AND dk % 3 = 0 THEN cast(900 + dk % 2 AS varchar) ELSE '' END AS deck_commander,
    CASE WHEN has_deck AND dk % 2 = 1 THEN sha256('[{"cardId": 7, "quantity": 2}]') ELSE sha256('[]') END AS side_hash
  FROM gm
), ga AS (
  SELECT * REPLACE (array_to_string(deck_list, ',') AS deck_list),
    sha256('[' || array_to_string(deck_list, ', ') || ']') AS deck_hash
  FROM dk
)"""

DECK = "deck_name, player_id, match_key, deck_list, deck_sideboard, deck_commander, deck_hash, side_hash"

FIRST_DECK = """, fd AS (
  SELECT *, row_number() OVER (PARTITION BY deck_hash, side_hash ORDER BY source_file, game_num) AS n
  FROM ga WHERE complete
)"""

UTC = "timezone('UTC', timezone('America/Toronto', date_trunc('second', {0})))"
SECONDS = "cast(epoch(date_trunc('second', {0})) AS bigint)"

HANDS = MESSAGES + f""", bo AS (
  SELECT user_id, game_num, min(CASE WHEN r = 8 AND msg_pos = 2 THEN event_id END) AS begin_event, min(event_id) AS first_event
  FROM ms WHERE type = {STATE} GROUP BY ALL
), op AS (
  SELECT ms.*, begin_event IS NULL AS unfinished, 1 + (k % 2) * 2 AS i1
  FROM ms JOIN bo USING (user_id, game_num)
  WHERE type = {STATE} AND msg_pos < 2 AND NOT (event_id = first_event AND msg_pos = 0)
    AND (begin_event IS NULL OR event_id <= begin_event)
), oz AS (
  SELECT *, CASE WHEN msg_pos = 0 THEN [i1, i1 + 1, i1 + 2] ELSE [i1, 3, 7] END AS ids,
    CASE WHEN msg_pos = 0 AND k % 3 = 0 THEN i1 + 2 END AS returned,
    CASE WHEN msg_pos = 0 AND event_id % 4 <> 0 THEN k % 4 END AS mulligan
  FROM op
), im AS (
  SELECT user_id, game_num, cast(i1 - 1 + j AS bigint) AS instance_id, max_by((event_id * 7 + j * 13 + k) % 2000, event_id) AS arena_id
  FROM oz, (SELECT unnest([1, 2, 3]) AS j) WHERE msg_pos = 0 GROUP BY ALL
)"""

CARDS = HANDS + """, hc AS (
  SELECT z.user_id, z.game_num, z.event_id, z.msg_pos, any_value(z.player_id) AS player_id, any_value(z.seat) AS seat,
    any_value(z.mulligan) AS mulligan,
    list(im.arena_id ORDER BY z.p) FILTER (WHERE im.arena_id IS NOT NULL) AS hand,
    any_value(rm.arena_id) AS returned
  FROM (SELECT *, unnest(ids) AS id, unnest([1, 2, 3]) AS p FROM oz) z
  LEFT JOIN im ON im.user_id = z.user_id AND im.game_num = z.game_num AND im.instance_id = z.id
  LEFT JOIN im rm ON rm.user_id = z.user_id AND rm.game_num = z.game_num AND rm.instance_id = z.returned
  GROUP BY z.user_id, z.game_num, z.event_id, z.msg_pos
  HAVING count(im.arena_id) + count(rm.arena_id) > 0
), fi AS (
  SELECT *, cast(coalesce(last_value(CASE WHEN hand IS NOT NULL THEN mulligan END IGNORE NULLS) OVER (
    PARTITION BY user_id, game_num ORDER BY event_id, msg_pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS integer)
    AS "mulliganCount"
  FROM hc
), th AS (
  SELECT *, lead(hand) OVER (PARTITION BY user_id, game_num ORDER BY event_id, msg_pos) AS following
  FROM fi WHERE hand IS NOT NULL
)"""

HAND = """SELECT user_id, game_num, msg_pos, player_id, array_to_string(hand, ',') AS initial_hand, "mulliganCount",
  coalesce(cast(returned AS varchar), '') AS discarded, seat = 1 AS went_first FROM th"""


# --- silver and gold stand-ins --------------------------------------------------------

GOLD = f"""
WITH m AS (
  SELECT o_orderkey AS match_id, o_custkey * 3 + o_orderkey % 3 AS deck_id, cast(o_custkey AS varchar) AS player_id,
    o_orderstatus = 'F' AS won, o_orderstatus = 'O' AS lost, cast(o_orderdate AS timestamp) AS start_time,
    cast(floor(o_totalprice) AS bigint) % 3600 AS duration_sec
  FROM orders
), mu AS (
  SELECT l_orderkey AS match_id, max(l_linenumber % 3) AS mulligans FROM lineitem GROUP BY 1
), f AS (
  SELECT m.*, mulligans, start_time > (SELECT max(start_time) FROM m) - INTERVAL 30 DAYS AS recent
  FROM m LEFT JOIN mu USING (match_id)
), d AS (
  SELECT deck_id, min(match_id) AS match_id, 'Deck ' || deck_id AS deck_name, any_value(player_id) AS player_id
  FROM m GROUP BY deck_id
), dc AS (
  SELECT deck_id, l_partkey AS arena_id, cast(sum(l_quantity) AS bigint) AS copies
  FROM lineitem JOIN m ON l_orderkey = match_id GROUP BY ALL
), df AS (
  SELECT deck_id, arena_id, copies, p_size AS cmc, substr(p_type, 1, 1) AS colors
  FROM dc LEFT JOIN part ON p_partkey = arena_id
), mk AS (
  SELECT deck_id, coalesce(string_agg(DISTINCT colors, '' ORDER BY colors), '') AS colors,
    {_ratio('sum(cmc * copies)', 'sum(CASE WHEN cmc IS NOT NULL THEN copies END)')} AS cmc_avg
  FROM df GROUP BY deck_id
), cu AS (
  SELECT deck_id, string_agg(cast(n AS varchar), ',' ORDER BY c) AS cmc_curve FROM (
    SELECT t.deck_id, t.c, coalesce(sum(copies), 0)::bigint AS n
    FROM (SELECT deck_id, unnest(range(max(cmc) + 1)) AS c FROM df GROUP BY deck_id) t
    LEFT JOIN df ON df.deck_id = t.deck_id AND df.cmc = t.c GROUP BY ALL)
  GROUP BY deck_id
), ch AS (
  SELECT deck_id, arena_id, copies AS total_in_deck,
    {_ratio('copies', 'sum(copies) OVER (PARTITION BY deck_id)')} AS draw_chance
  FROM dc
), oh AS (
  SELECT l_orderkey AS match_id, max_by(l_partkey, l_linenumber * 1000000000000 + l_partkey) AS card FROM lineitem GROUP BY 1
), oc AS (
  SELECT player_id, deck_id, card + j AS arena_id,
    {_ratio('count(*) FILTER (WHERE won)', 'count(*)')} AS win_rate_opener
  FROM oh JOIN m USING (match_id), (SELECT unnest([0, 1, 2]) AS j) GROUP BY ALL
), mp AS (
  SELECT player_id, deck_id AS most_played_deck_id, 'Deck ' || deck_id AS most_played_deck_name,
    row_number() OVER (PARTITION BY player_id ORDER BY count(*) DESC, deck_id) AS n
  FROM m GROUP BY player_id, deck_id
)"""


def _rate(test: str, base: str = "true") -> str:
    return _ratio(f"count(*) FILTER (WHERE ({test}) AND ({base}))", f"count(*) FILTER (WHERE {base})")


MULLIGANS = ", ".join(
    [f"{_ratio('sum(mulligans)', 'count(mulligans)')} AS avg_mulligans"]
    + [f"{_rate('won', f'mulligans = {n}')} AS mulligan{n}_win_rate" for n in (0, 1, 2)]
)

RECENT = f"{_rate('won', 'recent')} AS win_rate_30d"

CARD_SOURCE = """
WITH c AS (
  SELECT CASE WHEN p_partkey % 10 = 0 THEN NULL WHEN p_partkey % 10 = 1 THEN 0 ELSE p_partkey - p_partkey % 3 END AS arena_id,
    'o-' || p_partkey AS oracle_id, p_name AS card_name, 'https://cards.example/' || p_partkey AS scryfall_uri,
    '{' || p_size || '}' AS mana_cost, cast(p_size // 2 AS bigint) AS cmc,
    CASE WHEN p_partkey % 4 = 0 THEN '' ELSE substr('WUBRG', 1, p_partkey % 3) END AS colors,
    substr('WUBRG', 1, p_partkey % 5) AS color_identity, p_type AS type_line, p_brand AS set_code,
    p_brand AS set_name, 'core' AS set_type,
    CASE WHEN p_partkey % 2 = 0 THEN 'common' ELSE 'rare' END AS rarity,
    p_partkey, p_size
  FROM part
)"""

CARD_COLUMNS = (
    "arena_id, oracle_id, card_name, scryfall_uri, mana_cost, cmc, colors, color_identity, type_line, set_code, set_name, set_type, rarity"
)

MODEL = """
WITH s AS (
  SELECT o_orderkey AS id FROM orders WHERE o_orderstatus <> 'P'
  UNION ALL SELECT NULL FROM orders WHERE o_orderstatus = 'P'
)"""

DECK_COUNTS = """
WITH x AS (
  SELECT l_orderkey AS match_id, l_linenumber AS line, l_suppkey, l_returnflag,
    list_sort(list_concat([l_suppkey, l_suppkey], list_transform(range(l_linenumber), lambda i: l_partkey))) AS ids
  FROM lineitem
)"""

MATCH_COLUMNS = {
    "match_id": "o_orderkey", "deck_id": "o_custkey", "player_id": "o_custkey", "player_seat": "o_orderkey",
    "start_time": "o_orderdate", "duration_sec": "o_totalprice", "winner_seat": "o_orderkey",
    "game_format": "o_orderpriority", "draw_order": "o_orderkey", "match_key": "o_orderkey",
}

ORACLE = {
    "log_scan": LOG + FACTS,
    "bronze_roundtrip": LOG + FACTS,
    "landing_csv": LOG + FACTS,
    "stream_ingest": LOG + FACTS,
    "grown_logs": LOG + FACTS,
    "stream_parts": LOG + FACTS,
    "new_files": """
        SELECT DISTINCT user_id FROM events
        WHERE user_id NOT IN (SELECT user_id FROM events WHERE ts < TIMESTAMP '2024-01-01 06:00:00')""",
    "file_manifest": LOG + """
        SELECT user_id, games, coalesce(n, 0) AS "rows", CASE WHEN n > 0 THEN 'parsed' ELSE 'no_games' END AS status
        FROM (SELECT user_id, count(*) FILTER (WHERE what = 'start') AS games FROM cl GROUP BY user_id)
        LEFT JOIN (SELECT user_id, count(*) AS n FROM br WHERE sub = 1 GROUP BY user_id) USING (user_id)""",
    "grown_manifest": LOG + """
        SELECT user_id, games, coalesce(n, 0) AS "rows", CASE WHEN n > 0 THEN 'parsed' ELSE 'no_games' END AS status,
          coalesce(bad, 0) AS bad
        FROM (SELECT user_id, count(*) FILTER (WHERE what = 'start') AS games FROM cl GROUP BY user_id)
        LEFT JOIN (SELECT user_id, count(*) FILTER (WHERE sub = 1) AS n FROM br GROUP BY user_id) USING (user_id)
        LEFT JOIN (SELECT user_id, count(*) AS bad FROM (
            SELECT user_id FROM st WHERE mark = 'start' AND what = 'bad'
            UNION ALL SELECT user_id FROM hd WHERE what = 'lone' AND next_what IS DISTINCT FROM 'noise'
            UNION ALL SELECT user_id FROM hd WHERE what = 'record' AND r = 9 AND event_id % 5 = 0) GROUP BY user_id) USING (user_id)""",
    "incremental_batch": LOG + """
        SELECT user_id, games, coalesce(n, 0) AS "rows", CASE WHEN n > 0 THEN 'parsed' ELSE 'no_games' END AS status,
          coalesce(stored, 0) AS stored
        FROM (SELECT user_id, count(*) FILTER (WHERE what = 'start') AS games FROM cl GROUP BY user_id)
        LEFT JOIN (SELECT user_id, count(*) FILTER (WHERE sub = 1) AS n, count(*) AS stored FROM br GROUP BY user_id)
        USING (user_id)""",
    "silver_append": CARDS + ENDS.removeprefix(MESSAGES) + GAMES.removeprefix(ENDS) + """
        SELECT 'players' AS table_name, count(DISTINCT player_id) AS "rows" FROM ga WHERE complete
        UNION ALL SELECT 'matches', count(*) FROM ga WHERE complete
        UNION ALL SELECT 'decks', count(DISTINCT (deck_hash, side_hash)) FROM ga WHERE complete
        UNION ALL SELECT 'turn1_hands', count(*) FROM th JOIN ga USING (user_id, game_num) WHERE complete""",
    "schema_check": " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, count(*) FILTER (WHERE {source} IS NULL) AS nulls FROM orders"
        for name, source in MATCH_COLUMNS.items()
    ),
    "table_layout": 'SELECT cast(o_custkey AS varchar) AS player_id, count(*) AS "rows" FROM orders GROUP BY 1',
    "table_counts": """
        SELECT 'players' AS table_name, count(*) AS "rows" FROM customer
        UNION ALL SELECT 'matches', count(*) FROM orders
        UNION ALL SELECT 'decks', count(DISTINCT o_custkey * 3 + o_orderkey % 3) FROM orders
        UNION ALL SELECT 'turn1_hands', count(*) FROM lineitem
        UNION ALL SELECT 'dim_cards', count(*) FROM part""",
    "log_markers": LOG + "SELECT user_id, event_id, what AS kind FROM cl WHERE what IN ('start', 'end')",
    "log_filter": LOG + "SELECT user_id, event_id FROM cl WHERE what IN ('start', 'end', 'bad', 'lone', 'record')",
    "log_header": LOG + """
        SELECT user_id, event_id, "timestamp", player_id,
          CASE WHEN what = 'lone' THEN 'GreToClientEvent' WHEN r <= 2 THEN 'MatchGameRoomStateChangedEvent'
               WHEN r = 3 THEN 'QueueEvent' ELSE 'GreToClientEvent' END AS event,
          what = 'record' AND r = 3 AS inline
        FROM cl WHERE what IN ('lone', 'record')""",
    "game_sessionize": LOG + """
        SELECT user_id, event_id, game_num FROM st WHERE mark = 'start' AND what IN ('lone', 'record', 'bad')""",
    "deck_carry": LOG + FACTS + " WHERE event = 'deck_list'",
    "payload_project": LOG + FACTS + " WHERE event <> 'deck_list'",
    "quarantine": LOG + """
        SELECT user_id, game_num, 'header' AS reason FROM st WHERE mark = 'start' AND what = 'bad'
        UNION ALL SELECT user_id, game_num, 'no_payload' FROM hd WHERE what = 'lone' AND next_what IS DISTINCT FROM 'noise'
        UNION ALL SELECT user_id, game_num, 'no_branch' FROM hd WHERE what = 'record' AND r = 9 AND event_id % 5 = 0""",
    "incomplete_games": GAMES + """
        SELECT DISTINCT br.user_id, br.game_num, br.player_id FROM br
        LEFT JOIN (SELECT user_id, game_num FROM ga WHERE complete) c USING (user_id, game_num) WHERE c.user_id IS NULL""",
    "payload_explode": MESSAGES + 'SELECT user_id, game_num, "timestamp", event, msg_pos, type FROM ms',
    "game_first_last": ENDS + """
        SELECT user_id, game_num, player_id, first_time, last_time, "rows", deck_event, room FROM en""",
    "players": GAMES + "SELECT player_id, min_by(display_name, game_num) AS display_name FROM ga WHERE complete GROUP BY 1",
    "players_upsert": GAMES + """
        SELECT player_id, min_by(display_name, game_num) AS display_name FROM ga
        WHERE complete AND player_id NOT IN (
          SELECT 'P' || c_custkey FROM customer WHERE c_mktsegment IN ('MACHINERY', 'FURNITURE')) GROUP BY 1""",
    "match_times": f"""
        SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS local_time,
          strftime({UTC.format('ts')}, '%Y-%m-%d %H:%M:%S') AS utc_time,
          cast(epoch({UTC.format('ts')}) AS bigint) AS epoch,
          {SECONDS.format('ts')} - cast(epoch(TIMESTAMP '2024-01-01') AS bigint) AS seconds FROM events""",
    "match_format": GAMES + "SELECT user_id, game_num, game_format FROM ga",
    "matches": GAMES + FIRST_DECK + f"""
        SELECT a.match_key, a.user_id, a.game_num, a.player_id, a.seat AS player_seat, a.winner_seat, a.game_format,
          {SECONDS.format('a.last_ts')} - {SECONDS.format('a.first_ts')} AS duration_sec,
          strftime({UTC.format('a.first_ts')}, '%Y-%m-%d %H:%M:%S') AS start_time, d.match_key AS deck_match
        FROM ga a JOIN fd d ON a.deck_hash = d.deck_hash AND a.side_hash = d.side_hash AND d.n = 1 WHERE a.complete""",
    "decks": GAMES + f"SELECT user_id, game_num, {DECK} FROM ga WHERE complete",
    "decks_dedup": GAMES + FIRST_DECK + f"SELECT {DECK} FROM fd WHERE n = 1",
    "decks_dedup_named": GAMES + f"""
        SELECT {DECK} FROM (
          SELECT *, row_number() OVER (PARTITION BY deck_name, deck_list, deck_sideboard, deck_commander
            ORDER BY source_file, game_num) AS n FROM ga WHERE complete) WHERE n = 1""",
    "deck_flatten": DECK_COUNTS + "SELECT match_id, line, array_to_string(ids, ',') AS deck_list FROM x",
    "deck_hash": DECK_COUNTS + """
        SELECT match_id, line, sha256('[' || array_to_string(ids, ', ') || ']') AS deck_hash,
          sha256(CASE WHEN l_returnflag = 'R' THEN '[{"cardId": ' || l_suppkey || ', "quantity": ' || line || '}]'
            ELSE '[]' END) AS side_hash FROM x""",
    "surrogate_keys": """
        SELECT o_orderkey, o_custkey, 1000 + row_number() OVER (ORDER BY o_custkey, o_orderkey) AS match_id FROM orders""",
    "hand_messages": HANDS + "SELECT user_id, game_num, msg_pos, unfinished, array_to_string(ids, ',') AS ids FROM oz",
    "instance_map": HANDS + "SELECT user_id, game_num, instance_id, arena_id FROM im",
    "hand_zones": HANDS + """
        SELECT user_id, game_num, msg_pos, CASE WHEN seat = 1 THEN mulligan END AS mulligan1,
          CASE WHEN seat = 2 THEN mulligan END AS mulligan2,
          CASE WHEN seat = 1 THEN array_to_string(ids, ',') END AS zone1,
          CASE WHEN seat = 2 THEN array_to_string(ids, ',') END AS zone2, cast(returned AS varchar) AS zone3 FROM oz""",
    "hand_cards": CARDS + """
        SELECT user_id, game_num, msg_pos, CASE WHEN seat = 1 THEN array_to_string(hand, ',') END AS cards1,
          CASE WHEN seat = 2 THEN array_to_string(hand, ',') END AS cards2, cast(returned AS varchar) AS cards3 FROM hc""",
    "mulligan_fill": CARDS + 'SELECT user_id, game_num, msg_pos, "mulliganCount" FROM fi',
    "turn1_hands": CARDS + HAND,
    "hands_collapsed": CARDS + HAND + """
        WHERE following IS NULL OR len(list_filter(list_distinct(following), lambda x:
          len(list_filter(following, lambda y: y = x)) > len(list_filter(hand, lambda y: y = x)))) > 0""",
    "dim_cards": CARD_SOURCE + f"SELECT {CARD_COLUMNS} FROM c WHERE arena_id <> 0",
    "card_array": CARD_SOURCE + f"SELECT {CARD_COLUMNS} FROM c WHERE arena_id <> 0",
    "dim_cards_dedup": CARD_SOURCE + f"""
        SELECT {CARD_COLUMNS} FROM (
          SELECT *, row_number() OVER (PARTITION BY arena_id ORDER BY p_partkey) AS n FROM c WHERE arena_id <> 0)
        WHERE n = 1""",
    "card_colors": CARD_SOURCE + "SELECT oracle_id, colors, color_identity FROM c",
    "local_cards": CARD_SOURCE + """
        SELECT arena_id, oracle_id, card_name AS name,
          strftime(DATE '2020-01-01' + cast(p_size AS integer), '%Y-%m-%d') AS released_at, scryfall_uri, mana_cost, p_size / 2.0 AS cmc,
          CASE WHEN p_partkey % 4 = 0 THEN NULL WHEN p_partkey % 3 = 0 THEN '' WHEN p_partkey % 3 = 1 THEN 'W' ELSE 'W,U' END AS colors,
          array_to_string(string_split(color_identity, ''), ',') AS color_identity, type_line, set_code, set_name, set_type, rarity,
          CASE WHEN p_partkey % 2 = 0 THEN 'legal' ELSE 'banned' END AS standard
        FROM c WHERE arena_id IS NOT NULL""",
    "player_metrics": GOLD + f"""
        SELECT player_id, any_value(c_name) AS display_name, count(*) AS total_matches,
          count(*) FILTER (WHERE won) AS total_wins, count(*) FILTER (WHERE lost) AS total_losses,
          {_rate('won')} AS win_rate, {RECENT}, {_ratio('sum(duration_sec)', 'count(duration_sec)')} AS avg_duration_sec, {MULLIGANS},
          any_value(most_played_deck_id) AS most_played_deck_id, any_value(most_played_deck_name) AS most_played_deck_name,
          strftime(max(start_time), '%Y-%m-%d %H:%M:%S') AS time_last_played
        FROM f JOIN mp USING (player_id) LEFT JOIN customer ON cast(c_custkey AS varchar) = player_id
        WHERE n = 1 GROUP BY player_id""",
    "win_rate_30d": GOLD + f"SELECT player_id, {RECENT} FROM f GROUP BY player_id",
    "mulligan_metrics": GOLD + f"SELECT player_id, {MULLIGANS} FROM f GROUP BY player_id",
    "most_played_deck": GOLD + "SELECT player_id, most_played_deck_id, most_played_deck_name FROM mp WHERE n = 1",
    "deck_metrics": GOLD + f""", ds AS (
          SELECT deck_id, {_ratio('sum(duration_sec)', 'count(duration_sec)')} AS avg_duration_sec, count(*) AS total_matches,
            count(*) FILTER (WHERE won) AS total_wins, {_rate('won')} AS win_rate, {MULLIGANS}
          FROM f GROUP BY deck_id)
        SELECT ds.*, deck_name, player_id, c_name AS display_name, colors, cmc_curve, cmc_avg
        FROM ds JOIN d USING (deck_id) LEFT JOIN mk USING (deck_id) LEFT JOIN cu USING (deck_id)
        LEFT JOIN customer ON cast(c_custkey AS varchar) = player_id""",
    "deck_mulligan_metrics": GOLD + f"SELECT deck_id, {MULLIGANS} FROM f GROUP BY deck_id",
    "deck_colors": GOLD + "SELECT deck_id, colors FROM mk",
    "deck_cmc_curve": GOLD + "SELECT deck_id, cmc_curve FROM mk LEFT JOIN cu USING (deck_id)",
    "deck_cmc_avg": GOLD + "SELECT deck_id, cmc_avg FROM mk",
    "card_metrics": GOLD + """
        SELECT player_id, deck_id, arena_id, p_name AS card_name, win_rate_opener, total_in_deck, draw_chance
        FROM (SELECT DISTINCT player_id, deck_id, arena_id, total_in_deck, draw_chance FROM m JOIN ch USING (deck_id))
        FULL JOIN oc USING (player_id, deck_id, arena_id) LEFT JOIN part ON p_partkey = arena_id""",
    "card_opener_winrate": GOLD + "SELECT player_id, deck_id, arena_id, win_rate_opener FROM oc",
    "card_draw_chance": GOLD + "SELECT deck_id, arena_id, total_in_deck, draw_chance FROM ch",
    "union_all_rows": MODEL + "SELECT id FROM s",
    "model_filter": MODEL + "SELECT id FROM s WHERE id IS NOT NULL",
    "model_table": MODEL + 'SELECT id, count(*) AS "rows" FROM s GROUP BY id',
    "dq_unique": """
        SELECT l_orderkey, l_linenumber, count(*) AS "rows" FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
    "dq_not_null": MODEL + "SELECT 'id' AS column_name, count(*) FILTER (WHERE id IS NULL) AS nulls FROM s",
    "dq_foreign_keys": """
        SELECT o_orderkey AS match_id, cast(o_custkey AS varchar) AS player_id FROM orders
        WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""",
}

# The same metrics, worked out whole.
ORACLE["gold_deltas"] = ORACLE["player_metrics"]
