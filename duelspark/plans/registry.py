"""Every operator as a query over the driver's tables.

Results that the oracle compares hold plain values only: arrays are joined to
text, rates are doubles of nine places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duelspark import schemas
from duelspark.functions import cards as C
from duelspark.functions import lines as L
from duelspark.functions import payloads as P
from duelspark.functions import times as T
from duelspark.operators import bronze as B
from duelspark.operators import decks as D
from duelspark.operators import dims
from duelspark.operators import games as G
from duelspark.operators import gold as X
from duelspark.operators import hands as H
from duelspark.operators import messages as M
from duelspark.operators import quality as Q
from duelspark.operators.keys import assign_ids
from duelspark.plans import bronze as batch
from duelspark.plans import gold, silver
from duelspark.plans import standins as S
from duelspark.schemas import DAYS, SILVER
from duelspark.session import stage, work_path, writers
from duelspark.sources import bronze_files, card_bulk, logs
from duelspark.sources.store import Store, laid_out
from duelspark.streaming import ingest

QUERIES: dict = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def joined(array: str | Column) -> Column:
    column = F.col(array) if isinstance(array, str) else array
    return F.array_join(column.cast("array<string>"), ",")


def rounded(name: str) -> Column:
    """A rate at its nine places."""
    return F.col(name).cast("decimal(38,9)").cast("double").alias(name)


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return S.event_log(S.table(spark, folder, "events"))


def _bronze(spark: SparkSession, folder: str) -> DataFrame:
    return B.bronze(_lines(spark, folder))


def _messages(spark: SparkSession, folder: str) -> DataFrame:
    return M.explode_messages(_bronze(spark, folder))


def _games(spark: SparkSession, folder: str) -> DataFrame:
    return G.describe(M.first_last(_bronze(spark, folder)))


def _event_id() -> Column:
    return F.floor(F.col("pos") / 2).cast("bigint").alias("event_id")


def _user(source: str | Column = "source_file") -> Column:
    return F.regexp_extract(source, r"user-(\d+)", 1).cast("bigint").alias("user_id")


def bronze_facts(bronze: DataFrame) -> DataFrame:
    """Bronze rows with one telling value per payload instead of its text."""
    at = lambda path: F.get_json_object("payload", path)
    return bronze.select(
        _user(),
        "game_num",
        "player_id",
        "timestamp",
        "event",
        F.when(F.col("event") == P.DECK_EVENT, at("$[0].id"))
        .when(F.col("event") == P.ROOM_EVENT, at("$[0].gameRoomConfig.matchId"))
        .when(F.col("payload").startswith('"'), at("$"))
        .when(F.col("event") == P.GAME_EVENT, at("$[0].gameStateMessage.gameObjects[0].grpId"))
        .otherwise(at("$.transactionId"))
        .alias("fact"),
    )


def _written_logs(spark: SparkSession, folder: str) -> str:
    path = work_path(spark, "logs")
    logs.write_logs(_lines(spark, folder).withColumnRenamed("source_file", "log"), path)
    return path


# --- scans and sinks ---------------------------------------------------------


@query
def log_scan(spark, folder):
    """Logs written as text files, read back in order and parsed."""
    lines = logs.read_logs(spark, _written_logs(spark, folder), "*.txt", rolled=True)
    return bronze_facts(B.bronze(lines))


@query
def bronze_roundtrip(spark, folder):
    path = work_path(spark, "bronze-csv")
    bronze_files.write_bronze(_bronze(spark, folder), path, "csv")
    return bronze_facts(bronze_files.read_bronze(spark, path, "csv"))


@query
def landing_csv(spark, folder):
    """Events landed as five-column CSV and read back; rows whose payload text came back otherwise would stand here twice."""
    path = work_path(spark, "landing")
    bronze = stage(_bronze(spark, folder), "bronze")
    bronze_files.write_landing(bronze, path)
    back = stage(bronze_files.read_landing(spark, path, rolled=True), "landed")
    rows = lambda df: df.select(_user(), *bronze_files.LANDING)
    lost = rows(bronze).exceptAll(rows(back)).withColumn("source_file", F.format_string("user-%d", "user_id"))
    return bronze_facts(back).unionByName(bronze_facts(lost))


@query
def incremental_batch(spark, folder):
    """Logs of every second user parsed first, then the others as new files, then a run without new files."""
    path = work_path(spark, "logs")
    lines = _lines(spark, folder).withColumnRenamed("source_file", "log")
    even = F.regexp_extract("log", r"(\d+)$", 1).cast("bigint") % 2 == 0
    target = batch.store(spark, "db_" + work_path(spark, "x")[-12:])
    target.create(work_path(spark, "bronze"))
    for half, some in (("first", lines.filter(even)), ("second", lines.filter(~even))):
        logs.write_logs(some, f"{path}/{half}")
        batch.run(target, path, "*.txt", rolled=True)
    batch.run(target, path, "*.txt", rolled=True)
    stored = target.read("bronze").groupBy("source_file").agg(F.count("*").alias("stored"))
    return target.read("manifest").join(stored, "source_file", "left").select(
        _user(), "games", "rows", "status", F.coalesce("stored", F.lit(0)).cast("bigint").alias("stored")
    )


def _in_two(spark: SparkSession, folder: str, path: str):
    """The logs of all users in two portions of parts, cut in the middle: between the two lines of a record where that is one.

    Gives a function that writes a portion below ``path``.
    """
    # Stored, as all that follows goes over them again.
    lines = stage(_lines(spark, folder).select(F.col("source_file").alias("log"), "pos", "line"), "whole-logs")
    event = F.floor(F.col("pos") / 2)
    middle = lines.groupBy("log").agg(((F.min(event) + F.max(event)) / 2).alias("middle"))
    cuts = lines.join(middle, "log").filter(event <= F.col("middle")).groupBy("log").agg((F.max(event) * 2).alias("cut"))
    parts, most = 4, lines.agg(F.max("pos")).first()[0] or 0
    cut = stage(lines.join(cuts, "log").withColumn("second", F.col("pos") > F.col("cut")), "cut-logs")
    groups = max(1, writers(spark) // parts)

    def write(second: bool) -> None:
        # Part numbers follow the order of the lines, and those of the second portion the first.
        part = F.least(F.lit(parts - 1), F.floor(F.col("pos") * parts / F.lit(most + 1))).cast("int") + (parts if second else 0)
        # Each part is written by many tasks, a group of logs each.
        task = (part * groups + F.pmod(F.xxhash64("log"), F.lit(groups))).cast("int")
        some = cut.filter(F.col("second") == second).repartitionById(2 * parts * groups, task).sortWithinPartitions("log", "pos")
        logs.write_parts(some, path)

    return write


@query
def grown_logs(spark, folder):
    """All logs parsed in two runs, as they had grown in between; a run without news adds nothing."""
    path = work_path(spark, "logs")
    write = _in_two(spark, folder, path)
    target = batch.store(spark, "db_" + work_path(spark, "x")[-12:])
    target.create(work_path(spark, "bronze"))
    for second in (False, True):
        write(second)
        batch.run(target, path, "*.txt", rolled=True)
    batch.run(target, path, "*.txt", rolled=True)
    return bronze_facts(target.read("bronze"))


@query
def grown_manifest(spark, folder):
    """Games, rows and quarantined lines of logs that have grown, over both runs."""
    path = work_path(spark, "logs")
    write = _in_two(spark, folder, path)
    target = batch.store(spark, "db_" + work_path(spark, "x")[-12:])
    target.create(work_path(spark, "bronze"))
    for second in (False, True):
        write(second)
        batch.run(target, path, "*.txt", rolled=True)
    bad = batch.quarantine(target).groupBy("source_file").agg(F.count("*").alias("bad"))
    return batch.manifest(target).join(bad, "source_file", "left").select(
        _user(), "games", "rows", "status", F.coalesce("bad", F.lit(0)).cast("bigint").alias("bad")
    )


@query
def stream_parts(spark, folder):
    """Logs whose parts come one after the other in batches of a stream, with state between them."""
    path, out, checkpoint = (work_path(spark, name) for name in ("logs", "stream-bronze", "stream-state"))
    write = _in_two(spark, folder, path)
    for second in (False, True):
        write(second)
        raw = ingest.stream_logs(spark, path, "*.txt")
        ingest.run(raw, checkpoint, ingest.bronze_to(out, f"{checkpoint}-logs"), rolled=True)
    return bronze_facts(bronze_files.read_bronze(spark, out))


@query
def new_files(spark, folder):
    """Logs of users who came later, as those of the first six hours are in the manifest already."""
    files = logs.list_files(spark, _written_logs(spark, folder), "*.txt").withColumn("user_id", _user())
    early = S.table(spark, folder, "events").filter("ts < '2024-01-01 06:00:00'").select("user_id").distinct()
    done = files.join(early, "user_id", "left_semi").select("source_file")
    return logs.unprocessed(files, done).select("user_id").distinct()


@query
def file_manifest(spark, folder):
    events = S.table(spark, folder, "events")
    return B.file_manifest(S.users(events), S.event_log(events)).select(_user(), "games", "rows", "status")


@query
def silver_append(spark, folder):
    """Row counts after the same logs are loaded twice."""
    store = Store(spark, "db_" + work_path(spark, "x")[-12:])
    store.create(work_path(spark, "silver"))
    shaped = silver.shape(stage(_bronze(spark, folder), "bronze"))
    for _ in range(2):
        silver.load(store, shaped)
    return silver.row_totals(store).filter("table_name <> 'dim_cards'")


@query
def schema_check(spark, folder):
    """NULLs per column of the stored form of matches; required ones fail the job."""
    spec = schemas.SILVER["matches"]
    rows = Q.require(Q.conform(S.matches(S.table(spark, folder, "orders")), spec), spec)
    return Q.null_counts(rows, spec.columns)


@query
def table_layout(spark, folder):
    """Matches written in clustered form and read back, per player."""
    path = work_path(spark, "layout")
    laid_out(S.matches(S.table(spark, folder, "orders")), schemas.SILVER["matches"]).write.parquet(path)
    return spark.read.parquet(path).groupBy("player_id").agg(F.count("*").alias("rows"))


@query
def table_counts(spark, folder):
    t = lambda name: S.table(spark, folder, name)
    return Q.counts(
        {
            "players": S.players(t("customer")),
            "matches": S.matches(t("orders")),
            "decks": S.decks(t("orders")),
            "turn1_hands": S.hands(t("lineitem")),
            "dim_cards": S.dim_cards(t("part")),
        }
    )


@query
def stream_ingest(spark, folder):
    """Logs taken in as a stream of files, then read as a table."""
    out, checkpoint = work_path(spark, "stream-bronze"), work_path(spark, "stream-state")
    raw = ingest.stream_logs(spark, _written_logs(spark, folder), "*.txt")
    ingest.run(raw, checkpoint, ingest.bronze_to(out), rolled=True)
    return bronze_facts(bronze_files.read_bronze(spark, out))


# --- bronze -------------------------------------------------------------------


@query
def log_markers(spark, folder):
    return B.markers(_lines(spark, folder)).select(_user(), _event_id(), "kind")


@query
def log_filter(spark, folder):
    return B.wanted(_lines(spark, folder)).select(_user(), _event_id())


@query
def log_header(spark, folder):
    return B.headers(_lines(spark, folder)).select(
        _user(), _event_id(), "timestamp", "player_id", "event", F.col("payload").isNotNull().alias("inline")
    )


@query
def game_sessionize(spark, folder):
    return (
        B.in_game(_lines(spark, folder))
        .filter(F.col("kind").isin(L.INLINE, L.HEAD, L.BAD))
        .select(_user(), _event_id(), "game_num")
    )


@query
def deck_carry(spark, folder):
    return bronze_facts(_bronze(spark, folder).filter(F.col("event") == P.DECK_EVENT))


@query
def payload_project(spark, folder):
    return bronze_facts(_bronze(spark, folder).filter(F.col("event") != P.DECK_EVENT))


@query
def quarantine(spark, folder):
    return B.quarantine(_lines(spark, folder)).select(_user(), "game_num", "reason")


@query
def incomplete_games(spark, folder):
    bronze = stage(_bronze(spark, folder), "bronze")
    games = G.describe(M.first_last(bronze))
    return G.incomplete(bronze, games).select(_user(), "game_num", "player_id")


# --- messages -----------------------------------------------------------------


@query
def payload_explode(spark, folder):
    return _messages(spark, folder).select(
        _user(), "game_num", "timestamp", "event", "msg_pos",
        F.get_json_object("message", "$.type").alias("type"),
    )


@query
def game_first_last(spark, folder):
    return M.first_last(_bronze(spark, folder)).select(
        _user(), "game_num", "player_id", "first_time", "last_time", "rows",
        F.get_json_object("first_message", "$.id").alias("deck_event"),
        F.get_json_object("last_message", "$.gameRoomConfig.matchId").alias("room"),
    )


# --- players, matches, decks ----------------------------------------------------


@query
def players(spark, folder):
    return G.players(_games(spark, folder))


@query
def players_upsert(spark, folder):
    """Players not stored yet, where the customers of two segments are stored."""
    customers = S.table(spark, folder, "customer").filter("c_mktsegment IN ('MACHINERY', 'FURNITURE')")
    stored = S.players(customers).select(
        F.concat(F.lit("P"), "player_id").alias("player_id")
    )
    return G.absent(G.players(_games(spark, folder)), stored, ["player_id"])


@query
def match_times(spark, folder):
    """Event times printed as log text, read back, and moved to UTC."""
    text = F.date_format("ts", T.LOG_TIME)
    local = T.wall_clock(F.col("text"))
    return S.table(spark, folder, "events").select("event_id", text.alias("text")).select(
        "event_id",
        F.date_format(local, "yyyy-MM-dd HH:mm:ss").alias("local_time"),
        F.date_format(T.instant(local), "yyyy-MM-dd HH:mm:ss").alias("utc_time"),
        F.unix_timestamp(T.instant(local)).alias("epoch"),
        T.seconds_between(F.lit("2024-01-01").cast("timestamp"), local).alias("seconds"),
    )


@query
def match_format(spark, folder):
    return _games(spark, folder).select(_user(), "game_num", "game_format")


@query
def matches(spark, folder):
    games = stage(_games(spark, folder), "games")
    decks = D.by_content(G.complete(games)).select(*D.CONTENT, F.col("match_key").alias("deck_match"))
    return G.matches(games).join(decks, D.CONTENT).select(
        "match_key", _user(), "game_num", "player_id", "player_seat", "winner_seat", "game_format",
        "duration_sec", F.date_format("start_time", "yyyy-MM-dd HH:mm:ss").alias("start_time"), "deck_match",
    )


def _deck_columns() -> list:
    return [
        "deck_name", "player_id", "match_key", joined("deck_list").alias("deck_list"),
        joined("deck_sideboard").alias("deck_sideboard"), "deck_commander", "deck_hash", "side_hash",
    ]


@query
def decks(spark, folder):
    return G.complete(_games(spark, folder)).select(_user(), "game_num", *_deck_columns())


@query
def decks_dedup(spark, folder):
    return D.by_content(G.complete(_games(spark, folder))).select(*_deck_columns())


@query
def decks_dedup_named(spark, folder):
    return D.by_name_and_content(G.complete(_games(spark, folder))).select(*_deck_columns())


@query
def deck_flatten(spark, folder):
    return S.deck_counts(S.table(spark, folder, "lineitem")).select(
        "match_id", "line", joined(C.flat_deck(F.col("main"))).alias("deck_list")
    )


@query
def deck_hash(spark, folder):
    return S.deck_counts(S.table(spark, folder, "lineitem")).select(
        "match_id", "line",
        C.id_list_hash(C.flat_deck(F.col("main"))).alias("deck_hash"),
        C.count_list_hash(F.col("side")).alias("side_hash"),
    )


@query
def surrogate_keys(spark, folder):
    orders = S.table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return assign_ids(orders, ["o_custkey", "o_orderkey"], "match_id", 1000)


# --- hands ----------------------------------------------------------------------


def _opening(spark, folder) -> DataFrame:
    return H.opening(stage(H.candidates(_messages(spark, folder)), "candidates"))


def _message_time(columns: list) -> list:
    return [_user(), "game_num", *columns]


@query
def hand_messages(spark, folder):
    return _opening(spark, folder).select(
        *_message_time(["msg_pos", "unfinished"]),
        joined(P.first_where(F.col("zones"), lambda z: z["type"] == H.HAND_ZONE)["objectInstanceIds"]).alias("ids"),
    )


@query
def instance_map(spark, folder):
    return H.instance_map(_opening(spark, folder)).select(*_message_time(["instance_id", "arena_id"]))


@query
def hand_zones(spark, folder):
    return H.zones(_opening(spark, folder)).select(
        *_message_time(["msg_pos", "mulligan1", "mulligan2"]), *[joined(f"zone{n}").alias(f"zone{n}") for n in (1, 2, 3)]
    )


@query
def hand_cards(spark, folder):
    opening = _opening(spark, folder)
    return H.cards(H.zones(opening), H.instance_map(opening)).select(
        *_message_time(["msg_pos"]), *[joined(f"cards{n}").alias(f"cards{n}") for n in (1, 2, 3)]
    )


@query
def mulligan_fill(spark, folder):
    opening = _opening(spark, folder)
    return H.fill_mulligans(H.cards(H.zones(opening), H.instance_map(opening))).select(
        *_message_time(["msg_pos", "mulliganCount"])
    )


def _hand_columns() -> list:
    return _message_time(
        ["msg_pos", "player_id", joined("initial_hand").alias("initial_hand"), "mulliganCount",
         joined("discarded").alias("discarded"), "went_first"]
    )


@query
def turn1_hands(spark, folder):
    return H.turn1_hands(_opening(spark, folder)).select(*_hand_columns())


@query
def hands_collapsed(spark, folder):
    return H.turn1_hands(_opening(spark, folder), collapse=True).select(*_hand_columns())


# --- card dimension ----------------------------------------------------------------


def _bulk(spark, folder) -> DataFrame:
    """Parts written as card objects, one per line, and read by the card reader."""
    path = work_path(spark, "cards")
    S.bulk_cards(S.table(spark, folder, "part")).write.json(path)
    return card_bulk.read_cards(spark, path, lines=True)


_CARD_COLUMNS = [
    "arena_id", "oracle_id", "card_name", "scryfall_uri", "mana_cost", "cmc", "colors", "color_identity",
    "type_line", "set_code", "set_name", "set_type", "rarity",
]


@query
def dim_cards(spark, folder):
    return dims.dim_cards(_bulk(spark, folder)).select(*_CARD_COLUMNS)


@query
def card_array(spark, folder):
    """Parts written as JSON arrays of up to a thousand cards and read by splits."""
    path = work_path(spark, "card-arrays")
    cards = S.bulk_cards(S.table(spark, folder, "part"))
    objects = cards.select(F.floor(F.col("ord") / 1000).alias("part"), F.to_json(F.struct(*[c for c in cards.columns if c != "ord"])).alias("text"))
    arrays = objects.groupBy("part").agg(F.array_join(F.collect_list("text"), ",\n").alias("value"))
    arrays.select("part", F.concat(F.lit("["), "value", F.lit("]")).alias("value")).write.partitionBy("part").text(path)
    return dims.dim_cards(card_bulk.read_array(spark, path)).select(*_CARD_COLUMNS)


@query
def dim_cards_dedup(spark, folder):
    cards = S.bulk_cards(S.table(spark, folder, "part"))
    return dims.dim_cards(dims.first_per_id(dims.on_client(cards), ["ord"])).select(*_CARD_COLUMNS)


@query
def card_colors(spark, folder):
    return S.bulk_cards(S.table(spark, folder, "part")).select(
        "oracle_id", C.join_colors(F.col("colors")).alias("colors"),
        C.join_colors(F.col("color_identity")).alias("color_identity"),
    )


@query
def local_cards(spark, folder):
    path = work_path(spark, "local-cards")
    card_bulk.write_cards(dims.local_cards(S.bulk_cards(S.table(spark, folder, "part"))), path)
    return spark.read.parquet(path).select(
        "arena_id", "oracle_id", "name", F.date_format("released_at", "yyyy-MM-dd").alias("released_at"),
        "scryfall_uri", "mana_cost", "cmc", joined("colors").alias("colors"), joined("color_identity").alias("color_identity"),
        "type_line", F.col("set").alias("set_code"), "set_name", "set_type", "rarity",
        F.col("legalities")["standard"].alias("standard"),
    )


# --- gold ------------------------------------------------------------------------------


class _Gold:
    """Stand-in silver relations and the measures shared by the metrics."""

    def __init__(self, spark, folder):
        t = lambda name: S.table(spark, folder, name)
        self.players = S.players(t("customer"))
        self.matches = S.matches(t("orders"))
        self.decks = S.decks(t("orders"))
        self.hands = S.hands(t("lineitem"))
        self.dim = S.dim_cards(t("part"))
        self.lineitem = t("lineitem")

    @property
    def stats(self) -> DataFrame:
        return X.player_deck_stats(self.matches, self.hands)

    @property
    def results(self) -> DataFrame:
        return X.player_deck_stats(self.matches)

    @property
    def cards(self) -> DataFrame:
        return S.deck_cards(self.matches, self.lineitem)

    def players_rows(self, stats: DataFrame) -> DataFrame:
        return X.player_metrics(stats, self.players, self.decks)


_MULLIGANS = ["avg_mulligans", "mulligan0_win_rate", "mulligan1_win_rate", "mulligan2_win_rate"]


@query
def player_metrics(spark, folder):
    g = _Gold(spark, folder)
    return _player_rows(g.players_rows(g.stats))


def _player_rows(rows: DataFrame) -> DataFrame:
    return rows.select(
        "player_id", "display_name", "total_matches", "total_wins", "total_losses", rounded("win_rate"),
        rounded("win_rate_30d"), rounded("avg_duration_sec"), *[rounded(c) for c in _MULLIGANS],
        "most_played_deck_id", "most_played_deck_name",
        F.date_format("time_last_played", "yyyy-MM-dd HH:mm:ss").alias("time_last_played"),
    )


@query
def gold_deltas(spark, folder):
    """Player metrics from sums per day that three batches of matches and hands, and a run without news, have added to."""
    g = _Gold(spark, folder)
    target = Store(spark, "db_" + work_path(spark, "x")[-12:], {t: s for t, s in {**SILVER, **DAYS}.items() if t in ("matches", "turn1_hands", *DAYS)})
    target.create(work_path(spark, "gold-deltas"))
    none = lambda kind: F.lit(None).cast(kind)
    hands = g.hands.join(g.matches.select("match_id", "player_id"), "match_id").withColumns({
        "hand_id": F.col("match_id") * 100 + F.floor(F.col("hand_id") / 1_000_000_000_000),
        "discarded": none("array<bigint>"), "went_first": none("boolean"),
    })
    upto = (g.matches.agg(F.max("match_id")).first()[0] or 0) + 1
    for n in range(3):
        part = (F.col("match_id") >= n * upto // 3) & (F.col("match_id") < (n + 1) * upto // 3)
        target.append("matches", g.matches.filter(part))
        target.append("turn1_hands", hands.filter(part))
        gold.update_days(target)
    gold.update_days(target)
    return _player_rows(g.players_rows(X.stats_of_days(gold.kept_days(target), target.read("matches"))))


@query
def win_rate_30d(spark, folder):
    g = _Gold(spark, folder)
    return g.players_rows(g.results).select("player_id", rounded("win_rate_30d"))


@query
def mulligan_metrics(spark, folder):
    g = _Gold(spark, folder)
    return g.players_rows(g.stats).select("player_id", *[rounded(c) for c in _MULLIGANS])


@query
def most_played_deck(spark, folder):
    g = _Gold(spark, folder)
    return g.players_rows(g.results).select("player_id", "most_played_deck_id", "most_played_deck_name")


@query
def deck_metrics(spark, folder):
    g = _Gold(spark, folder)
    return X.deck_metrics(g.stats, g.decks, g.players, g.cards, g.dim).select(
        "deck_id", "deck_name", "player_id", "display_name", rounded("avg_duration_sec"), "total_matches",
        "total_wins", rounded("win_rate"), *[rounded(c) for c in _MULLIGANS], "colors",
        joined("cmc_curve").alias("cmc_curve"), rounded("cmc_avg"),
    )


@query
def deck_mulligan_metrics(spark, folder):
    return X.deck_results(_Gold(spark, folder).stats).select("deck_id", *[rounded(c) for c in _MULLIGANS])


def _makeup(spark, folder) -> DataFrame:
    g = _Gold(spark, folder)
    return X.deck_makeup(X.card_facts(g.cards, g.dim))


@query
def deck_colors(spark, folder):
    return _makeup(spark, folder).select("deck_id", "colors")


@query
def deck_cmc_curve(spark, folder):
    return _makeup(spark, folder).select("deck_id", joined("cmc_curve").alias("cmc_curve"))


@query
def deck_cmc_avg(spark, folder):
    return _makeup(spark, folder).select("deck_id", rounded("cmc_avg"))


@query
def card_metrics(spark, folder):
    g = _Gold(spark, folder)
    return X.card_metrics(g.results, g.matches, X.opener_cards(g.hands), g.cards, g.dim).select(
        "player_id", "deck_id", "arena_id", "card_name", rounded("win_rate_opener"), "total_in_deck",
        rounded("draw_chance"),
    )


@query
def card_opener_winrate(spark, folder):
    g = _Gold(spark, folder)
    return X.opener_win_rate(X.opener_cards(g.hands), g.matches).select(
        "player_id", "deck_id", "arena_id", rounded("win_rate_opener")
    )


@query
def card_draw_chance(spark, folder):
    return X.draw_chance(_Gold(spark, folder).cards).select(
        "deck_id", "arena_id", "total_in_deck", rounded("draw_chance")
    )


# --- models and column tests ----------------------------------------------------------------


def _model(spark, folder) -> DataFrame:
    """All orders: the keys of all but one status, and a NULL for each order of that one."""
    orders = S.table(spark, folder, "orders")
    return (
        orders.filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("id"))
        .unionAll(orders.filter("o_orderstatus = 'P'").select(F.lit(None).cast("bigint").alias("id")))
    )


@query
def union_all_rows(spark, folder):
    return _model(spark, folder)


@query
def model_filter(spark, folder):
    """A model that reads another model through a view."""
    _model(spark, folder).createOrReplaceTempView("duelspark_model")
    return spark.sql("SELECT * FROM duelspark_model WHERE id IS NOT NULL")


@query
def model_table(spark, folder):
    """A model kept as a table."""
    name = "duelspark_model_" + work_path(spark, "x")[-12:]
    _model(spark, folder).write.option("path", work_path(spark, "model")).saveAsTable(name)
    return spark.table(name).groupBy("id").agg(F.count("*").alias("rows"))


@query
def dq_unique(spark, folder):
    return Q.repeated(S.table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def dq_not_null(spark, folder):
    return Q.null_counts(_model(spark, folder), ["id"])


@query
def dq_foreign_keys(spark, folder):
    """Matches without hands."""
    g = _Gold(spark, folder)
    return Q.orphans(g.matches, "match_id", g.hands, "match_id").select("match_id", "player_id")
