"""Runs that stop and start again, odd file names, landed CSV, zones, and readers that must not be fooled."""

import json

import pytest
from pyspark.sql import functions as F

from duelspark.functions import payloads as P
from duelspark.functions import times as T
from duelspark.operators import bronze as B
from duelspark.operators import games as G
from duelspark.operators import messages as M
from duelspark.operators import quality as Q
from duelspark.plans import bronze as batch
from duelspark.plans import gold, silver
from duelspark.schemas import LINES
from duelspark.session import work_path
from duelspark.sources import bronze_files, logs
from duelspark.sources.store import Store

from conftest import SUMMARY, as_lines, deck_line, golden_log, rows_of


def new_store(spark, tmp_path, name):
    store = Store(spark, f"{name}_" + tmp_path.name.replace("-", "_"))
    store.create(str(tmp_path / "db"))
    return store


def other_log():
    """The same deck in another match, and a deck of its own."""
    second = [deck_line(name="Other", main=((7, 3),))] + [line.replace("m-1", "m-3") for line in golden_log()[1:]]
    return [line.replace("m-1", "m-2") for line in golden_log()] + second


@pytest.mark.parametrize("stop", ["decks", "matches", "turn1_hands"])
@pytest.mark.parametrize("dedup_by", ["content", "content_and_name"])
def test_a_stopped_load_is_mended_after_another_batch(spark, tmp_path, stop, dedup_by):
    store = new_store(spark, tmp_path, f"stop_{stop}_{dedup_by}")
    shaped = {
        name: silver.shape(B.bronze(as_lines(spark, {name: log})), dedup_by=dedup_by)
        for name, log in (("a", golden_log()), ("b", other_log()))
    }
    append = store.append

    def stopping(table, rows):
        if table == stop:
            raise RuntimeError("lost")
        append(table, rows)

    store.append = stopping
    with pytest.raises(RuntimeError):
        silver.load(store, shaped["a"])
    store.append = append
    silver.load(store, shaped["b"])
    silver.load(store, shaped["a"])

    tables = silver.read_all(store)
    matches, decks = tables["matches"], tables["decks"]
    assert sorted(r.match_key for r in matches.collect()) == ["m-1", "m-2", "m-3"]
    assert matches.select("match_id").distinct().count() == 3
    assert Q.orphans(matches, "deck_id", decks, "deck_id").isEmpty()
    assert Q.orphans(decks, "match_id", matches, "match_id").isEmpty()
    assert Q.orphans(tables["turn1_hands"], "match_id", matches, "match_id").isEmpty()
    own = decks.join(matches.select("match_id", F.col("deck_id").alias("used")), "match_id")
    assert own.filter("deck_id <> used").isEmpty() and own.count() == 2
    assert tables["turn1_hands"].select("match_id").distinct().count() == 3


def test_decks_by_name_or_content(spark, tmp_path):
    renamed = [deck_line(name="Mine")] + [line.replace("m-1", "m-2") for line in golden_log()[1:]]
    bronze = B.bronze(as_lines(spark, {"a": golden_log(), "b": renamed}))
    for dedup_by, count in (("content", 1), ("content_and_name", 2)):
        store = new_store(spark, tmp_path / dedup_by, f"by_{dedup_by}_{tmp_path.name.replace('-', '_')}")
        silver.load(store, silver.shape(bronze, dedup_by=dedup_by))
        assert dict(rows_of(silver.row_totals(store)))["decks"] == count


def test_a_deck_named_like_the_note_stays(spark):
    for name in ("Message summarized because", SUMMARY, "x " + SUMMARY):
        log = [deck_line(name=name)] + golden_log()[1:]
        bronze = B.bronze(as_lines(spark, {"a": log}))
        games = G.complete(G.describe(M.first_last(bronze)))
        assert rows_of(games, "deck_name") == [(name,)]
        assert M.explode_messages(bronze).filter("event = 'deck_list'").count() == 1
    note = spark.createDataFrame([(SUMMARY,), (json.dumps(SUMMARY),), ("see " + SUMMARY,)], "p string")
    assert [r[0] for r in note.select(P.is_summarized(F.col("p"))).collect()] == [True, True, False]


def test_an_unreadable_deck_is_blank(spark):
    broken = deck_line().replace(r"\"quantity\": 1", r"\"other\": 1")
    assert broken != deck_line()
    games = G.complete(G.describe(M.first_last(B.bronze(as_lines(spark, {"a": [broken] + golden_log()[1:]})))))
    assert rows_of(games, "deck_name", "deck_list", "deck_commander") == [("Blank", [], "")]


@pytest.mark.parametrize(
    "text, whole",
    [
        ('{"a":1}', True), ("[1]", True), ("{}", True), ('{"a":1} junk}', False), ('{"a":1}{"b":2}', False), ("[1] x]", False),
        ("[1],[2", False), ('{"a":1}, {"b":2', False), ("{", False), ("", False), ('{"a":"}"}', True), ("scene 1 loaded", False),
        ("12", True), ('"a"', True), ('1,"e":1}', False),
    ],
)
def test_whole_text_json(spark, text, whole):
    assert spark.range(1).select(P.is_json(F.lit(text))).first()[0] is whole
    if not whole and text:
        kept = spark.range(1).select(P.project(F.lit(P.GAME_EVENT), F.lit(text))).first()[0]
        assert json.loads(kept) == text


def test_parts_of_a_log_keep_their_order(spark):
    log = golden_log()
    raw = [(f"/l/part-0000{p}-x-c00{c}.txt", f"part-0000{p}-x-c00{c}.txt", s, line)
           for (p, c, s), lines in (((0, 0, 1 << 36), log[5:9]), ((0, 0, 0), log[:5]), ((0, 1, 0), log[9:12]), ((1, 0, 0), log[12:]))
           for line in lines]
    read = spark.createDataFrame(raw, "path string, file string, start bigint, value string").coalesce(1)
    parsed = B.bronze(logs.order_lines(read, rolled=True))
    want = B.bronze(as_lines(spark, {"/l": log}))
    columns = ["game_num", "row_ord", "player_id", "timestamp", "event", "payload"]
    assert sorted(rows_of(parsed, *columns)) == sorted(rows_of(want, *columns))


def write_log(folder, name, lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def test_incremental_runs(spark, tmp_path, monkeypatch):
    source, target = tmp_path / "raw", batch.store(spark, "runs_" + tmp_path.name.replace("-", "_"))
    target.create(str(tmp_path / "db"))
    write_log(source, "a b.log", golden_log())
    write_log(source, "empty.log", ["nothing"])
    assert batch.run(target, str(source)) == 2 and batch.run(target, str(source)) == 0
    status = {s.rsplit("/", 1)[1]: (st, n) for s, st, n in rows_of(target.read("manifest"), "source_file", "status", "rows")}
    assert status["empty.log"] == ("no_games", 0) and status["a%20b.log"][0] == "parsed"
    rows = target.read("bronze").count()

    write_log(source / "later", "c.log", other_log())
    append = target.append
    monkeypatch.setattr(target, "append", lambda table, df: 1 / 0 if table == "manifest" else append(table, df))
    with pytest.raises(ZeroDivisionError):
        batch.run(target, str(source))
    monkeypatch.undo()
    assert batch.run(target, str(source)) == 1
    assert target.read("bronze").count() == 3 * rows
    assert target.read("bronze").groupBy("source_file", "row_ord").count().filter("count > 1").isEmpty()
    assert target.read("manifest").count() == 3


def test_a_run_reads_the_text_once(spark, tmp_path):
    source, target = tmp_path / "raw", batch.store(spark, "once_" + tmp_path.name.replace("-", "_"))
    target.create(str(tmp_path / "db"))
    write_log(source, "a.log", golden_log())
    reads = []
    read_logs, logs.read_logs = logs.read_logs, lambda *a, **k: reads.append(1) or read_logs(*a, **k)
    try:
        batch.run(target, str(source))
    finally:
        logs.read_logs = read_logs
    assert len(reads) == 1


def test_landed_csv(spark, tmp_path):
    bronze = B.bronze(as_lines(spark, {"/logs/a b.log": golden_log() * 40, "/logs/c.log": other_log()}, block=7))
    path = str(tmp_path / "landing")
    bronze_files.write_landing(bronze, path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        back = bronze_files.read_landing(spark, path, rolled=True)
        assert rows_of(back.agg(F.count_distinct("source_file")))[0] == (2,)
        key = lambda df: sorted(rows_of(df.select(F.element_at(F.split("source_file", r"[/=]"), -1), "row_ord", *bronze_files.LANDING)))
        got = key(back)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = {}
    for source, _, *rest in sorted(rows_of(bronze.select("source_file", "row_ord", *bronze_files.LANDING))):
        want.setdefault("a%20b" if "a b" in source else "c", []).append(rest)
    assert got == sorted((s, n, *rest) for s, rows in want.items() for n, rest in enumerate(rows, 1))


def test_landed_csv_of_other_writers(spark, tmp_path):
    text = 'game_num,player_id,timestamp,event,payload\r\n1,P,1/2/2026 1:00:00 PM,Q,"{""a"": ""b, \\""c\\""""}"\r\n'
    (tmp_path / "Filtered_x.csv").write_text(text)
    row = bronze_files.read_landing(spark, str(tmp_path)).first()
    assert (row.game_num, row.player_id, row.event, row.row_ord) == (1, "P", "Q", 1)
    assert json.loads(row.payload) == {"a": 'b, "c"'} and row.source_file.endswith("Filtered_x.csv")
    (tmp_path / "Filtered_x.csv").write_text(text.replace("game_num,player_id", "player_id,game_num"))
    with pytest.raises(Exception, match="(?i)header"):
        bronze_files.read_landing(spark, str(tmp_path)).collect()


def test_instants_do_not_depend_on_the_session(spark):
    texts = ["1/2/2026 1:00:00 PM", "3/8/2026 1:59:00 AM", "3/8/2026 2:30:00 AM", "3/8/2026 3:01:00 AM", "11/1/2026 1:30:00 AM", "x"]
    seen, before = set(), spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            df = spark.createDataFrame([(t,) for t in texts], "t string")
            local = T.wall_clock(F.col("t"))
            seen.add(tuple(r[0] for r in df.select(F.unix_timestamp(T.instant(local))).collect()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert len(seen) == 1
    assert next(iter(seen))[0] == 1767376800 and next(iter(seen))[-1] is None


def test_gold_reads_matches_and_hands_few_times(spark, tmp_path):
    store = new_store(spark, tmp_path, "gold")
    silver.load(store, silver.shape(B.bronze(as_lines(spark, {"a": golden_log()}))))
    built = gold.build(silver.read_all(store))
    for name in ("player_metrics", "deck_metrics"):
        plan = built[name]._jdf.queryExecution().optimizedPlan().toString()
        assert "turn1_hands" not in plan, name
    gold.reload(store, silver.read_all(store))
    assert store.read("player_metrics").count() > 0


def test_block_schema_is_ordered(spark):
    assert spark.createDataFrame([], LINES).orderBy("block").count() == 0
    assert work_path(spark, "a") != work_path(spark, "a")
