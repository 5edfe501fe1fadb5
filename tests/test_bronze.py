import json
import random

from conftest import END, P, START_A, START_B, SUMMARY, as_lines, deck_line, gre, header, room, rows_of

from duelspark.functions import lines as L
from duelspark.functions import payloads
from duelspark.operators import bronze as B
from duelspark.sources import bronze_files, logs


def state_machine(lines):
    """The rules in plain Python, one line at a time: (game, player, time, event, payload)."""
    recording, game, deck, waiting, out = False, 0, None, None, []
    for line in (text.strip() for text in lines):
        held, waiting = waiting, None
        if held and not line.startswith(P) and L.DECK_CALL not in line:
            out.append((*held, line))
            continue
        if L.DECK_CALL in line:
            deck = line[line.find("{"):]
        elif line in (START_A, START_B):
            recording, game = True, game + 1
        elif line.startswith(END):
            recording = False
        elif recording and line.startswith(P) and not any(word in line for word in L.UNWANTED):
            brace = line.find("{")
            meta = line[len(P):brace] if brace >= 0 else line[len(P):]
            parts = meta.split(": ")
            if len(parts) < 3:
                continue
            words = parts[1].split(" ")
            player = words[2] if len(words) == 3 else parts[1]
            if deck is not None:
                out.append((game, player, parts[0], "deck_list", "[" + deck + "]"))
                deck = None
            if brace >= 0:
                out.append((game, player, parts[0], parts[2], line[brace:]))
            else:
                waiting = (game, player, parts[0], parts[2])
    return [(g, p, t, e, projected(e, raw)) for g, p, t, e, raw in out]


def projected(event, raw):
    if event == "deck_list":
        return json.loads(raw)
    try:
        value = json.loads(raw)
    except json.JSONDecodeError:
        return raw
    if event == payloads.GAME_EVENT:
        return value["greToClientEvent"]["greToClientMessages"]
    if event == payloads.ROOM_EVENT:
        return [value["matchGameRoomStateChangedEvent"]["gameRoomInfo"]]
    return value


def random_log(rng):
    lines = []
    for n in range(rng.randint(0, 40)):
        kind = rng.choice("SSEEDDHHHHIIRXUTQ")
        stamp = f"1/{n % 28 + 1}/2026 {n % 12 + 1}:00:00 PM"
        who = rng.choice(["A", "B"])
        if kind == "S":
            lines.append(rng.choice([START_A, START_B]))
        elif kind == "E":
            lines.append(END)
        elif kind == "D":
            lines.append(deck_line(name=f"d{n}"))
        elif kind == "H":
            lines += [header(stamp, who, "GreToClientEvent"), rng.choice([gre({"n": n}), SUMMARY, "   " + gre({"n": n})])]
        elif kind == "I":
            lines.append(header(stamp, who, "Queue") + json.dumps({"n": n, "t": 'q"\\,'}))
        elif kind == "R":
            lines += [header(stamp, who, "MatchGameRoomStateChangedEvent"), room(f"m{n}")]
        elif kind == "X":
            lines.append(P + 'STATE CHANGED {"old":"Playing","new":"Other"}')
        elif kind == "U":
            lines.append(header(stamp, who, "ClientToGremessage") + "{}")
        elif kind == "Q":
            lines.append(header(stamp, who, "GreToClientEvent"))
        else:
            lines.append(rng.choice(["noise", "", "  [Other] x", '{"a": 1}']))
    return lines


def bronze_by_source(df):
    found = {}
    for r in df.orderBy("source_file", "row_ord").collect():
        found.setdefault(r.source_file, []).append(
            (r.game_num, r.player_id, r.timestamp, r.event, json.loads(r.payload))
        )
    return found


def test_equals_state_machine_for_any_block_size(spark):
    rng = random.Random(7)
    sizes = [None, 1, 2, 3, 5, 8]
    sources = {f"log-{n}": random_log(rng) for n in range(90)}
    parts = [
        as_lines(spark, {k: v for n, (k, v) in enumerate(sources.items()) if n % len(sizes) == i and v}, size)
        for i, size in enumerate(sizes)
    ]
    lines = parts[0]
    for part in parts[1:]:
        lines = lines.unionByName(part)
    want = {k: rows for k, v in sources.items() if (rows := state_machine(v))}
    assert sum(len(v) for v in want.values()) > 300
    assert bronze_by_source(B.bronze(lines)) == want


def test_small_logs(spark):
    event = lambda n: header(f"1/1/2026 1:0{n}:00 PM", "A", "Queue") + "{}"
    sources = {
        "two_decks": [deck_line("a"), deck_line("b"), START_A, event(1), event(2)],
        "deck_mid_game": [START_A, event(1), deck_line("a"), event(2)],
        "double_start": [START_A, START_A, event(1)],
        "swallow": [START_A, header("t", "A", "GreToClientEvent"), header("u", "A", "GreToClientEvent"), gre()],
        "cut_off": [START_A, event(1), header("t", "A", "GreToClientEvent")],
        "cut_json": [START_A, header("t", "A", "GreToClientEvent"), gre({"n": 1})[:-2]],
        "no_branch": [START_A, header("t", "A", "GreToClientEvent"), '{"greToClientEvent": {}}'],
        "no_start": [event(1), END],
    }
    lines = as_lines(spark, sources, 2)
    rows = {k: [(r[0], r[2], r[3]) for r in v] for k, v in bronze_by_source(B.bronze(lines)).items()}
    assert rows == {
        "two_decks": [(1, "1/1/2026 1:01:00 PM", "deck_list"), (1, "1/1/2026 1:01:00 PM", "Queue"), (1, "1/1/2026 1:02:00 PM", "Queue")],
        "deck_mid_game": [(1, "1/1/2026 1:01:00 PM", "Queue"), (1, "1/1/2026 1:02:00 PM", "deck_list"), (1, "1/1/2026 1:02:00 PM", "Queue")],
        "double_start": [(2, "1/1/2026 1:01:00 PM", "Queue")],
        "swallow": [(1, "u", "GreToClientEvent")],
        "cut_off": [(1, "1/1/2026 1:01:00 PM", "Queue")],
        "cut_json": [(1, "t", "GreToClientEvent")],
    }
    assert sorted(rows_of(B.quarantine(lines), "source_file", "reason")) == [
        ("cut_off", "no_payload"), ("no_branch", "no_branch"), ("swallow", "no_payload"),
    ]


def test_files_are_read_in_order_across_splits(spark, tmp_path):
    rng = random.Random(3)
    sources = {f"{n}.log": random_log(rng) + ["x" * 400] * (n % 3) for n in range(6)}
    for name, lines in sources.items():
        (tmp_path / name).write_text("".join(line + rng.choice(["\n", "\r\n"]) for line in lines))
    (tmp_path / "placeholder.md").write_text(START_A + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        lines = logs.read_logs(spark, str(tmp_path))
        assert lines.select("block").distinct().count() > 5
        got = bronze_by_source(B.bronze(lines))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = {k: rows for k, v in sources.items() if (rows := state_machine(v))}
    assert {k.rsplit("/", 1)[1]: v for k, v in got.items()} == want


def test_csv_keeps_payload_text(spark, tmp_path):
    nasty = '[{"a":"x, \\"y\\" \\\\ z","b":"line"}]'
    rows = [("s", 1, 1, "A", "1/1/2026 1:00:00 PM", "Queue", nasty)]
    from duelspark import schemas

    df = spark.createDataFrame(rows, schemas.BRONZE)
    bronze_files.write_bronze(df, str(tmp_path / "landing"), "csv")
    assert rows_of(bronze_files.read_bronze(spark, str(tmp_path / "landing" / "*.csv"), "csv")) == rows


def test_only_new_files(spark, tmp_path):
    for name in ("a.log", "b.log", "notes.md"):
        (tmp_path / name).write_text("x\n")
    files = logs.list_files(spark, str(tmp_path))
    done = files.filter("source_file like '%a.log'")
    assert [r[0].rsplit("/", 1)[1] for r in rows_of(logs.unprocessed(files, done), "source_file")] == ["b.log"]
