"""Metrics kept up to date from sums per day, against metrics worked out whole."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from conftest import as_lines, deck_line, golden_log, rows_of
from pyspark.sql import functions as F

from duelspark.operators import bronze as B
from duelspark.operators import gold as X
from duelspark.plans import gold, silver
from duelspark.schemas import DAYS, GOLD, SILVER
from duelspark.sources.store import Store

MATCHES = "match_id BIGINT, deck_id BIGINT, player_id STRING, player_seat INT, start_time TIMESTAMP, duration_sec BIGINT, winner_seat INT"
HANDS = "hand_id BIGINT, match_id BIGINT, mulliganCount INT"


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo"])
def test_day_sums_equal_whole_ones(spark, zone):
    rng, last = random.Random(3), datetime(2026, 3, 31, 7, 30, tzinfo=timezone.utc)
    rows, hands = [], []
    for n in range(400):
        away = timedelta(days=rng.choice([0, 1, 29, 30, 30, 30, 31, 200]), seconds=rng.randrange(-40_000, 40_000))
        start = min(last, last - away)
        if n in (5, 6):
            start = last - timedelta(days=30) + timedelta(seconds=n - 5)
        duration = rng.choice([None, rng.randrange(4000)])
        rows.append((n, rng.randrange(6), f"p{rng.randrange(3)}", 1, start if n % 50 else None, duration, rng.randrange(3)))
        hands += [(n * 10 + k, n, rng.choice([0, 1, 2, 3, None])) for k in range(rng.randrange(3))]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        matches, hands = spark.createDataFrame(rows, MATCHES), spark.createDataFrame(hands, HANDS)
        days = None
        for low, high in ((0, 100), (100, 101), (101, 400)):
            some = lambda df: df.filter((F.col("match_id") >= low) & (F.col("match_id") < high))
            part = X.day_sums(some(matches), some(hands), matches)
            days = part if days is None else days.unionByName(part)
        columns = ["player_id", "deck_id", *X._SUMS, "last_start"]
        want = X.player_deck_stats(matches, hands)
        assert sorted(rows_of(X.stats_of_days(days, matches), *columns), key=str) == sorted(rows_of(want, *columns), key=str)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_updates_equal_a_reload(spark, tmp_path, monkeypatch):
    store = Store(spark, "days_" + tmp_path.name.replace("-", "_"), {**SILVER, **GOLD, **DAYS})
    store.create(str(tmp_path / "db"))
    log = golden_log()
    other = [deck_line(name="Other", main=((7, 3),))] + log[1:]
    logs = [log, [line.replace("m-1", "m-2") for line in log], [line.replace("m-1", "m-3") for line in other]]
    metrics = ("player_metrics", "deck_metrics")
    for n, lines in enumerate(logs):
        silver.load(store, silver.shape(B.bronze(as_lines(spark, {f"{n}": lines}))))
        if n == 1:
            append = store.append
            monkeypatch.setattr(store, "append", lambda table, df: 1 / 0 if table == "gold_runs" else append(table, df))
            with pytest.raises(ZeroDivisionError):
                gold.update(store)
            monkeypatch.undo()
        assert gold.update(store) > 0
        want = gold.build(silver.read_all(store))
        for name in metrics:
            columns = store.specs[name].columns
            assert sorted(rows_of(store.read(name), *columns), key=str) == sorted(rows_of(want[name], *columns), key=str), name
    assert gold.update(store) == 0 and store.read("gold_runs").count() == 3
