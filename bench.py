"""Times the headline queries and prints one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (local cores), BENCH_RUNS.
Each query is warmed up once; the median of the timed runs counts. Rows go to
the ``noop`` sink, so the whole result is computed and nothing is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from duelspark.operators import bronze as B
from duelspark.plans import standins as S
from duelspark.plans.registry import QUERIES
from duelspark.session import build_session
from duelspark.session import stage as staged

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = [
    "player_metrics", "deck_metrics", "card_metrics", "deck_colors", "card_opener_winrate", "game_sessionize",
    "deck_carry", "payload_project", "matches", "turn1_hands", "deck_hash", "surrogate_keys", "dim_cards",
    "bronze_roundtrip",
]


def timed(make) -> float:
    started = time.perf_counter()
    make().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    spark = build_session(
        "duelspark-bench", f"local[{CPUS}]",
        **{"spark.sql.shuffle.partitions": CPUS, "spark.ui.enabled": "false", "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    jobs = {name: (lambda fn=QUERIES[name]: fn(spark, FOLDER)) for name in HEADLINE}
    # The parser alone, on log lines that are made beforehand.
    lines = staged(S.event_log(S.table(spark, FOLDER, "events")), "bench-lines")
    jobs["bronze_parse"] = lambda: B.bronze(lines)

    times = {}
    for name, make in jobs.items():
        timed(make)
        times[name] = round(statistics.median(timed(make) for _ in range(RUNS)), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
                "bronze_lines_per_sec": round(lines.count() / times["bronze_parse"]),
                "cores": int(CPUS),
                "spark": spark.version,
            }
        )
    )


if __name__ == "__main__":
    main()
