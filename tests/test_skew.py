"""One log or one game that holds most of the rows is worked on by several tasks."""

import pytest
from conftest import END, START_A, as_lines, header, rows_of
from pyspark.sql import functions as F

from duelspark.operators import bronze as B
from duelspark.operators.running import carry_forward
from duelspark.schemas import SILVER
from duelspark.sources import logs
from duelspark.sources.store import laid_out


@pytest.fixture
def keep_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_hot_log(spark, keep_partitions):
    event = [header("1/1/2026 1:00:00 PM", "A", "Queue") + '{"n":1}']
    hot = [START_A] + event * 700
    cold = {f"cold-{n}": [START_A, *event, END] for n in range(100)}
    lines = as_lines(spark, {"hot": hot, **cold}, 20)
    rows = B.bronze(lines).select("*", F.spark_partition_id().alias("task"))
    per_task = dict(
        rows_of(rows.filter("source_file = 'hot'").groupBy("task").agg(F.count("*").alias("n")))
    )
    assert sum(per_task.values()) == 700
    assert len(per_task) >= 4 and max(per_task.values()) < 400
    assert rows_of(rows.filter("source_file = 'hot'").agg(F.min("game_num"), F.max("game_num"))) == [(1, 1)]


def test_hot_game(spark, keep_partitions):
    df = spark.range(4000).select(
        F.lit("g").alias("game"), F.floor(F.col("id") / 100).alias("block"), "id",
        F.when(F.col("id") % 700 == 3, F.col("id")).alias("v"),
    )
    out = carry_forward(df, ["game"], "block", ["id"], F.col("v"), "last").select(
        "id", "last", F.spark_partition_id().alias("task")
    )
    rows = rows_of(out)
    assert all(last == (None if i < 3 else (i - 3) // 700 * 700 + 3) for i, last, _ in rows)
    assert len({task for _, _, task in rows}) >= 4


def test_hot_player_is_written_as_several_files(spark, tmp_path):
    spec = SILVER["matches"]
    rows = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("p"), "id")).alias("player_id"),
        (F.col("id") % 50).alias("deck_id"),
        F.col("id").alias("match_id"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        laid_out(rows, spec).write.parquet(str(tmp_path / "m"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    hot = spark.read.parquet(str(tmp_path / "m")).filter("player_id = 'hot'")
    assert hot.select(F.col("_metadata.file_path")).distinct().count() >= 2


def test_hot_log_is_written_in_ordered_parts(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        lines = spark.range(3000).select(
            F.lit("hot").alias("log"), F.col("id").alias("pos"), F.col("id").cast("string").alias("line")
        )
        logs.write_logs(lines, str(tmp_path / "logs"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    read = logs.read_logs(spark, str(tmp_path / "logs"), "*.txt", rolled=True)
    assert read.select("block").distinct().count() >= 4
    back = [int(r.line) for r in read.orderBy("source_file", "block", "pos").collect()]
    assert back == list(range(3000))
