"""Shape of the physical plans."""

import re

import pytest
from conftest import as_lines, golden_log

from duelspark.operators import bronze as B
from duelspark.operators import games as G
from duelspark.operators import hands as H
from duelspark.operators import messages as M
from duelspark.plans import standins as S
from duelspark.plans.registry import QUERIES, _Gold

FOLDER = "/root/testdata/sf0.001"


def plan(df, run=False):
    if run:
        df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0] if run else text


def test_lines_are_shuffled_once(spark):
    text = plan(B.bronze(S.event_log(S.table(spark, FOLDER, "events"))), run=True)
    assert len(re.findall(r"FileScan parquet", text)) == 1
    assert len(re.findall(r"ReusedExchange", text)) == 1
    wide = [line for line in text.splitlines() if "Exchange hashpartitioning" in line and "block" in line]
    assert len([line for line in wide if "Reused" not in line]) == 1


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_workers_and_no_global_windows(spark, name):
    if name in ("stream_ingest", "silver_append", "log_scan", "new_files", "bronze_roundtrip"):
        pytest.skip("writes files before it returns; its operators are covered by the others")
    text = plan(QUERIES[name](spark, FOLDER))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text, node
    for line in text.splitlines():
        if re.search(r"[-+ ]Window \[", line) and name != "surrogate_keys":
            partition = re.search(r"\], \[([^\]]*)\], \[[^\]]*\]$", line.strip())
            assert partition is None or partition.group(1), line


def test_scans_read_only_needed_columns(spark):
    text = plan(_Gold(spark, FOLDER).stats)
    scans = [re.sub(r"#\d+L?", "", columns) for columns in re.findall(r"FileScan parquet \[([^\]]*)\]", text)]
    assert "l_orderkey,l_linenumber" in scans
    assert not any("l_extendedprice" in s or "o_orderpriority" in s for s in scans)


def test_game_ends_do_not_parse_game_states(spark):
    bronze = B.bronze(as_lines(spark, {"a": golden_log()}))
    text = plan(G.describe(M.first_last(bronze)))
    assert "gameStateMessage" not in text
    parsed = plan(H.candidates(M.explode_messages(bronze)))
    assert "gameStateMessage" in parsed
