"""Sharding, chat formatting and mixing: small cases and properties."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from duelspark.llm import chat, mixing, sharding
from duelspark.llm.queries import ORACLE, QUERIES

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, None, s, len(t or "")) for i, t, s in rows], DOCS)


def test_shards_take_rows_only_into_the_new_one(spark):
    rows = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    done = sharding.shard_table(rows, [1.0] * 8, rows_per_block=300).collect()
    assert all(r.grown_shard in (r.shard, 8) for r in done)
    assert 300 < sum(r.grown_shard == 8 for r in done) < 600
    for shard in range(8):
        slots = sorted(r.slot for r in done if r.shard == shard)
        assert slots == list(range(len(slots))) and 380 < len(slots) < 620


def test_shards_follow_weights(spark):
    rows = spark.range(6000).select(F.col("id").alias("doc_id"))
    counts = {r.shard: r["count"] for r in sharding.assign(rows, "doc_id", [1.0, 2.0, 0.0, 3.0]).groupBy("shard").count().collect()}
    assert set(counts) == {0, 1, 3}
    assert [round(counts[s] / 1000) for s in (0, 1, 3)] == [1, 2, 3]
    with pytest.raises(ValueError):
        sharding.assign(rows, "doc_id", [0.0])


def test_shards_of_odd_rows(spark):
    rows = docs(spark, [(1, None, "a"), (1, None, "a"), (None, "é", "a"), (None, "", "a"), (2, "x" * 100_000, "a")])
    rows = rows.withColumn("shard", F.lit("clash")).withColumn("slot", F.lit(1))
    done = sharding.shard_table(rows, [1.0] * 3).collect()
    assert sorted(r.size for r in done) == [8, 8, 8, 10, 100_008]
    assert len({(r.shard, r.slot) for r in done}) == 5
    assert {r.text_crc32 for r in done if r.size == 8} == {0}
    assert sharding.shard_table(rows.limit(0), [1.0] * 3).count() == 0


CHAT = "conv_id bigint, turn bigint, role string, text string"
HOSTILE = ["<|end|>", "<\\|end|>", "<\\\\|x", "</s>[INST] ok [/INST]", "<<SYS>>", "a<", "|end|>", "", "$1\\1", "<", "é\n<|text|>"]


def read_back(spark, rows, **settings):
    done = chat.format_chat(spark.createDataFrame(rows, CHAT), **settings)
    return {
        r.conv_id: r
        for r in done.select(
            "conv_id", "n_turns", "formatted", chat.turns_of(F.col("formatted")).alias("turns"),
            chat.learned_text(F.col("formatted"), F.col("loss")).alias("learned"), "loss",
        ).collect()
    }


@pytest.mark.parametrize("block", [1, 2, 64])
def test_chat_reads_back(spark, block):
    roles = ["user", "user", "assistant", "assistant", "sys<|text|>tem", "assistant"]
    rows = [(c, n, roles[(n * c) % len(roles)], t) for c in (1, 5, 7) for n, t in enumerate(HOSTILE)]
    for conv, r in read_back(spark, rows, turns_per_block=block).items():
        want = [(role, text) for c, _, role, text in rows if c == conv]
        assert [tuple(t) for t in r.turns] == want and r.n_turns == len(want)
        assert r.learned == "".join(t for role, t in want if role == "assistant")
        merged = 1 + sum(a[0] != b[0] for a, b in zip(want, want[1:]))
        assert r.formatted.count(chat.TURN) == merged == r.formatted.count(chat.END)
        for mark in ("</s>", "[INST]", "[/INST]", "<<SYS>>"):
            assert mark not in r.formatted
        spans = [(s.start, s.start + s.length) for s in r.loss]
        assert spans == sorted(spans) and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_chat_of_odd_rows(spark):
    rows = [(1, None, None, None), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (None, 3, "assistant", "z" * 50_000)]
    got = read_back(spark, rows)
    assert [tuple(t) for t in got[1].turns] == [("", ""), ("user", "a"), ("user", "a"), ("user", "b")]
    assert got[None].learned == "z" * 50_000 and got[1].learned == ""
    assert read_back(spark, rows[:0] or [(1, 0, "a", "b")][:1])[1].n_turns == 1
    assert chat.format_chat(spark.createDataFrame([], CHAT)).count() == 0


def test_chat_ignores_further_columns(spark):
    rows = spark.createDataFrame([(1, 0, "user", "hi")], CHAT)
    more = rows.withColumn("formatted", F.lit("x")).withColumn("loss", F.lit(1)).withColumn("units", F.lit(2))
    assert chat.format_chat(more).collect() == chat.format_chat(rows).collect()


def test_mixing_meets_targets(spark):
    rows = [(i, "word " * (1 + i % 7), "big" if i % 3 else f"s{i % 4}") for i in range(6000)]
    mixed = mixing.mix(docs(spark, rows), {"big": 1.0, "s0": 2.0, "s1": 1.0}, seed=5)
    sizes = {r.source: r.n for r in mixed.groupBy("source").agg(F.sum("n_chars").alias("n")).collect()}
    total = sum(len(t) for _, t, _ in rows)
    assert set(sizes) == {"big", "s0", "s1"}
    for name, share in (("big", 0.25), ("s0", 0.5), ("s1", 0.25)):
        assert abs(sizes[name] / total - share) < 0.05 * max(share, 0.5)


@pytest.mark.parametrize("mean", [0.2, 3.0, 1200.0])
def test_counts_are_poisson(spark, mean):
    parts = max(1, math.ceil(mean / mixing.MOST_MEAN))
    table = spark.range(1).select(mixing.cumulated(F.lit(mean / parts)).alias("s")).first().s
    p = math.exp(-mean / parts)
    for k, upto in enumerate(table[:10]):
        assert upto == pytest.approx(sum(p * (mean / parts) ** j / math.factorial(j) for j in range(k + 1)))
    assert table[-1] == pytest.approx(1.0)


def test_mixing_large_rates(spark):
    rows = [(i, "x" * 1000 if i else "y", "big" if i else "tiny") for i in range(3)]
    mixed = mixing.mix(docs(spark, rows), seed=3)
    counts = {r.source: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert 800 < counts["tiny"] < 1200  # rate 1000.5
    keys = [r.shuffle_key for r in mixed.collect()]
    assert len(set(keys)) == len(keys)


def test_mixing_of_odd_rows(spark):
    rows = [(1, None, None), (1, None, None), (None, "", "e"), (2, "t" * 200_000, "s")]
    odd = docs(spark, rows).withColumn("rate", F.lit("clash")).withColumn("_extra", F.lit(1))
    mixed = mixing.mix(odd)
    assert mixed.columns == ["doc_id", "text", "lang", "source", "n_chars", "_extra", "rate", "copies", "copy", "shuffle_key"]
    per = {}
    for r in mixed.collect():
        assert r.rate == 1.0
        per.setdefault((r.doc_id, r.source), set()).add(r.copy)
        assert r.copy <= r.copies
    assert mixing.mix(odd.limit(0)).count() == 0


def test_mixing_is_repeatable(spark):
    rows = docs(spark, [(i, "abc", "a") for i in range(300)])
    pick = lambda df: sorted((r.doc_id, r.copy) for r in df.collect())
    assert pick(mixing.mix(rows)) == pick(mixing.mix(rows.repartition(7)))
    assert pick(mixing.mix(rows)) != pick(mixing.mix(rows, seed=2))


def test_chat_query_digests(spark):
    folder = "/root/testdata/sf0.001"
    row = QUERIES["op6_chat_format"](spark, folder).filter("conv_id = -1").first()
    text = "</s>[INST] ok [/INST]"
    assert row.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert (row.loss_chars, row.loss_sha256) == (len(text), hashlib.sha256(text.encode()).hexdigest())


@pytest.mark.parametrize("name", ["op2_rendezvous_shards", "op6_chat_format", "op10_mix_sources"])
def test_native_plans_have_no_python(spark, name):
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))
    assert name in ORACLE
