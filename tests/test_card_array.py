"""One JSON array read by many tasks."""

import json
import random

import pytest

from duelspark.sources import card_bulk

TEXTS = ['plain', 'a } b', '{', '"quoted"', '\\', '\\"}', 'tab\tand\nline', 'ü—{"x":[1,{}]}', '', '}{' * 9, ']', '\\\\}']


def cards(n, seed=3):
    rng = random.Random(seed)
    return [
        {
            "arena_id": rng.choice([None, i]), "oracle_id": f"o{i}", "name": "".join(rng.choices(TEXTS, k=3)),
            "extra": {"deep": [{"a": rng.choice(TEXTS)}, [], {}]}, "cmc": i / 2,
            "colors": rng.choice([None, [], ["W", "U"]]), "legalities": {"standard": "legal", rng.choice(TEXTS) + "k": "x"},
        }
        for i in range(n)
    ]


def laid(items, form):
    if form == "compact":
        return json.dumps(items, separators=(",", ":"), ensure_ascii=False)
    if form == "pretty":
        return json.dumps(items, indent=4) + "\n"
    return "[\n" + ",\r\n".join(json.dumps(i, ensure_ascii=False) for i in items) + "\n]\n"


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "0"}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name in names:
        spark.conf.unset(name)


def listed(df):
    columns = [c for c in df.columns if c not in ("file", "ord")]
    return [json.dumps(r.asDict(recursive=True), default=str, sort_keys=True) for r in df.select(*columns).collect()]


@pytest.mark.parametrize("form", ["compact", "pretty", "lines"])
def test_same_as_the_whole_reader(spark, tmp_path, small_splits, form):
    for k, n in enumerate((60, 7)):
        (tmp_path / f"{k}.json").write_text(laid(cards(n, k), form), encoding="utf-8", newline="")
    split = card_bulk.read_array(spark, str(tmp_path))
    assert sorted(listed(split)) == sorted(listed(card_bulk.read_cards(spark, str(tmp_path))))
    assert spark.read.option("lineSep", "}").text(str(tmp_path)).rdd.getNumPartitions() > 8
    # File and place give the order of the array.
    first = split.filter("file LIKE '%/0.json%'").orderBy("file", "ord").select("oracle_id").collect()
    assert [r.oracle_id for r in first] == [f"o{i}" for i in range(60)]


def test_empty_and_blank_arrays(spark, tmp_path):
    for name, text in {"a": "[]", "b": "[ ]\n", "c": "", "d": "\n "}.items():
        (tmp_path / f"{name}.json").write_text(text)
    assert card_bulk.read_array(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("text", ["[", '[{"a":1}', '[{"a":1}\n', '[{"a":[{"b":1}]', '[{"a":1},{"b":"x}]', "[1"])
def test_short_cut_arrays_fail(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    with pytest.raises(Exception, match="no whole JSON array"):
        card_bulk.read_array(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("cut", [-1, -40])
def test_cut_arrays_fail(spark, tmp_path, small_splits, cut):
    (tmp_path / "a.json").write_text(laid(cards(20), "compact")[:cut])
    with pytest.raises(Exception, match="no whole JSON array"):
        card_bulk.read_array(spark, str(tmp_path)).collect()


def test_compressed_arrays(spark, tmp_path):
    import gzip

    (tmp_path / "a.json.gz").write_bytes(gzip.compress(laid(cards(40), "pretty").encode()))
    assert sorted(listed(card_bulk.read_array(spark, str(tmp_path)))) == sorted(
        listed(card_bulk.read_cards(spark, str(tmp_path)))
    )
