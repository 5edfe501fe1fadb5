"""The pipeline's stages against plain versions of their decisions."""

import corpus_pipeline
from pyspark.sql import functions as F

from duelspark.llm import mixing

from .test_texts import docs, plain_components

FOLDER = "/root/testdata/sf0.001"


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages(spark):
    start = spark.read.parquet(f"{FOLDER}/documents.parquet")
    known = corpus_pipeline.language_id(spark, start, FOLDER)
    assert known.columns == start.columns and known.subtract(start).isEmpty()
    assert ids(known) == ids(start.filter(F.col("text").rlike(r"\p{L}")))

    kept = corpus_pipeline.near_dedup(spark, known, FOLDER)
    rows = [(r.doc_id, r.text) for r in known.collect()]
    assert ids(kept) == sorted(d for d, (_, c) in plain_components(rows, 5, 80).items() if d == c)
    assert kept.columns == start.columns and kept.subtract(start).isEmpty()

    mixed = corpus_pipeline.mix_sources(spark, kept, FOLDER)
    copies = {r.doc_id: r.copies for r in mixing.mix(kept).select("doc_id", "copies").distinct().collect()}
    assert ids(mixed) == sorted(d for d, n in copies.items() for _ in range(n))
    assert mixed.columns == start.columns and mixed.subtract(start).isEmpty()

    coded = corpus_pipeline.sentencepiece(spark, mixed, FOLDER)
    assert ids(coded) == ids(mixed) and coded.columns == ["doc_id", "lang", "source", "n_chars", "n_ids", "ids"]


def test_run_is_its_stages(spark):
    done = corpus_pipeline.run(spark, FOLDER)
    assert done.count() > 50 and done.filter("n_ids <> size(ids)").isEmpty()


def test_stages_of_odd_rows(spark):
    rows = docs(spark, [(1, None), (2, ""), (3, "12 …"), (4, "one two three four five six"), (4, "one two three four five six"),
                        (5, "one two three four five six"), (None, "seven eight"), (None, "nine"), (6, "t " * 50_000)])
    rows = rows.withColumn("lang", F.lit("en")).withColumn("kept", F.lit("clash")).withColumn("rate", F.lit(3))
    for _, step in corpus_pipeline.STAGES[:3]:
        assert step(spark, rows.limit(0), FOLDER).columns == rows.columns
        assert step(spark, rows.limit(0), FOLDER).count() == 0
    known = corpus_pipeline.language_id(spark, rows, FOLDER)
    assert known.columns == rows.columns and known.count() == 6
    kept = corpus_pipeline.near_dedup(spark, known, FOLDER)
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 4, 6]
    assert set(corpus_pipeline.sentencepiece(spark, kept, FOLDER).columns) >= {"ids", "kept", "rate"}
    unlabelled = rows.withColumn("lang", F.lit(None).cast("string"))
    assert corpus_pipeline.language_id(spark, unlabelled, FOLDER).count() == 6


def test_one_row_of_each_group(spark):
    one, far = " ".join(f"w{n}" for n in range(40)), " ".join(f"y{n}" for n in range(40))
    near = far.replace("y39", "z")
    rows = [(1, one), (None, one), (1, one.upper()), (None, far), (None, near), (None, far), (5, "a unique text of some words"),
            (5, one), (7, "p q r s t u"), (7, "P Q r s t u"), (None, "p q r s t u")]
    kept = corpus_pipeline.near_dedup(spark, docs(spark, rows), FOLDER).select("doc_id", "text").collect()
    assert sorted(r.doc_id or 0 for r in kept) == [0, 1, 5, 7]
    assert {r.text for r in kept if r.doc_id == 5} == {"a unique text of some words"}
    assert {r.text for r in kept if r.doc_id is None} <= {far, near}


def test_extra_columns_keep_their_values(spark):
    """Columns named like those the operators make pass with their values, row by row."""
    rows = docs(spark, [(n, f"text number {n} of some words in a row {'x' * n}") for n in range(40)])
    names = ["rate", "copies", "copy", "shuffle_key", "_source", "row", "__near_row", "kept", "component_id", "n_shingles", "id", "lang_pred", "Score"]
    rows = rows.withColumns({"lang": F.lit("en")} | {c: F.concat(F.lit(c), F.col("doc_id")) for c in names})
    for _, step in corpus_pipeline.STAGES[:3]:
        out = step(spark, rows, FOLDER)
        assert out.columns == rows.columns and out.subtract(rows).isEmpty() and not out.isEmpty()
    clash = rows.withColumns({"ids": F.lit("mine"), "n_ids": F.lit("too")})
    coded = corpus_pipeline.sentencepiece(spark, clash, FOLDER)
    assert {(r.input_ids, r.input_n_ids) for r in coded.collect()} == {("mine", "too")}
    assert coded.select("doc_id", *names).subtract(clash.select("doc_id", *names)).isEmpty()


def test_predicted_languages_take_effect(spark):
    start = spark.read.parquet(f"{FOLDER}/documents.parquet")
    some = F.col("doc_id") % 3 == 0
    blank = start.withColumn("lang", F.when(~some, F.col("lang")))
    extra = docs(spark, [(10_001, "Привет мир это русский текст"), (10_002, "日本語の文章です")])
    got = {r.doc_id: r.lang for r in corpus_pipeline.language_id(spark, blank.union(extra), FOLDER).collect()}
    true = {r.doc_id: r.lang for r in start.filter(F.col("text").rlike(r"\p{L}")).collect()}
    assert got.keys() == true.keys()
    assert all(got[d] == lang for d, lang in true.items() if d % 3)
    filled = [d for d in true if d % 3 == 0]
    assert sum(got[d] == true[d] for d in filled) > 0.9 * len(filled)
