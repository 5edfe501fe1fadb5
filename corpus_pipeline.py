"""A corpus of training documents in four stages.

Each stage gets all its predecessor kept and returns the columns of documents;
the last returns encoded documents. Extra columns pass all stages with their
values, whatever their names; only those named like the last stage's own
columns get new names. Empty tables stay empty, repeated rows are treated alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duelspark.llm import languages, mixing, near_dups, pieces
from duelspark.session import stage


COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _plain(docs: DataFrame) -> tuple[DataFrame, list[Column]]:
    """``docs`` with reserved names for extra columns, and the columns that give them their own names back."""
    names = [c if c in COLUMNS else f"__extra_{n}" for n, c in enumerate(docs.columns)]
    return docs.toDF(*names), [F.col(name).alias(c) for name, c in zip(names, docs.columns)]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told go on, and a null lang is filled with the predicted one.

    Null texts, those without a letter, and those mostly in scripts that no
    language of the table is written in are rejected. The model is learned from
    all rows that have a lang and are not held out. Where no row has one, nothing
    can be told apart: all rows with a letter go on and lang stays null.
    """
    model = languages.learn(docs.filter(~languages.held_out()))
    if not model["names"]:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    rows, names = _plain(docs)
    return languages.identified(rows, model).select(*names)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of five-word near-duplicates of 0.8 or more goes on, one of smallest doc_id.

    Rows without doc_id are grouped like others; one goes on if its group has no doc_id.
    Texts of one doc_id that are not alike are in groups of their own.
    """
    rows, names = _plain(docs)
    return near_dups.one_of_each(rows, words=5, percent=80).select(*names)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every source with an equal expected share of the text; documents come as often as drawn, shuffled globally.

    A null source is one like others; documents of a source without any text come once on average.
    """
    rows, names = _plain(docs)
    return mixing.mix(rows).select(*names)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str, model: str | None = None) -> DataFrame:
    """All columns but the text, with n_ids and ids; null text has none. Extra columns of these names become input_n_ids and input_ids."""
    if model is None:
        import public_tokenizers

        model = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.encode(docs, model, keep={"n_ids": "input_n_ids", "ids": "input_ids"})


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("sentencepiece", sentencepiece),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


#: Learned languages and encoding are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None
