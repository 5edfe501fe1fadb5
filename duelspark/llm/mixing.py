"""Mixing sources to target weights by Poisson replication.

Every source gets a mean repetition rate that brings its share of the text to
its target weight. A document is repeated as often as a Poisson variable of
that mean says, drawn by inverting the distribution at a hash of its id; the
copies are then shuffled globally by a hash of id and copy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelspark.session import stage

#: A larger mean is split into equal parts drawn apart, so that exp(-mean) stays far from zero.
MOST_MEAN = 500.0


def rates(docs: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """_source, rate: mean repetitions per source, one row per source; null is a source too.

    A source's size is the UTF-8 length of its texts; all sizes are counted, so
    the expected text is as long as before. ``weights`` None: equal shares for
    all sources that have text; else sources without a weight get rate 0. A
    source without any text keeps rate 1, as no repetition changes its share.
    """
    sizes = docs.groupBy(F.col("source").alias("_source")).agg(
        F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0)).alias("size")
    )
    if weights is None:
        given = F.when(F.col("size") > 0, F.lit(1.0)).otherwise(F.lit(0.0))
    else:
        given = F.lit(0.0)
        for name, weight in weights.items():
            given = F.when(F.col("_source").eqNullSafe(F.lit(name)) & (F.col("size") > 0), F.lit(float(weight))).otherwise(given)
    sizes = stage(sizes.withColumn("weight", given), "source-sizes")
    total, weights_ = sizes.agg(F.sum("size"), F.sum("weight")).first()
    rate = (
        F.when(F.col("size") == 0, F.lit(1.0))
        .when(F.lit(not weights_), F.lit(0.0))
        .otherwise(F.col("weight") / F.lit(weights_) * F.lit(total) / F.col("size"))
    )
    return sizes.select("_source", rate.alias("rate"))


def cumulated(mean: Column) -> Column:
    """P(X <= 0), P(X <= 1), ... of a Poisson variable, up to where nothing is left in double precision."""
    last = F.ceil(mean + 12 * F.sqrt(mean) + 25).cast("int")
    first = F.exp(-mean)
    start = F.struct(first.alias("p"), F.array(first).alias("sums"))
    step = lambda done, k: F.struct(
        (done.getField("p") * mean / k).alias("p"),
        F.concat(
            done.getField("sums"),
            F.array(F.element_at(done.getField("sums"), -1) + done.getField("p") * mean / k),
        ).alias("sums"),
    )
    return F.aggregate(F.sequence(F.lit(1), last), start, step, lambda done: done.getField("sums"))


def uniform(*key: Column) -> Column:
    return (F.shiftrightunsigned(F.xxhash64(*key), 11).cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))


def mix(docs: DataFrame, weights: dict[str, float] | None = None, seed: int = 1) -> DataFrame:
    """The columns of ``docs`` (doc_id, text, source, ...) with rate, copies, copy and shuffle_key.

    One row per copy, in partitions ranged and sorted by ``shuffle_key``. Which
    documents are repeated depends on doc_id, rate and seed alone, so repeated
    rows are repeated alike. A null doc_id is an id like any other, a null text has
    no size but comes as often as its id says, and an empty table gives no rows.
    Columns of these names in ``docs`` are replaced.
    """
    docs = docs.drop("rate", "copies", "copy", "shuffle_key")
    key = F.col("doc_id").cast("long")
    parts = F.greatest(F.ceil(F.col("rate") / MOST_MEAN), F.lit(1)).cast("long")
    tables = rates(docs, weights).select(
        "_source", "rate", parts.alias("_parts"), cumulated(F.col("rate") / parts).alias("_sums")
    )
    draw = lambda part: F.size(
        F.filter("_sums", lambda s: s <= uniform(key, F.lit(seed).cast("long"), part))
    )
    copies = F.aggregate(
        F.transform(F.sequence(F.lit(1).cast("long"), F.col("_parts")), draw), F.lit(0), lambda a, b: a + b
    )
    copied = (
        docs.join(tables, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("copies", copies)
        .drop("_source", "_parts", "_sums")
        .filter("copies > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .withColumn("shuffle_key", F.xxhash64(key, F.lit(seed).cast("long"), F.lit(0).cast("long"), F.col("copy").cast("long")))
    )
    return copied.repartitionByRange("shuffle_key").sortWithinPartitions("shuffle_key")
