"""Rendezvous hashing of record keys over weighted shards.

Every shard draws a score for every key from a hash of both, and the key goes
to the shard with the highest score. A shard more or less moves only the keys
whose highest score it draws: a new shard takes rows, but no row moves between
old shards. A shard of twice the weight gets twice the keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duelspark.session import stage


def score(key: Column, shard: int, weight: float) -> Column:
    """ln(u) / weight, u uniform in (0, 1) and fixed by key and shard."""
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(shard).cast("long")), 11)
    return F.log((bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))) / F.lit(float(weight))


def best(key: Column, weights: list[float]) -> Column:
    """(score, -shard) of the shard that wins; equal scores go to the smaller shard. Shards of weight 0 get nothing."""
    bids = [F.struct(score(key, n, w).alias("score"), F.lit(-n).alias("minus")) for n, w in enumerate(weights) if w > 0]
    if not bids:
        raise ValueError("no shard has a positive weight")
    return F.array_max(F.array(*bids))


def assign(df: DataFrame, key: str, weights: list[float], name: str = "shard") -> DataFrame:
    """Adds the shard of each row. A null key is a key of its own, the same for all rows that have none; no rows give no rows."""
    return df.withColumn(name, -best(F.col(key).cast("long"), weights).getField("minus"))


def number(df: DataFrame, group: str, order: list[str], block: str, name: str = "slot") -> DataFrame:
    """Numbers the rows of every group from 0 without gaps.

    A group may be a third of all rows: rows are numbered inside (group, block)
    and shifted by the rows of the group's smaller blocks. ``df`` is read twice
    and must be stored. Rows equal in ``order`` are numbered in any order; an empty
    table stays empty.
    """
    sizes = df.groupBy(group, block).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(group).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col(group).alias("_group"), F.col(block).alias("_block"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"),
    )
    inside = F.row_number().over(Window.partitionBy(group, block).orderBy(*order)) - 1
    return (
        df.withColumn(name, inside.cast("long"))
        .join(starts, (F.col(group) == F.col("_group")) & (F.col(block) == F.col("_block")))
        .withColumn(name, F.col(name) + F.col("_start"))
        .drop("_group", "_block", "_start")
    )


def shard_table(docs: DataFrame, weights: list[float], grown: float = 1.0, rows_per_block: int = 100_000) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot, grown_shard of every row of ``docs`` (doc_id, text, ...).

    ``grown_shard`` is the shard after one more, of weight ``grown``, is added.
    A null text has size 8 and the checksum of no bytes; a null doc_id is a key
    like any other; repeated rows share a shard and have slots of their own.
    Slots follow doc_id at every size, a null one first.
    Other columns are ignored. Only the narrow rows are shuffled, never texts.
    """
    key = F.col("doc_id").cast("long")
    text = F.coalesce(F.col("text"), F.lit(""))
    more = [*weights, grown]
    narrow = docs.select(
        key.alias("doc_id"),
        (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        best(key, weights).alias("_old"),
        F.struct(score(key, len(weights), grown).alias("score"), F.lit(-len(weights)).alias("minus")).alias("_new"),
    ).select(
        "doc_id", "size", "text_crc32",
        (-F.col("_old.minus")).alias("shard"),
        (-F.when(F.col("_new") > F.col("_old"), F.col("_new.minus")).otherwise(F.col("_old.minus"))).alias("grown_shard"),
    )
    if grown <= 0:
        narrow = narrow.withColumn("grown_shard", F.col("shard"))
    narrow = stage(narrow, f"shards-{len(more)}")
    blocks = narrow.count() // rows_per_block + 1
    # Blocks are ranges of the order, stored as range bounds are sampled and must not be drawn twice.
    order = ["doc_id", "text_crc32", "size"]
    ranged = narrow.repartitionByRange(blocks, *order).withColumn("_at", F.spark_partition_id())
    return number(stage(ranged, "shard-blocks"), "shard", order, "_at").drop("_at")
