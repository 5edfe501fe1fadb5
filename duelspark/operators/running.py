"""Running values inside groups of any size.

A window over a whole group puts the group into one task. Here the group is cut
into blocks of neighbouring rows; a window works inside each block, and one
summary row per block carries values across.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def carry_forward(
    df: DataFrame, group: list[str], block: str, order: list[str], value: Column, name: str
) -> DataFrame:
    """Adds the last non-NULL ``value`` up to and including each row."""
    keys = [*group, block]
    valued = df.withColumn(name, value)
    inside = (
        Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    before = (
        Window.partitionBy(*group).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    )
    place = F.struct(*order)
    carried = (
        valued.groupBy(*keys)
        .agg(F.max_by(name, F.when(F.col(name).isNotNull(), place)).alias("_tail"))
        .select(*keys, F.last("_tail", True).over(before).alias("_in"))
    )
    return (
        valued.withColumn(name, F.last(name, True).over(inside))
        .join(carried, keys, "left")
        .withColumn(name, F.coalesce(F.col(name), F.col("_in")))
        .drop("_in")
    )


def next_value(
    df: DataFrame, group: list[str], block: str, order: list[str], value: Column, name: str
) -> DataFrame:
    """Adds ``value`` of the following row of the group; NULL on the last row."""
    keys = [*group, block]
    inside = Window.partitionBy(*keys).orderBy(*order)
    blocks = Window.partitionBy(*group).orderBy(block)
    heads = (
        df.groupBy(*keys)
        .agg(F.min_by(value, F.struct(*order)).alias("_head"))
        .select(*keys, F.lead("_head").over(blocks).alias("_out"))
    )
    return (
        df.withColumn(name, F.lead(value).over(inside))
        .withColumn("_tail", F.lead(F.lit(True)).over(inside).isNull())
        .join(heads, keys, "left")
        .withColumn(name, F.when(F.col("_tail"), F.col("_out")).otherwise(F.col(name)))
        .drop("_tail", "_out")
    )
