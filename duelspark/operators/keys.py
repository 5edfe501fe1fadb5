"""Dense integer ids without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duelspark.session import stage


def assign_ids(rows: DataFrame, order: list[str], name: str, start_after: int = 0) -> DataFrame:
    """Adds ids ``start_after + 1 ..`` in the order of the given unique columns.

    Rows are range-partitioned, sorted and written once with their place: the
    partition above and the row in it below bit 33. Each partition is then
    numbered from its offset; there is one offset row per partition.
    """
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    ranged = stage(placed, f"ids-{name}")
    part, row = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    parts = ranged.groupBy(part.alias("_part")).agg(F.count("*").alias("n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_offset"))
    return (
        ranged.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, (F.lit(start_after + 1) + F.col("_offset") + row).cast("bigint"))
        .drop("_part", "_offset", "_at")
    )


def highest(table: DataFrame, name: str) -> int:
    """Largest stored id, 0 for an empty table."""
    return table.agg(F.coalesce(F.max(name), F.lit(0))).first()[0]
