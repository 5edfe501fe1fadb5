"""Card bulk files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from duelspark import schemas
from duelspark.operators.running import carry_forward
from duelspark.sources import logs


def read_cards(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Cards with their file position (``file``, ``ord``).

    The published file is one JSON array, which one task has to read here;
    ``read_array`` splits it. With ``lines=True`` the path holds one object per
    line and is split.
    """
    reader = spark.read.schema(schemas.CARD_BULK).option("multiLine", str(not lines).lower())
    return reader.json(path).select(
        "*",
        F.concat_ws("@", "_metadata.file_path", F.format_string("%020d", "_metadata.file_block_start")).alias("file"),
        F.monotonically_increasing_id().alias("ord"),
    )


def array_objects(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, start, pos, text) of every object of files that hold one JSON array of objects each.

    Files are cut at every closing brace, so many tasks read one array, however it
    is laid out. Whether a piece begins in a string, and how deep it is nested,
    depends on all pieces before it. A split is therefore summed up for both cases,
    and one row per split carries quotes and depth to the next. No escape is cut, as a
    brace ends none. The pieces of one object meet in a group, never those of a split.

    Files that don't end with the end of the array fail the job; an empty file, or
    one of blanks, has no objects.
    """
    raw = logs.with_origin(spark.read.option("lineSep", "}").text(path)).withColumn("pos", F.monotonically_increasing_id())
    pieces = raw.withColumn("block", logs.block_of(F.col("file"), F.col("start"), F.col("pos"), False)).select(
        "path", "block", "pos", "value"
    )
    # Without escapes every quote opens or closes a string: parts between quotes are outside and inside in turns.
    parts = F.split(F.regexp_replace("value", r"(?s)\\.", ""), '"')
    opened = lambda inside: F.aggregate(
        F.transform(parts, lambda p, i: F.when(i % 2 == inside, F.length(p) - F.length(F.replace(p, F.lit("{")))).otherwise(0)),
        F.lit(0), lambda total, n: total + n,
    )
    # A piece's own brace counts unless the piece ends in a string.
    quotes = F.size(parts) - 1
    seen = pieces.select(
        "path", "block", "pos", "value", (quotes % 2).alias("odd"),
        opened(0).alias("opens_0"), opened(1).alias("opens_1"),
        F.when(quotes % 2 == 0, 1).otherwise(0).alias("closes_0"), F.when(quotes % 2 == 1, 1).otherwise(0).alias("closes_1"),
    )
    block = Window.partitionBy("path", "block").orderBy("pos")
    before = block.rowsBetween(Window.unboundedPreceding, -1)
    either = lambda state, name: F.when(state == 0, F.col(f"{name}_0")).otherwise(F.col(f"{name}_1"))
    turned = seen.withColumn("turn", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)
    steps = turned.withColumn("step_0", either(F.col("turn"), "opens") - either(F.col("turn"), "closes")).withColumn(
        "step_1", either(1 - F.col("turn"), "opens") - either(1 - F.col("turn"), "closes")
    )

    blocks = steps.groupBy("path", "block").agg(
        (F.sum("odd") % 2).alias("odd"), F.sum("step_0").alias("step_0"), F.sum("step_1").alias("step_1"),
        F.max_by(F.substring(F.translate("value", " \t\r\n", ""), 1, 3), "pos").alias("tail"), F.count("pos").alias("n"),
    )
    file = Window.partitionBy("path").orderBy("block")
    earlier = file.rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("inside", F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2)
    taken = F.when(F.col("inside") == 0, F.col("step_0")).otherwise(F.col("step_1"))
    broken = F.concat(F.lit("no whole JSON array: "), "path")
    # What follows the last brace counts as a piece that closes once more, outside of strings.
    all_ = Window.partitionBy("path")
    even = (F.sum("odd").over(all_) % 2 == 0) & (F.sum(taken).over(all_) == -1)
    alone = (F.sum("n").over(all_) == 1) & F.col("tail").isin("", "[]")
    ended = even & (F.lead(F.lit(True)).over(file).isNotNull() | (F.col("tail") == "]") | alone)
    blocks = blocks.withColumn("deep", F.coalesce(F.sum(taken).over(earlier), F.lit(0))).select(
        "path", "block", "inside", F.when(ended, F.col("deep")).otherwise(F.raise_error(broken)).alias("deep")
    )

    placed = steps.join(blocks, ["path", "block"])
    own = F.when(F.col("inside") == 0, F.col("step_0")).otherwise(F.col("step_1"))
    state = (F.col("turn") + F.col("inside")) % 2
    placed = placed.select(
        "path", "block", "pos", "value", either(state, "opens").alias("opens"),
        (F.col("deep") + F.coalesce(F.sum(own).over(before), F.lit(0))).alias("depth"),
    )
    begins = (F.col("depth") == 0) & (F.col("opens") > 0)
    parted = placed.filter((F.col("depth") > 0) | begins).withColumn(
        "value", F.when(begins, F.expr("substring(value, locate('{', value))")).otherwise(F.col("value"))
    )
    first = F.when(begins, F.struct(F.col("block.start").alias("start"), "pos"))
    numbered = carry_forward(parted, ["path"], "block", ["pos"], first, "object")
    whole = numbered.groupBy("path", "object").agg(F.sort_array(F.collect_list(F.struct("block", "pos", "value"))).alias("pieces"))
    return whole.select(
        "path", "object.start", "object.pos", F.concat(F.array_join("pieces.value", "}"), F.lit("}")).alias("text")
    )


def read_array(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """As ``read_cards`` for files that hold one JSON array each, read by many tasks."""
    objects = array_objects(spark, path)
    return objects.select(F.from_json("text", schemas.CARD_BULK).alias("card"), "path", "start", "pos").select(
        "card.*", F.concat_ws("@", "path", F.format_string("%020d", "start")).alias("file"), F.col("pos").alias("ord")
    )


def write_cards(cards: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Full reload. CSV has no nested columns, so they become JSON text there."""
    if fmt == "csv":
        nested = [f.name for f in cards.schema.fields if f.dataType.typeName() in ("array", "map", "struct")]
        for name in nested:
            cards = cards.withColumn(name, F.to_json(name))
        cards.write.mode("overwrite").option("header", "true").option("escape", '"').csv(path)
    else:
        cards.write.mode("overwrite").format(fmt).save(path)
