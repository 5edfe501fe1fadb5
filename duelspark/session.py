"""Session settings and the shared working folder."""

from __future__ import annotations

import re
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot join key is split even where that costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Longer generated methods are never compiled to machine code by the JVM.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
OPEN_COST = "spark.sql.files.openCostInBytes"
#: Bytes that could be read while a small file is opened.
FILE_COST = 1 << 18


def build_session(app: str = "duelspark", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir`` of the session.

    Where that is unset, the warehouse, which a cluster shares as well; a local
    folder is refused there, as each machine would write to its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        # Fixed at launch time on a cluster; not always copied into the SQL conf.
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if root is None:
        root = spark.sparkContext.getCheckpointDir()
    if root is None:
        root = spark.conf.get("spark.sql.warehouse.dir")
        if not spark.sparkContext.master.startswith("local") and re.match(r"file:|/", root):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
    return root.rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared root; never reused."""
    return f"{shared_root(spark)}/duelspark/{name}-{uuid.uuid4().hex}"


@contextmanager
def few_listing_tasks(spark: SparkSession):
    """Lists many folders with a few tasks per core; by default Spark takes up to 10,000, each for a folder or two."""
    before = spark.conf.get(LISTING)
    spark.conf.set(LISTING, str(min(int(before), 4 * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(LISTING, before)


@contextmanager
def many_files(spark: SparkSession):
    """Lists by few tasks and reads some hundred small files with a task.

    By default Spark counts 4 MB for the opening of a file, so that a task gets 32 files, and a file is written of their lines.
    """
    before = spark.conf.get(OPEN_COST)
    # Given as a number or with a unit; a smaller one is kept.
    small = before.isdigit() and int(before) < FILE_COST
    if not small:
        spark.conf.set(OPEN_COST, str(FILE_COST))
    try:
        with few_listing_tasks(spark):
            yield
    finally:
        spark.conf.set(OPEN_COST, before)


def local_folder(spark: SparkSession, path: str) -> str | None:
    """The folder that ``path`` names in a file system that is mounted on all machines; None if it is in another one."""
    if not re.match(r"file:/|/", path):
        return None
    if path.startswith("/") and not spark._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///").startswith("file:"):
        return None
    return re.sub(r"^(file:)?/+", "/", path)


def writers(spark: SparkSession) -> int:
    """Tasks that write many small files. A fixed number: AQE goes by bytes and would leave all files to very few tasks."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)


#: Options of writers of many small files. Hadoop's local file system without its native library begins a `chmod` process for every
#: folder, file and checksum file; the plain one writes no checksum files. Other file systems don't heed this. File systems are
#: cached by scheme alone, so this one must not be taken from the cache, nor left there.
SMALL_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate once and go on from the files.

    Cuts lineage at a point that several branches read, survives the loss of
    executors, and lets each branch read only the columns it needs.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
