"""Sessions and intermediate tables.

Intermediate results that several stages read are written once as Parquet to the shared folder the cluster names in
``spark.checkpoint.dir``. Unlike executor-local blocks they survive the loss of executors, they cut the lineage, and
the reader gets real file sizes for its broadcast decisions.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROW = "_row"
ROW_NUMBERS = 4096
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
#: Folders of a stored table that a task writes to at once; with more of them it sorts its rows by folder.
OPEN_WRITERS = 8
_own_root: str | None = None
_written: list[str] = []


def local_session(cores: int | str = 8, shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("graphprep")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the cluster's shared folder.

    That is ``spark.checkpoint.dir``, else what ``SparkContext.setCheckpointDir`` was given. With neither, a local session
    (as in tests) gets a temporary folder, and a cluster an error: its executors do not share one.
    """
    global _own_root
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = _own_root = _own_root or tempfile.mkdtemp(prefix="graphprep-")
    path = f"{root.rstrip('/')}/graphprep/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def clear(spark: SparkSession) -> None:
    """Delete the intermediate tables of this process; results that were not stored can no longer be computed."""
    jvm = spark.sparkContext._jvm
    while _written:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def discard(spark: SparkSession, table: DataFrame, part: str = "") -> None:
    """Delete a stored table that nothing will read again, or one folder of it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table.stored_at + (f"/{part}" if part else ""))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def spread_thin(scan: DataFrame) -> DataFrame:
    """Shuffle the rows of a scan that has fewer tasks than the cluster has cores (one gzip file is one task)."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


@contextmanager
def open_writers(spark: SparkSession, files: int) -> Iterator[None]:
    """Lets a task write to that many folders at once, so that its rows need not be sorted (and spilled) by folder first."""
    before = spark.conf.get(WRITERS, None)
    if files:
        spark.conf.set(WRITERS, files)
    try:
        yield
    finally:
        if files:
            spark.conf.unset(WRITERS) if before is None else spark.conf.set(WRITERS, before)


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """What is shuffled for a table that is stored meanwhile is deleted at once, as nothing else reads it."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def stage(df: DataFrame, name: str, partition_by: tuple[str, ...] = (), row_ids: bool = False, packed: bool = False) -> DataFrame:
    """Write ``df`` once and read it back.

    ``row_ids`` stores a small running number as ``_row``. Read back from the file it is the same on every retry, so it
    is a safe source of salts even among exact copies of one row. ``packed`` stores large tables in less space, with zstd; not
    tables that may be broadcast, as Spark goes by their size as stored.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    table = df.drop(ROW)
    if row_ids:
        table = table.withColumn(ROW, (F.monotonically_increasing_id() % ROW_NUMBERS).cast("smallint"))
    writer = table.write.option("compression", "zstd") if packed else table.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with open_writers(spark, OPEN_WRITERS if partition_by else 0):
        writer.parquet(path)
    # Read by the known schema: no file has to be opened for it, and a partitioned table may be empty.
    inner = [f for f in table.schema.fields if f.name not in partition_by]
    stored = spark.read.schema(T.StructType([*inner, *[table.schema[c] for c in partition_by]])).parquet(path)
    stored.stored_at = path
    return stored
