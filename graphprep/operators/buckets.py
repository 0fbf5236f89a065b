"""Bucket and dictionary statistics, and the text forms of the dictionaries that a trainer loads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FORMAT_VERSION = 1
CHUNK_ROWS = 100_000


def bucket_scan(coded: DataFrame, part_left: int, part_right: int) -> DataFrame:
    """The coded triples of one bucket; on a written dataset only that bucket's directory is read."""
    return coded.where((F.col("part_left") == part_left) & (F.col("part_right") == part_right))


def bucket_counts(coded: DataFrame, partitions: int) -> DataFrame:
    """``(part_left, part_right, count)`` for every cell of the grid, empty ones with 0."""
    spark = coded.sparkSession
    cells = spark.range(partitions * partitions).select(
        F.expr(f"cast(id div {partitions} as int)").alias("part_left"),
        F.expr(f"cast(id % {partitions} as int)").alias("part_right"),
    )
    counts = coded.groupBy("part_left", "part_right").count()
    return cells.join(counts, ["part_left", "part_right"], "left").fillna(0, ["count"])


def bucket_export(coded: DataFrame) -> DataFrame:
    """The edge columns a trainer reads, by name: ``lhs``, ``rhs``, ``rel``."""
    return coded.select(
        F.col("subj").cast("int").alias("lhs"),
        F.col("obj").cast("int").alias("rhs"),
        F.col("rel").cast("int").alias("rel"),
        "part_left",
        "part_right",
    )


def manifest(coded: DataFrame, partitions: int) -> DataFrame:
    return bucket_counts(coded, partitions).withColumn("format_version", F.lit(FORMAT_VERSION))


def name_list(dictionary: DataFrame, key: str, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``(partition, first, names)``: arrays of names in index order, the first one having index ``first``.

    Indexes are dense, so an array never holds more than ``chunk_rows`` names; the arrays of a partition put one after
    the other are its whole list.
    """
    rows = dictionary if "partition" in dictionary.columns else dictionary.withColumn("partition", F.lit(0))
    first = (F.floor(F.col("index") / F.lit(chunk_rows)) * chunk_rows).cast("int")
    gathered = rows.groupBy("partition", first.alias("first")).agg(
        F.array_sort(F.collect_list(F.struct("index", F.col(key).alias("name")))).alias("members")
    )
    return gathered.select("partition", "first", F.col("members.name").alias("names"))


def entity_counts(entities: DataFrame) -> DataFrame:
    return entities.groupBy("partition").agg(F.count("ent").alias("count"))


def relation_count(relations: DataFrame) -> DataFrame:
    return relations.agg(F.count("relation").alias("count"))
