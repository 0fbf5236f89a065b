"""Parquet tables with their declared schemas; partition columns are discovered from the directories."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphprep import schemas


def triples_from_rows(spark: SparkSession, rows: Iterable[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(list(rows), schemas.TRIPLE)


def read_triples(spark: SparkSession, path: str) -> DataFrame:
    return schemas.conform(spark.read.parquet(path), schemas.TRIPLE)


def read_entities(spark: SparkSession, path: str, partition: int | None = None) -> DataFrame:
    """The entity dictionary; with ``partition`` only that directory is read."""
    table = schemas.conform(spark.read.parquet(path), schemas.ENTITY)
    return table if partition is None else table.where(F.col("partition") == partition)


def read_relations(spark: SparkSession, path: str) -> DataFrame:
    return schemas.conform(spark.read.parquet(path), schemas.RELATION)


def read_coded(spark: SparkSession, path: str) -> DataFrame:
    return schemas.conform(spark.read.parquet(path), schemas.CODED)


def read_names(spark: SparkSession, path: str, placed: bool = False) -> DataFrame:
    """The names table; ``placed`` adds the name of each row's file and its place there, as ``_file`` and ``_row``."""
    table = spark.read.parquet(path)
    if not placed:
        return schemas.conform(table, schemas.NAMES)
    where = [F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row")]
    return table.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.NAMES.fields] + where)


def check_embeddings(embeddings: DataFrame, dimension: int | None = None) -> DataFrame:
    """Fail on a vector whose dimension differs from ``dimension`` (by default that of some first row)."""
    table = schemas.conform(embeddings, schemas.EMBEDDING)
    if dimension is None:
        row = table.select(F.size("embedding")).first()
        dimension = row[0] if row else 0
    error = F.raise_error(F.concat(F.lit("dimension is not "), F.lit(dimension), F.lit(": "), F.size("embedding")))
    vector = F.when(F.size("embedding") == dimension, F.col("embedding")).otherwise(error)
    return table.withColumn("embedding", vector)


def read_embeddings(spark: SparkSession, path: str, dimension: int | None = None) -> DataFrame:
    return check_embeddings(spark.read.parquet(path), dimension)


class ByNorm(NamedTuple):
    """Embeddings stored by norm: the longest ones of each partition, and the rest; both with their ``norm``."""

    head: DataFrame
    rest: DataFrame

    @property
    def all(self) -> DataFrame:
        return self.head.unionByName(self.rest).drop("norm")


def read_by_norm(spark: SparkSession, path: str) -> ByNorm:
    """What ``sinks.write_by_norm`` has written."""
    return ByNorm(*(schemas.conform(spark.read.parquet(f"{path}/{part}"), schemas.NORMED) for part in ("head", "rest")))


def read_operators(spark: SparkSession, path: str, kind: str | None = None) -> DataFrame:
    """Relation operators of both sides, all kinds or one."""
    table = schemas.conform(spark.read.parquet(path), schemas.OPERATOR)
    return table if kind is None else table.where(F.col("kind") == kind)
