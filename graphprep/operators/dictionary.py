"""Integer dictionaries for entities and relations.

Ids are a pure function of the set of keys, so a recomputed dictionary equals the first one. A key's MD5 digest decides
its partition (first 32 bits) and its place there (the other digits). Each partition is numbered in 256 slices by the
next digest byte; a slice's first id is the prefix sum of the slice sizes. An index is a 32-bit integer, so a slice has
at most about eight million keys however large the graph is, and no task ever sorts more than that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graphprep.functions.hashing import digest, modulo
from graphprep.operators.filters import endpoints

SLICES = 256
MAX_INDEX = 2**31 - 1


def distinct_entities(triples: DataFrame) -> DataFrame:
    return endpoints(triples).distinct()


def distinct_relations(triples: DataFrame) -> DataFrame:
    return triples.select("rel").distinct()


def dense_index(keys: DataFrame, key: str, partitions: int) -> DataFrame:
    """``(index, key, partition)`` with ``index`` dense from 0 in each partition. ``keys`` must be distinct.

    The numbering and the slice sizes both start from the same distinct keys, so the shuffle behind those is run once
    and reused. For that the derived columns must not be nullable: null checks for the join would otherwise be pushed
    below the distinct, into one of the two branches, and hash every row there.
    """
    if partitions < 1:
        raise ValueError("partitions must be positive")
    digits = digest(F.coalesce(key, F.lit("")))
    hashed = keys.select(key, digits.alias("_digest"))
    placed = hashed.select(
        key,
        F.coalesce(modulo(F.col("_digest"), partitions), F.lit(0)).alias("partition"),
        F.substring("_digest", 9, 2).alias("_slice"),
    )
    slices = Window.partitionBy("partition").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("partition", "_slice")
        .count()
        .select("partition", "_slice", F.coalesce(F.sum("count").over(slices), F.lit(0)).alias("_start"))
    )
    if partitions * SLICES <= 100_000:
        starts = F.broadcast(starts)
    # The digits of the order do not travel: they are made again from the key where the slice is sorted.
    dealt = placed.repartition("partition", "_slice").withColumn("_order", F.substring(digits, 9, 24))
    place = F.row_number().over(Window.partitionBy("partition", "_slice").orderBy("_order", key))
    position = F.col("_start") + F.col("_place") - 1
    index = F.when(position <= MAX_INDEX, position).otherwise(
        F.raise_error(F.lit("a partition holds more than 2^31 keys; use more partitions"))
    )
    return (
        dealt.withColumn("_place", place)
        .join(starts, ["partition", "_slice"])
        .select(index.cast("int").alias("index"), key, "partition")
    )


def entity_dictionary(triples: DataFrame, partitions: int) -> DataFrame:
    """``(index, ent, partition)`` over both ends of the triples."""
    return dense_index(distinct_entities(triples), "ent", partitions)


def relation_dictionary(triples: DataFrame) -> DataFrame:
    """``(index, relation)``."""
    relations = distinct_relations(triples).withColumnRenamed("rel", "relation")
    return dense_index(relations, "relation", 1).select("index", "relation")
