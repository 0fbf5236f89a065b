"""Display names and frequencies of entities and relations: ``(name, ent, count, index, partition)``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphprep.functions.text import extract_label
from graphprep.operators.filters import english_labels, triples_per_relation
from graphprep.operators.lookup import lookup_join

COLUMNS = ["name", "ent", "count", "index", "partition"]


def endpoint_union(coded: DataFrame) -> DataFrame:
    """``(ent_index, part)`` of both ends of each coded triple, in one scan; a self-loop gives two rows."""
    ends = F.array(
        F.struct(F.col("subj").alias("ent_index"), F.col("part_left").alias("part")),
        F.struct(F.col("obj").alias("ent_index"), F.col("part_right").alias("part")),
    )
    return coded.select(F.inline(ends))


def entity_frequency(coded: DataFrame) -> DataFrame:
    return endpoint_union(coded).groupBy("ent_index", "part").count()


def relation_frequency(coded: DataFrame) -> DataFrame:
    return coded.groupBy("rel").count()


def subject_frequency(triples: DataFrame) -> DataFrame:
    return triples.groupBy("subj").count()


def entity_names(coded: DataFrame, entities: DataFrame) -> DataFrame:
    """Each entity under its own identifier; entities without a coded triple drop out."""
    frequency = entity_frequency(coded).toDF("index", "partition", "count")
    return entities.withColumn("name", F.col("ent")).join(frequency, ["index", "partition"]).select(COLUMNS)


def relation_names(coded: DataFrame, relations: DataFrame) -> DataFrame:
    frequency = relation_frequency(coded).toDF("index", "count")
    named = relations.select("index", F.col("relation").alias("ent"), F.col("relation").alias("name"))
    return named.join(frequency, "index").withColumn("partition", F.lit(0)).select(COLUMNS)


def one_label_per_subject(triples: DataFrame, strict: bool = False) -> DataFrame:
    """``(subj, obj)``: the least English label literal of each subject."""
    return english_labels(triples, strict).groupBy("subj").agg(F.min("obj").alias("obj"))


def subject_names(triples: DataFrame, strict: bool = False) -> DataFrame:
    return one_label_per_subject(triples, strict).select(
        F.col("subj").alias("ent"), extract_label(F.col("obj")).alias("name")
    )


def label_entity_names(triples: DataFrame, entities: DataFrame, strict: bool = False) -> DataFrame:
    """Names from label triples for the entities that have one; ``count`` is the number of triples as subject.

    All three inputs have unique keys, so none of the joins is skewed.
    """
    frequency = subject_frequency(triples).withColumnRenamed("subj", "ent")
    return subject_names(triples, strict).join(entities, "ent").join(frequency, "ent").select(COLUMNS)


def label_relation_names(triples: DataFrame, relations: DataFrame, strict: bool = False) -> DataFrame:
    frequency = triples_per_relation(triples).withColumnRenamed("rel", "ent")
    known = relations.select("index", F.col("relation").alias("ent"))
    # The relations first: labels of other subjects are neither grouped nor shuffled.
    labelled = english_labels(triples, strict)
    labelled = lookup_join(labelled, known.select(F.col("ent").alias("_relation")), "subj", "_relation", "left_semi")
    named = subject_names(labelled, strict).join(known, "ent").join(frequency, "ent")
    return named.withColumn("partition", F.lit(0)).select(COLUMNS)


def unique_names(names: DataFrame, *by: str, order: str = "count") -> DataFrame:
    """One row per key (``ent`` by default, or ``partition``, ``index``): the one with the highest count.

    Ties go to the greatest remaining columns, so the choice does not depend on row order. With ``order="last"`` it is the
    last row as the table is stored, by file and row: ``names`` then need ``_file`` and ``_row`` (see
    ``tables.read_names(placed=True)``).
    """
    keys = list(by or ("ent",))
    if order not in ("count", "last"):
        raise ValueError(f"unknown order {order!r}")
    rest = [c for c in COLUMNS if c not in keys]
    first = ["count"] if order == "count" else ["_file", "_row"]
    best = names.groupBy(*keys).agg(F.max(F.struct(*first, *[c for c in rest if c not in first])).alias("best"))
    return best.select(*keys, "best.*").select(COLUMNS)


def most_frequent(names: DataFrame, n: int) -> DataFrame:
    return names.orderBy(F.desc("count"), "ent").limit(n)
