"""Replacement of strings by dictionary ids."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphprep.operators.lookup import lookup_join, unique_join


def encode_triples(
    triples: DataFrame, entities: DataFrame, relations: DataFrame, hot: Collection[str] = (), keep: Collection[str] = ()
) -> DataFrame:
    """``(subj, obj, rel, part_left, part_right)``; triples with an entity or relation not in the dictionaries drop out.

    ``hot`` lists very frequent entities, see ``lookup.hot_keys``; the columns ``keep`` go with their triples.
    """
    known_relations = relations.select(F.col("index").alias("_rel"), "relation")
    left = entities.select(
        F.col("ent").alias("_left_ent"), F.col("index").alias("_subj"), F.col("partition").alias("part_left")
    )
    right = entities.select(
        F.col("ent").alias("_right_ent"), F.col("index").alias("_obj"), F.col("partition").alias("part_right")
    )
    coded = lookup_join(triples, known_relations, "rel", "relation").drop("rel")
    coded = unique_join(coded, left, "subj", "_left_ent", "inner", hot).drop("subj")
    coded = unique_join(coded, right, "obj", "_right_ent", "inner", hot)
    return coded.select(
        F.col("_subj").alias("subj"), F.col("_obj").alias("obj"), F.col("_rel").alias("rel"), "part_left", "part_right", *keep
    )


def dropped_triples(
    triples: DataFrame, entities: DataFrame, relations: DataFrame, hot: Collection[str] = ()
) -> DataFrame:
    """The triples ``encode_triples`` drops, with what is unknown about each."""
    known_relations = relations.select("relation", F.lit(True).alias("_rel_known"))
    left = entities.select(F.col("ent").alias("_left_ent"), F.lit(True).alias("_subj_known"))
    right = entities.select(F.col("ent").alias("_right_ent"), F.lit(True).alias("_obj_known"))
    marked = lookup_join(triples, known_relations, "rel", "relation", "left")
    marked = unique_join(marked, left, "subj", "_left_ent", "left", hot)
    marked = unique_join(marked, right, "obj", "_right_ent", "left", hot)
    unknown = F.concat_ws(
        ",", *[F.when(F.col(f"_{part}_known").isNull(), F.lit(part)) for part in ("subj", "rel", "obj")]
    )
    return marked.select("subj", "rel", "obj", unknown.alias("unknown")).where(F.col("unknown") != "")


def decode_triples(coded: DataFrame, entities: DataFrame, relations: DataFrame) -> DataFrame:
    """The inverse of ``encode_triples``."""
    left = entities.select(
        F.col("index").alias("subj"), F.col("partition").alias("part_left"), F.col("ent").alias("_subj")
    )
    right = entities.select(
        F.col("index").alias("obj"), F.col("partition").alias("part_right"), F.col("ent").alias("_obj")
    )
    known_relations = relations.select(F.col("index").alias("_rel"), F.col("relation"))
    decoded = coded.join(left, ["subj", "part_left"]).join(right, ["obj", "part_right"])
    decoded = lookup_join(decoded, known_relations, "rel", "_rel")
    return decoded.select(F.col("_subj").alias("subj"), F.col("relation").alias("rel"), F.col("_obj").alias("obj"))
