"""JSON dictionaries and label maps.

A document in a file is read in byte ranges, by any number of tasks (``read_entity_ids`` and so on; see ``json_ranges``).
A document that is a value of a table is one row ``value``; an optional column ``first`` gives the id of its first entry, so
that a list can come in several documents; without it there may be one only. Long lists can also be stored as JSON rows
``first, names`` (see ``buckets.name_list``). A malformed document is an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from graphprep.sources import json_ranges

DICTIONARY = "entities struct<all: array<string>>, relations array<string>"


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``document, value``: one row per file, named by it."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("document"), "value")


def read_lists(spark: SparkSession, path: str) -> DataFrame:
    """``(id, uri)`` from JSON rows ``{first, names}``."""
    rows = spark.read.schema("first bigint, names array<string>").option("mode", "FAILFAST").json(path)
    listed = rows.select("first", F.posexplode("names").alias("pos", "uri"))
    return listed.select((F.col("first") + F.col("pos")).cast("int").alias("id"), "uri")


def read_label_rows(spark: SparkSession, path: str) -> DataFrame:
    """``(uri, label)`` from JSON rows of these two fields, one row per uri."""
    return spark.read.schema("uri string, label string").option("mode", "FAILFAST").json(path)


def _parsed(kind: str) -> Column:
    return F.from_json("value", kind, {"mode": "FAILFAST"})


def _ids(documents: DataFrame, names: Column) -> DataFrame:
    if "first" in documents.columns:
        first = F.col("first")
    elif documents.select("value").limit(2).count() > 1:
        raise ValueError("several documents need a column 'first' with the id of each one's first entry")
    else:
        first = F.lit(0)
    names = F.coalesce(names, F.raise_error(F.lit("the document has no such list")).cast("array<string>"))
    listed = documents.select(first.alias("first"), F.posexplode(names).alias("pos", "uri"))
    return listed.select((F.col("first") + F.col("pos")).cast("int").alias("id"), "uri")


def entity_ids(documents: DataFrame) -> DataFrame:
    """``(id, uri)`` from ``{"entities": {"all": [...]}}``; the place in the list is the id."""
    return _ids(documents, _parsed(DICTIONARY)["entities"]["all"])


def relation_ids(documents: DataFrame) -> DataFrame:
    """``(id, uri)`` from ``{"relations": [...]}``."""
    return _ids(documents, _parsed(DICTIONARY)["relations"])


def _placed(entries: DataFrame) -> DataFrame:
    return entries.select(F.col("pos").cast("int").alias("id"), F.col("value").alias("uri"))


def read_entity_ids(spark: SparkSession, path: str) -> DataFrame:
    """``entity_ids`` of the document in a file of any size."""
    return _placed(json_ranges.read_list(spark, path, "entities", "all"))


def read_relation_ids(spark: SparkSession, path: str) -> DataFrame:
    """``relation_ids`` of the document in a file of any size."""
    return _placed(json_ranges.read_list(spark, path, "relations"))


def ids_by_uri(ids: DataFrame) -> DataFrame:
    """``(uri, id)``; a repeated uri keeps its last id."""
    return ids.groupBy("uri").agg(F.max("id").alias("id"))


def label_map(documents: DataFrame) -> DataFrame:
    """``(uri, label)`` from ``{uri: label}``, one row per uri: the last one by ``document`` (if given) and position."""
    order = F.col("document").cast("string") if "document" in documents.columns else F.lit("")
    entries = F.map_entries(_parsed("map<string, string>"))
    placed = documents.select(order.alias("document"), F.posexplode(entries).alias("pos", "entry"))
    last = F.max(F.struct("document", "pos", F.col("entry")["value"].alias("label")))
    return placed.groupBy(F.col("entry")["key"].alias("uri")).agg(last.alias("last")).select("uri", F.col("last")["label"].alias("label"))


def read_label_map(spark: SparkSession, path: str) -> DataFrame:
    """``label_map`` of the documents in files of any size, the last one by path and position."""
    last = F.max(F.struct("document", "pos", F.col("value").alias("label")))
    entries = json_ranges.read_map(spark, path)
    return entries.groupBy(F.col("key").alias("uri")).agg(last.alias("last")).select("uri", F.col("last")["label"].alias("label"))


def listed_names(lists: DataFrame) -> DataFrame:
    """``(partition, index, name)`` from the rows of ``buckets.name_list``."""
    entries = lists.select("partition", "first", F.posexplode("names").alias("pos", "name"))
    return entries.select("partition", (F.col("first") + F.col("pos")).cast("int").alias("index"), "name")
