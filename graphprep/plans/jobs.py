"""The jobs a user runs: import, dataset creation, names, export, neighbour and name queries over stored tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphprep.functions.vectors import COMPLEX
from graphprep.operators import dictionary, encode, filters, name_index, names, search, splits
from graphprep.operators.knn import knn
from graphprep.operators.lookup import hot_keys
from graphprep.operators.name_index import NameIndex
from graphprep.sources import documents, sinks, tables, versions
from graphprep.sources.text import read_triple_text
from graphprep.workspace import spread_thin, stage


@dataclass(frozen=True)
class Layout:
    """Paths of a dataset."""

    root: str

    @property
    def entities(self) -> str:
        return f"{self.root}/entities"

    @property
    def relations(self) -> str:
        return f"{self.root}/relations"

    @property
    def entity_names(self) -> str:
        return f"{self.root}/entity_names"

    @property
    def relation_names(self) -> str:
        return f"{self.root}/relations_names"

    def split(self, name: str) -> str:
        return f"{self.root}/{name}"


def import_triples(
    spark: SparkSession, path: str, min_count: int = filters.MIN_COUNT, mode: str = "failfast"
) -> DataFrame:
    """Raw text to filtered triples. The parsed text is written once: counting and filtering read it three times."""
    raw = stage(spread_thin(read_triple_text(spark, path, mode)), "raw", row_ids=True, packed=True)
    return filters.filter_min_count(raw, min_count)


def write_entity_dictionary(triples: DataFrame, partitions: int, path: str) -> None:
    sinks.write_entities(dictionary.entity_dictionary(triples, partitions), path)


def write_relation_dictionary(triples: DataFrame, path: str) -> None:
    sinks.write_relations(dictionary.relation_dictionary(triples), path)


def write_coded_triples(
    triples: DataFrame, relations_path: str, entities_path: str, path: str, hot: list[str] | None = None
) -> None:
    """Encode with dictionaries that are already stored, and bucket."""
    spark = triples.sparkSession
    entities = tables.read_entities(spark, entities_path)
    relations = tables.read_relations(spark, relations_path)
    hot = hot_keys(triples, "subj", "obj") if hot is None else hot
    sinks.write_coded(encode.encode_triples(triples, entities, relations, hot), path)


def build_dataset(
    triples: DataFrame, partitions: int, relations_path: str, entities_path: str, path: str, hot: list[str] | None = None
) -> None:
    """Store the dictionaries of ``triples``, then encode with them."""
    write_entity_dictionary(triples, partitions, entities_path)
    write_relation_dictionary(triples, relations_path)
    write_coded_triples(triples, relations_path, entities_path, path, hot)


def create_dataset(triples: DataFrame, partitions: int, root: str, method: str = "hash") -> Layout:
    """Split, build the dictionaries on train, and encode all three splits with them.

    The split triples are written once, so the input's lineage runs once whatever it costs. All splits are encoded and written
    together, so the dictionary is shuffled for them once.
    """
    layout = Layout(root)
    staged = stage(splits.split_triples(triples, method), "splits", partition_by=("split",), row_ids=True, packed=True)
    hot = hot_keys(staged, "subj", "obj")

    train = staged.where(F.col("split") == "train")
    write_entity_dictionary(train, partitions, layout.entities)
    write_relation_dictionary(train, layout.relations)
    spark = triples.sparkSession
    entities, relations = tables.read_entities(spark, layout.entities), tables.read_relations(spark, layout.relations)
    # A small number goes with each triple, not the split's name.
    names_ = F.array(*[F.lit(name) for name in splits.WEIGHTS])
    numbered = staged.withColumn("split", F.array_position(names_, F.col("split")).cast("tinyint"))
    coded = encode.encode_triples(numbered, entities, relations, hot, keep=("split",))
    sinks.write_coded_splits(coded, {name: layout.split(name) for name in splits.WEIGHTS})
    return layout


def publish_dataset(triples: DataFrame, partitions: int, root: str, method: str = "hash") -> Layout:
    """``create_dataset`` as a new version under ``root``; readers change over to all of its tables at once."""
    spark = triples.sparkSession
    return Layout(versions.publish(spark, root, lambda path: create_dataset(triples, partitions, path, method)))


def current_dataset(spark: SparkSession, root: str) -> Layout:
    """The dataset that ``publish_dataset`` made last."""
    return Layout(versions.current(spark, root))


def generate_entity_names(coded: DataFrame, entities_path: str, path: str) -> None:
    entities = tables.read_entities(coded.sparkSession, entities_path)
    sinks.write_names(names.entity_names(coded, entities), path)


def generate_relation_names(coded: DataFrame, relations_path: str, path: str) -> None:
    relations = tables.read_relations(coded.sparkSession, relations_path)
    sinks.write_names(names.relation_names(coded, relations), path, files=1)


def generate_names(spark: SparkSession, root: str) -> None:
    """Names of a dataset's entities and relations from its train split."""
    layout = Layout(root)
    coded = tables.read_coded(spark, layout.split("train"))
    generate_entity_names(coded, layout.entities, layout.entity_names)
    generate_relation_names(coded, layout.relations, layout.relation_names)


def generate_label_names(
    triples: DataFrame,
    entities_path: str,
    relations_path: str,
    entity_names_path: str,
    relation_names_path: str,
    strict: bool = False,
) -> None:
    """Names from the label triples of the raw graph."""
    spark = triples.sparkSession
    entities = tables.read_entities(spark, entities_path)
    relations = tables.read_relations(spark, relations_path)
    sinks.write_names(names.label_entity_names(triples, entities, strict), entity_names_path)
    sinks.write_names(names.label_relation_names(triples, relations, strict), relation_names_path, files=1)


def export_dataset(
    spark: SparkSession,
    edges_in: str,
    partitions: int,
    edges_out: str,
    entities_in: str | None = None,
    relations_in: str | None = None,
    metadata_out: str | None = None,
) -> None:
    """Trainer form of one split. Without ``metadata_out`` no name lists are written, nor for a dictionary not given."""
    sinks.write_buckets(tables.read_coded(spark, edges_in), partitions, edges_out, by_bucket=True)
    if metadata_out is None:
        return
    if entities_in is not None:
        sinks.write_entity_lists(tables.read_entities(spark, entities_in), metadata_out)
    if relations_in is not None:
        sinks.write_relation_lists(tables.read_relations(spark, relations_in), metadata_out)


def _one_name_each(spark: SparkSession, path: str, order: str = "count") -> DataFrame:
    return names.unique_names(tables.read_names(spark, path, placed=order == "last"), order=order)


def load_names(spark: SparkSession, path: str, order: str = "count") -> tuple[DataFrame, DataFrame]:
    """A stored names table, one row per uri (the most frequent, or the ``last`` one stored), and its word index."""
    table = _one_name_each(spark, path, order)
    return table, search.word_index(table)


def index_names(spark: SparkSession, names_path: str, index_path: str, order: str = "count") -> NameIndex:
    """Store the search index of a stored names table, for ``search_entities``."""
    return name_index.write_word_index(_one_name_each(spark, names_path, order), index_path)


def index_labels(spark: SparkSession, labels_path: str, index_path: str, rows: bool = False) -> NameIndex:
    """Store the search index of a JSON label map, or of JSON rows ``uri, label``, for ``search_entity_labels``."""
    labels = documents.read_label_rows(spark, labels_path) if rows else documents.read_label_map(spark, labels_path)
    return name_index.write_label_index(labels, index_path)


def knn_partitioned(
    requests: DataFrame,
    embeddings_path: str,
    operators_path: str,
    entity_names_path: str,
    relation_names_path: str,
    kind: str = COMPLEX,
    by_norm: bool = False,
    **options,
) -> DataFrame:
    """Neighbours over partitioned embeddings; unnamed entities are left out. ``kind`` is that of the operators.

    ``by_norm`` says that the embeddings were stored by ``sinks.write_by_norm``.
    """
    spark = requests.sparkSession
    read = tables.read_by_norm if by_norm else tables.read_embeddings
    return knn(
        requests,
        read(spark, embeddings_path),
        tables.read_operators(spark, operators_path, kind),
        names.unique_names(tables.read_names(spark, entity_names_path)),
        names.unique_names(tables.read_names(spark, relation_names_path)),
        **options,
    )


def knn_single(
    requests: DataFrame,
    embeddings_path: str,
    operators_path: str,
    dictionary_path: str,
    labels_path: str,
    relations_path: str | None = None,
    kind: str = COMPLEX,
    **options,
) -> DataFrame:
    """Neighbours over one index whose uris come from a JSON dictionary and whose names from a JSON label map.

    With ``relations_path`` the three are JSON rows instead of documents: ``first, names`` for the entities under
    ``dictionary_path`` and for the relations, ``uri, label`` for the labels.
    """
    spark = requests.sparkSession
    if relations_path is None:
        entities, relations = documents.read_entity_ids(spark, dictionary_path), documents.read_relation_ids(spark, dictionary_path)
        labels = documents.read_label_map(spark, labels_path)
    else:
        entities, relations = documents.read_lists(spark, dictionary_path), documents.read_lists(spark, relations_path)
        labels = documents.read_label_rows(spark, labels_path)
    return knn_one_index(
        requests,
        tables.read_embeddings(spark, embeddings_path),
        tables.read_operators(spark, operators_path, kind),
        entities,
        relations,
        labels,
        **options,
    )


def knn_one_index(
    requests: DataFrame,
    embeddings: DataFrame,
    operators: DataFrame,
    entity_ids: DataFrame,
    relation_ids: DataFrame,
    labels: DataFrame,
    on_missing: str = "error",
    **options,
) -> DataFrame:
    """``knn`` without partitions: ``entity_ids`` and ``relation_ids`` are ``(id, uri)``, ``labels`` ``(uri, label)``."""
    named = entity_ids.join(labels, "uri", "left").select(
        F.col("uri").alias("ent"), F.col("label").alias("name"), F.col("id").alias("index"), F.lit(0).alias("partition")
    )
    by_uri = documents.ids_by_uri(entity_ids).select(
        F.col("uri").alias("ent"), F.col("id").alias("index"), F.lit(0).alias("partition")
    )
    relations = documents.ids_by_uri(relation_ids).select(F.col("uri").alias("ent"), F.col("id").alias("index"))
    return knn(
        requests,
        embeddings,
        operators,
        named,
        relations,
        partitioned=False,
        on_missing=on_missing,
        entity_lookup=by_uri,
        **options,
    )


def search_entities(requests: DataFrame, names_path: str | None = None, index_path: str | None = None) -> DataFrame:
    """Paged word search over a stored names table, of entities or of relations, or over its stored index."""
    spark = requests.sparkSession
    if index_path is not None:
        return search.word_search(requests, name_index.read_index(spark, index_path, name_index.WORD))
    return search.word_search(requests, _one_name_each(spark, names_path))


search_relations = search_entities


def search_entity_labels(requests: DataFrame, labels_path: str | None = None, rows: bool = False, index_path: str | None = None) -> DataFrame:
    """Paged substring search over a JSON label map, over JSON rows ``uri, label``, or over their stored index."""
    spark = requests.sparkSession
    if index_path is not None:
        return search.substring_search(requests, name_index.read_index(spark, index_path, name_index.GRAMS))
    labels = documents.read_label_rows(spark, labels_path) if rows else documents.read_label_map(spark, labels_path)
    return search.substring_search(requests, labels)


def search_relation_uris(requests: DataFrame, names_path: str) -> DataFrame:
    """Paged substring search over the relation identifiers themselves."""
    table = tables.read_names(requests.sparkSession, names_path)
    return search.substring_search(requests, table.select(F.col("ent").alias("uri"), F.col("ent").alias("label")).distinct())
