"""The query catalogue: one entry per operator, over the sample graph of ``sample``."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from graphprep.functions import text, vectors
from graphprep.operators import buckets, dictionary, encode, evaluate, filters, names, search, splits
from graphprep.operators.knn import knn
from graphprep.operators.lookup import hot_keys
from graphprep.plans import jobs, sample
from graphprep.plans.jobs import knn_one_index
from graphprep.plans.sample import PARTITIONS
from graphprep.sources import documents, sinks, tables
from graphprep.sources.text import parse_triples as parse_text
from graphprep.workspace import ROW, scratch_path, spread_thin, stage

CHUNK = 1000
NEGATIVES = 500

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(column: str | Column) -> Column:
    return F.round(column, 6)


class Dataset(NamedTuple):
    train: DataFrame
    heldout: DataFrame
    entities: DataFrame
    relations: DataFrame
    hot: list[str]

    @property
    def coded(self) -> DataFrame:
        return encode.encode_triples(self.train, self.entities, self.relations, self.hot)


def stored_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(spread_thin(sample.triples(spark, sf_dir)), "raw", row_ids=True, packed=True)


def stored_raw_graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The raw graph, and what of it is no label; stored once, with the labels in a folder of their own."""
    raw = sample.raw_graph(spark, sf_dir).withColumn("label", (F.col("rel") == text.RDFS_LABEL).cast("int"))
    stored = stage(spread_thin(raw), "raw", partition_by=("label",), row_ids=True, packed=True)
    return stored.drop("label", ROW), stored.where("label = 0").drop("label")


def filtered(spark: SparkSession, sf_dir: str, graph: DataFrame | None = None) -> DataFrame:
    """As the import job does it: the graph is written once, then counted and filtered."""
    return filters.filter_min_count(stored_graph(spark, sf_dir) if graph is None else graph)


def split(spark: SparkSession, sf_dir: str, graph: DataFrame | None = None) -> DataFrame:
    """The filtered graph with its splits, written once as every job does."""
    return stage(splits.split_triples(filtered(spark, sf_dir, graph)), "splits", partition_by=("split",), row_ids=True, packed=True)


def train(spark: SparkSession, sf_dir: str, graph: DataFrame | None = None) -> DataFrame:
    return split(spark, sf_dir, graph).where(F.col("split") == "train")


def dataset(spark: SparkSession, sf_dir: str, graph: DataFrame | None = None) -> Dataset:
    staged = split(spark, sf_dir, graph)
    learned = staged.where(F.col("split") == "train")
    return Dataset(
        learned,
        staged.where(F.col("split") != "train"),
        stage(dictionary.entity_dictionary(learned, PARTITIONS), "entities"),
        stage(dictionary.relation_dictionary(learned), "relations"),
        hot_keys(staged, "subj", "obj"),
    )


# Sources


@query
def parse_triples(spark, sf_dir):
    return parse_text(sample.text_lines(spark, sf_dir), mode="dropmalformed")


@query
def scan_triples(spark, sf_dir):
    """Triples from a Parquet table with further columns."""
    path = scratch_path(spark, "triples")
    sample.triples(spark, sf_dir).withColumn("more", F.lit(1)).write.parquet(path)
    return tables.read_triples(spark, path)


@query
def memory_triples(spark, sf_dir):
    """Triples held by the program, here those of the nations."""
    rows = sample.triples(spark, sf_dir).where(F.col("subj").startswith("/nation/")).collect()
    return tables.triples_from_rows(spark, [tuple(row) for row in rows])


@query
def scan_embeddings(spark, sf_dir):
    checked = tables.check_embeddings(sample.embeddings(spark, sf_dir))
    vector = F.col("embedding")
    return checked.select(
        "partition",
        "index",
        F.size(vector).alias("dimension"),
        rounded(vectors.inner_product(vector, vector)).alias("norm"),
    )


def _dictionary_documents(lists: DataFrame, entities: bool) -> DataFrame:
    names_ = F.col("names")
    body = F.struct(F.struct(names_.alias("all")).alias("entities")) if entities else F.struct(names_.alias("relations"))
    return lists.select("first", F.to_json(body).alias("value"))


@query
def dict_json_entities(spark, sf_dir):
    entities = dictionary.entity_dictionary(sample.triples(spark, sf_dir), 1)
    ids = documents.entity_ids(_dictionary_documents(buckets.name_list(entities, "ent", CHUNK), True))
    return documents.ids_by_uri(ids)


@query
def dict_json_relations(spark, sf_dir):
    relations = dictionary.relation_dictionary(sample.triples(spark, sf_dir))
    ids = documents.relation_ids(_dictionary_documents(buckets.name_list(relations, "relation", CHUNK), False))
    return documents.ids_by_uri(ids)


@query
def label_map_json(spark, sf_dir):
    named = sample.part_names(spark, sf_dir)
    # One label map per thousand parts, so no document grows with the table.
    chunk = F.floor(F.col("index") / CHUNK)
    entries = F.map_from_entries(F.collect_list(F.struct("ent", "name")))
    return documents.label_map(named.groupBy(chunk).agg(F.to_json(entries).alias("value")).select("value"))


@query
def dict_json_repeated(spark, sf_dir):
    """A list that names each region once for each of its nations: the last place counts."""
    nation = sample.table(spark, sf_dir, "nation")
    entry = F.struct("n_nationkey", F.concat(F.lit("/region/"), "n_regionkey").alias("uri"))
    names_ = F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["uri"])
    document = nation.agg(F.to_json(F.struct(F.struct(names_.alias("all")).alias("entities"))).alias("value"))
    return documents.ids_by_uri(documents.entity_ids(document))


@query
def dict_json_ranges(spark, sf_dir):
    """One written document with all parts as entities, read in byte ranges."""
    path = scratch_path(spark, "dictionary")
    parts = sample.table(spark, sf_dir, "part")
    entry = F.struct("p_partkey", F.concat(F.lit("/part, "), "p_partkey", F.lit('/"'), "p_name").alias("uri"))
    names_ = F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["uri"])
    parts.agg(F.to_json(F.struct(F.struct(names_.alias("all")).alias("entities"))).alias("value")).coalesce(1).write.text(path)
    return documents.ids_by_uri(documents.read_entity_ids(spark, path))


@query
def label_map_repeated(spark, sf_dir):
    """Label maps of a thousand parts each that name each brand many times: the last label counts."""
    parts = sample.table(spark, sf_dir, "part")
    entry = F.struct("p_partkey", F.concat_ws(":", F.to_json(F.array("p_brand")).substr(F.lit(2), F.length("p_brand") + 2), F.to_json(F.array("p_name")).substr(F.lit(2), F.length("p_name") + 2)).alias("text"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["text"]), ",")
    chunk = F.lpad(F.floor(F.col("p_partkey") / CHUNK).cast("string"), 12, "0")
    maps = parts.groupBy(chunk.alias("document")).agg(F.concat(F.lit("{"), body, F.lit("}")).alias("value"))
    return documents.label_map(maps)


@query
def dict_json_files(spark, sf_dir):
    """Names written as JSON rows and read back."""
    path = scratch_path(spark, "lists")
    entities = dictionary.entity_dictionary(sample.triples(spark, sf_dir), 1)
    buckets.name_list(entities, "ent", CHUNK).select("first", "names").write.json(path)
    return documents.ids_by_uri(documents.read_lists(spark, path))


# Counting and filtering


@query
def endpoints(spark, sf_dir):
    return filters.endpoints(sample.triples(spark, sf_dir))


@query
def entity_min_count(spark, sf_dir):
    return filters.frequent_entities(sample.triples(spark, sf_dir))


@query
def relation_min_count(spark, sf_dir):
    return filters.frequent_relations(sample.triples(spark, sf_dir))


@query
def relation_membership(spark, sf_dir):
    graph = sample.triples(spark, sf_dir)
    return filters.keep_relations(graph, filters.frequent_relations(graph))


@query
def min_count_filter(spark, sf_dir):
    return filtered(spark, sf_dir).drop(ROW)


@query
def english_labels(spark, sf_dir):
    return filters.english_labels(sample.labels(spark, sf_dir))


@query
def english_labels_strict(spark, sf_dir):
    return filters.english_labels(sample.labels(spark, sf_dir), strict=True)


@query
def extract_label(spark, sf_dir):
    return sample.labels(spark, sf_dir).select("subj", text.extract_label(F.col("obj")).alias("name"))


# Dictionaries, split, encoding


@query
def distinct_entities(spark, sf_dir):
    return dictionary.distinct_entities(sample.triples(spark, sf_dir))


@query
def distinct_relations(spark, sf_dir):
    return dictionary.distinct_relations(sample.triples(spark, sf_dir))


@query
def split_hash(spark, sf_dir):
    return splits.split_triples(sample.triples(spark, sf_dir))


@query
def split_random(spark, sf_dir):
    """Copies of each triple over all splits, and whether the splits' sizes are what such draws give."""
    drawn = stage(splits.split_triples(sample.triples(spark, sf_dir), method="random"), "random")
    sizes = {r["split"]: r["count"] for r in drawn.groupBy("split").count().collect()}
    n = sum(sizes.values())
    near = [abs(sizes.get(s, 0) - w * n) <= 5 * (w * (1 - w) * n) ** 0.5 for s, w in splits.WEIGHTS.items()]
    return drawn.groupBy("subj", "rel", "obj").agg(F.count("*").alias("copies")).withColumn("within", F.lit(all(near)))


@query
def entity_dictionary(spark, sf_dir):
    return dictionary.entity_dictionary(train(spark, sf_dir), PARTITIONS)


@query
def relation_dictionary(spark, sf_dir):
    return dictionary.relation_dictionary(train(spark, sf_dir))


@query
def encode_triples(spark, sf_dir):
    return dataset(spark, sf_dir).coded


@query
def encode_heldout(spark, sf_dir):
    data = dataset(spark, sf_dir)
    return encode.encode_triples(data.heldout, data.entities, data.relations, data.hot)


@query
def dropped_triples(spark, sf_dir):
    data = dataset(spark, sf_dir)
    return encode.dropped_triples(data.heldout, data.entities, data.relations, data.hot)


@query
def bucket_scan(spark, sf_dir):
    """One bucket of the stored table: the other directories are not read."""
    coded = tables.read_coded(spark, created(spark, sf_dir).split("train"))
    return buckets.bucket_scan(coded, 0, 1)


# The stored layout


def created(spark: SparkSession, sf_dir: str) -> jobs.Layout:
    return jobs.create_dataset(filtered(spark, sf_dir).drop(ROW), PARTITIONS, scratch_path(spark, "dataset"))


@query
def import_text(spark, sf_dir):
    """Tab-separated files, half of whose lines are cut short, to filtered triples."""
    path = scratch_path(spark, "text")
    sample.text_lines(spark, sf_dir).write.text(path)
    return jobs.import_triples(spark, path, mode="dropmalformed").drop(ROW)


@query
def dataset_roundtrip(spark, sf_dir):
    """The three stored splits, decoded by the stored dictionaries."""
    layout = created(spark, sf_dir)
    entities = tables.read_entities(spark, layout.entities)
    relations = tables.read_relations(spark, layout.relations)
    left = entities.select(F.col("ent").alias("subj"), F.col("index").alias("l"), F.col("partition").alias("part_left"))
    right = entities.select(F.col("ent").alias("obj"), F.col("index").alias("r"), F.col("partition").alias("part_right"))
    between = relations.select(F.col("relation").alias("rel"), F.col("index").alias("b"))

    def decoded(split: str) -> DataFrame:
        coded = tables.read_coded(spark, layout.split(split)).toDF("l", "r", "b", "part_left", "part_right")
        found = coded.join(left, ["l", "part_left"]).join(right, ["r", "part_right"]).join(between, "b")
        return found.select(F.lit(split).alias("split"), "subj", "rel", "obj")

    return decoded("train").unionByName(decoded("valid")).unionByName(decoded("test"))


@query
def entity_partition_scan(spark, sf_dir):
    return tables.read_entities(spark, created(spark, sf_dir).entities, partition=2)


@query
def stored_names(spark, sf_dir):
    layout = created(spark, sf_dir)
    jobs.generate_names(spark, layout.root)
    of = lambda path, kind: tables.read_names(spark, path).withColumn("kind", F.lit(kind))
    return of(layout.entity_names, "entity").unionByName(of(layout.relation_names, "relation"))


def _exported(spark: SparkSession, sf_dir: str, metadata: bool) -> tuple[str, str]:
    layout = created(spark, sf_dir)
    out, lists = scratch_path(spark, "export"), scratch_path(spark, "export-lists")
    given = (layout.entities, layout.relations, lists) if metadata else (layout.entities, layout.relations)
    jobs.export_dataset(spark, layout.split("train"), PARTITIONS, out, *given)
    return out, lists


@query
def stored_export(spark, sf_dir):
    """Exported edges with what the manifest says of their bucket and the names in the exported lists."""
    out, lists = _exported(spark, sf_dir, True)
    edges = spark.read.parquet(f"{out}/edges")
    manifest = spark.read.schema("part_left int, part_right int, count bigint, format_version int").json(f"{out}/manifest")
    listed = documents.listed_names(spark.read.schema("partition int, first int, names array<string>").json(f"{lists}/entity_names_all"))
    heads = listed.select(F.col("partition").alias("part_left"), F.col("index").alias("lhs"), F.col("name").alias("head"))
    return edges.join(heads, ["part_left", "lhs"]).join(manifest, ["part_left", "part_right"])


@query
def export_without_metadata(spark, sf_dir):
    """Edges by bucket, and whether lists were written, which were not asked for."""
    out, lists = _exported(spark, sf_dir, False)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(lists)
    there = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    return spark.read.parquet(f"{out}/edges").groupBy("part_left", "part_right").count().withColumn("lists", F.lit(there))


@query
def bucket_export(spark, sf_dir):
    return buckets.bucket_export(dataset(spark, sf_dir).coded)


@query
def bucket_counts(spark, sf_dir):
    return buckets.manifest(dataset(spark, sf_dir).coded, PARTITIONS)


@query
def entity_name_list(spark, sf_dir):
    lists = buckets.name_list(dictionary.entity_dictionary(train(spark, sf_dir), PARTITIONS), "ent", CHUNK)
    return lists.select("partition", "first", F.to_json("names").alias("names"))


@query
def entity_counts(spark, sf_dir):
    return buckets.entity_counts(dictionary.entity_dictionary(train(spark, sf_dir), PARTITIONS))


@query
def relation_name_list(spark, sf_dir):
    lists = buckets.name_list(dictionary.relation_dictionary(train(spark, sf_dir)), "relation", CHUNK)
    return lists.select("first", F.to_json("names").alias("names"))


@query
def relation_count(spark, sf_dir):
    return buckets.relation_count(dictionary.relation_dictionary(train(spark, sf_dir)))


# Names and frequencies


@query
def endpoint_union(spark, sf_dir):
    return names.endpoint_union(dataset(spark, sf_dir).coded)


@query
def entity_frequency(spark, sf_dir):
    return names.entity_frequency(dataset(spark, sf_dir).coded)


@query
def relation_frequency(spark, sf_dir):
    return names.relation_frequency(dataset(spark, sf_dir).coded)


@query
def subject_frequency(spark, sf_dir):
    return names.subject_frequency(sample.raw_graph(spark, sf_dir))


@query
def raw_relation_frequency(spark, sf_dir):
    return filters.triples_per_relation(sample.raw_graph(spark, sf_dir))


@query
def one_label_per_subject(spark, sf_dir):
    return names.one_label_per_subject(sample.labels(spark, sf_dir))


@query
def entity_names(spark, sf_dir):
    data = dataset(spark, sf_dir)
    return names.entity_names(data.coded, data.entities)


@query
def relation_names(spark, sf_dir):
    data = dataset(spark, sf_dir)
    return names.relation_names(data.coded, data.relations)


@query
def label_entity_names(spark, sf_dir):
    raw, graph = stored_raw_graph(spark, sf_dir)
    return names.label_entity_names(raw, dictionary.entity_dictionary(train(spark, sf_dir, graph), PARTITIONS))


@query
def label_relation_names(spark, sf_dir):
    raw, graph = stored_raw_graph(spark, sf_dir)
    return names.label_relation_names(raw, dictionary.relation_dictionary(train(spark, sf_dir, graph)))


@query
def unique_names(spark, sf_dir):
    raw, graph = stored_raw_graph(spark, sf_dir)
    data = dataset(spark, sf_dir, graph)
    labelled = names.label_entity_names(raw, data.entities)
    return names.unique_names(names.entity_names(data.coded, data.entities).unionByName(labelled))


@query
def last_names(spark, sf_dir):
    """Names stored in the order of their count, of which the last one of each uri holds."""
    path = scratch_path(spark, "ordered-names")
    parts = sample.part_names(spark, sf_dir)
    again = parts.select("name", F.concat(F.lit("/group/"), F.col("index") % 97).alias("ent"), "count", "index", "partition")
    # By ranges: the files' names follow the order of the ranges.
    again.unionByName(parts).repartitionByRange("count", "index").sortWithinPartitions("count", "index").write.parquet(path)
    return names.unique_names(tables.read_names(spark, path, placed=True), order="last")


@query
def top_entities(spark, sf_dir):
    return names.most_frequent(entity_names(spark, sf_dir), 20)


@query
def top_relations(spark, sf_dir):
    return names.most_frequent(relation_names(spark, sf_dir), 3)


# Search


@query
def word_index(spark, sf_dir):
    return search.word_index(sample.part_names(spark, sf_dir))


@query
def word_search(spark, sf_dir):
    """All hits of each request, unpaged."""
    requests = sample.search_requests(spark, sf_dir).withColumns({"limit": F.lit(2**31 - 1), "offset": F.lit(0)})
    return search.word_search(requests, sample.part_names(spark, sf_dir))


@query
def search_page(spark, sf_dir):
    return search.word_search(sample.search_requests(spark, sf_dir), sample.part_names(spark, sf_dir))


@query
def entity_substring_search(spark, sf_dir):
    labels = sample.part_names(spark, sf_dir).select(F.col("ent").alias("uri"), F.col("name").alias("label"))
    return search.substring_search(sample.search_requests(spark, sf_dir), labels)


@query
def relation_substring_search(spark, sf_dir):
    relations = stage(dictionary.distinct_relations(sample.triples(spark, sf_dir)), "relations")
    labels = relations.select(F.col("rel").alias("uri"), F.col("rel").alias("label"))
    return search.substring_search(sample.search_requests(spark, sf_dir), labels)


@query
def relation_word_search(spark, sf_dir):
    """Each relation asked by its own name."""
    path = scratch_path(spark, "relation-names")
    named = relation_names(spark, sf_dir)
    sinks.write_names(named, path, files=1)
    asked = F.col("index").cast("bigint").alias("query_id"), F.upper("name").alias("query"), F.lit(5).alias("limit"), F.lit(0).alias("offset")
    return jobs.search_relations(tables.read_names(spark, path).select(*asked), path)


@query
def stored_word_search(spark, sf_dir):
    """The first page of each request, from a stored index of stored names."""
    names_path, index_path = scratch_path(spark, "part-names"), scratch_path(spark, "part-index")
    sinks.write_names(sample.part_names(spark, sf_dir), names_path)
    jobs.index_names(spark, names_path, index_path)
    return jobs.search_entities(sample.search_requests(spark, sf_dir), index_path=index_path)


# Vectors


def _vectors_with_operator(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Each vector with the left operator of its own label."""
    chosen = sample.operators(spark, sf_dir).where((F.col("kind") == kind) & (F.col("side") == "lhs"))
    return sample.table(spark, sf_dir, "embeddings").join(chosen, F.col("label") == F.col("rel"))


@query
def project_complex(spark, sf_dir):
    rows = _vectors_with_operator(spark, sf_dir, vectors.COMPLEX)
    product = vectors.complex_product(F.col("embedding"), F.col("real"), F.col("imag"))
    return rows.select("vec_id", F.posexplode(product).alias("pos", "x")).withColumn("x", rounded("x"))


@query
def project_translation(spark, sf_dir):
    rows = _vectors_with_operator(spark, sf_dir, vectors.TRANSLATION)
    moved = vectors.translate(F.col("embedding"), F.col("translation"))
    return rows.select("vec_id", F.posexplode(moved).alias("pos", "x")).withColumn("x", rounded("x"))


@query
def inner_product(spark, sf_dir):
    rows = _vectors_with_operator(spark, sf_dir, vectors.TRANSLATION)
    product = vectors.inner_product(F.col("embedding"), F.col("translation"))
    return rows.select("vec_id", rounded(product).alias("product"))


@query
def knn_direction(spark, sf_dir):
    """Each vector in three directions: the side used, and the projected vector's product with the vector itself."""
    directions = F.explode(F.array(*map(F.lit, ("left", "right", "LEFT")))).alias("direction")
    asked = sample.table(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.col("label").alias("rel"), directions)
    asked = asked.withColumn("side", vectors.operator_side(F.col("direction")))
    rows = asked.join(sample.complex_operators(spark, sf_dir), ["rel", "side"])
    moved = vectors.project(F.col("embedding"), F.col("kind"), F.col("real"), F.col("imag"), F.col("translation"))
    product = vectors.inner_product(moved, F.col("embedding"))
    return rows.select("vec_id", "direction", "side", rounded(product).alias("product"))


def _partitioned(spark: SparkSession, sf_dir: str, requests: DataFrame, **options) -> DataFrame:
    found = knn(
        requests,
        sample.embeddings(spark, sf_dir),
        sample.complex_operators(spark, sf_dir),
        sample.vector_names(spark, sf_dir),
        sample.vector_relations(spark, sf_dir),
        **options,
    )
    return found.withColumn("dist", rounded("dist"))


@query
def knn_partitioned(spark, sf_dir):
    return _partitioned(spark, sf_dir, sample.knn_requests(spark, sf_dir))


@query
def knn_named_before(spark, sf_dir):
    return _partitioned(spark, sf_dir, sample.knn_requests(spark, sf_dir), named_only="before")


@query
def knn_translation(spark, sf_dir):
    """The neighbour job over stored tables with translation operators."""
    paths = {name: scratch_path(spark, name) for name in ("embeddings", "operators", "names", "relations")}
    tables_ = (sample.embeddings, sample.operators, sample.vector_names, sample.vector_relations)
    for path, rows in zip(paths.values(), tables_):
        rows(spark, sf_dir).write.parquet(path)
    found = jobs.knn_partitioned(sample.knn_requests(spark, sf_dir), *paths.values(), kind=vectors.TRANSLATION)
    return found.withColumn("dist", rounded("dist"))


@query
def knn_by_norm(spark, sf_dir):
    """The neighbour job over embeddings stored by norm."""
    paths = {name: scratch_path(spark, name) for name in ("embeddings", "operators", "names", "relations")}
    sinks.write_by_norm(sample.embeddings(spark, sf_dir), paths["embeddings"], head_rows=64)
    for name, rows in (("operators", sample.complex_operators), ("names", sample.vector_names), ("relations", sample.vector_relations)):
        rows(spark, sf_dir).write.parquet(paths[name])
    found = jobs.knn_partitioned(sample.knn_requests(spark, sf_dir), *paths.values(), by_norm=True)
    return found.withColumn("dist", rounded("dist"))


@query
def knn_unknown_keys(spark, sf_dir):
    return _partitioned(spark, sf_dir, sample.document_requests(spark, sf_dir))


@query
def knn_single_index(spark, sf_dir):
    vectors_ = sample.table(spark, sf_dir, "embeddings")
    labels = sample.vector_names(spark, sf_dir).select(F.col("ent").alias("uri"), F.col("name").alias("label"))
    relations = sample.vector_relations(spark, sf_dir)
    found = knn_one_index(
        sample.knn_requests(spark, sf_dir),
        sample.single_index(spark, sf_dir),
        sample.complex_operators(spark, sf_dir),
        vectors_.select(F.col("vec_id").cast("int").alias("id"), F.concat(F.lit("/vec/"), "vec_id").alias("uri")),
        relations.select(F.col("index").alias("id"), F.col("ent").alias("uri")),
        labels,
    )
    return found.withColumn("dist", rounded("dist"))


@query
def knn_single_files(spark, sf_dir):
    """The one-index job over a stored dictionary document and label map."""
    paths = {name: scratch_path(spark, name) for name in ("embeddings", "operators", "dictionary", "labels")}
    sample.single_index(spark, sf_dir).write.parquet(paths["embeddings"])
    sample.complex_operators(spark, sf_dir).write.parquet(paths["operators"])
    vectors_ = sample.table(spark, sf_dir, "embeddings").select(F.struct("vec_id", F.concat(F.lit("/vec/"), "vec_id").alias("uri")).alias("entry"))
    relations = sample.vector_relations(spark, sf_dir).select(F.struct("index", F.col("ent").alias("uri")).alias("entry"))
    listed = lambda rows: rows.agg(F.transform(F.array_sort(F.collect_list("entry")), lambda e: e["uri"]).alias("names"))
    both = listed(vectors_).crossJoin(listed(relations).withColumnRenamed("names", "relations"))  # a row each
    both.select(F.to_json(F.struct(F.struct(F.col("names").alias("all")).alias("entities"), "relations")).alias("value")).write.text(paths["dictionary"])
    labels = sample.vector_names(spark, sf_dir).select(F.col("ent"), F.col("name"))
    entries = F.map_from_entries(F.collect_list(F.struct("ent", "name")))
    labels.agg(F.to_json(entries).alias("value")).write.text(paths["labels"])
    found = jobs.knn_single(sample.knn_requests(spark, sf_dir), *paths.values())
    return found.withColumn("dist", rounded("dist"))


# Scoring and ranking


@query
def score_triples(spark, sf_dir):
    edges = sample.vector_edges(spark, sf_dir)
    scored = evaluate.score_triples(
        edges,
        sample.embeddings(spark, sf_dir),
        sample.complex_operators(spark, sf_dir),
        hot=evaluate.hot_positions(edges),
    )
    return scored.withColumn("score", rounded("score"))


@query
def score_triples_right(spark, sf_dir):
    edges = sample.vector_edges(spark, sf_dir)
    scored = evaluate.score_triples(
        edges,
        sample.embeddings(spark, sf_dir),
        sample.complex_operators(spark, sf_dir),
        side="rhs",
        hot=evaluate.hot_positions(edges),
    )
    return scored.withColumn("score", rounded("score"))


@query
def score_translation(spark, sf_dir):
    edges = sample.vector_edges(spark, sf_dir)
    moves = sample.operators(spark, sf_dir).where(F.col("kind") == vectors.TRANSLATION)
    scored = evaluate.score_triples(edges, sample.embeddings(spark, sf_dir), moves, hot=evaluate.hot_positions(edges))
    return scored.withColumn("score", rounded("score"))


def _with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the embeddings taken away."""
    return sample.embeddings(spark, sf_dir).where((F.col("index") + F.col("partition")) % 3 != 1)


@query
def missing_vectors(spark, sf_dir):
    edges = sample.vector_edges(spark, sf_dir)
    return evaluate.missing_vectors(edges, _with_gaps(spark, sf_dir), evaluate.hot_positions(edges))


@query
def rank_missing(spark, sf_dir):
    """Ranks of the edges whose ends both have an embedding, against candidates that have one."""
    edges = sample.vector_edges(spark, sf_dir)
    found = evaluate.rank_edges(
        edges,
        _with_gaps(spark, sf_dir),
        sample.complex_operators(spark, sf_dir),
        n=NEGATIVES,
        hot=evaluate.hot_positions(edges),
        on_missing="drop",
    )
    return found.withColumn("score", rounded("score"))


@query
def negative_samples_gaps(spark, sf_dir):
    """Draws from the entities that have an embedding."""
    return evaluate.negative_samples(
        sample.vector_edges(spark, sf_dir), _with_gaps(spark, sf_dir), n=NEGATIVES, side="rhs", on_missing="drop"
    )


@query
def negative_samples(spark, sf_dir):
    return evaluate.negative_samples(
        sample.vector_edges(spark, sf_dir), sample.embeddings(spark, sf_dir), n=NEGATIVES, side="rhs"
    )


def _ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = sample.vector_edges(spark, sf_dir)
    return evaluate.rank_edges(
        edges,
        sample.embeddings(spark, sf_dir),
        sample.complex_operators(spark, sf_dir),
        n=NEGATIVES,
        hot=evaluate.hot_positions(edges),
    )


@query
def rank_edges(spark, sf_dir):
    return _ranks(spark, sf_dir).withColumn("score", rounded("score"))


@query
def rank_eval(spark, sf_dir):
    summary = evaluate.rank_summary(_ranks(spark, sf_dir), 1, 10)
    return summary.select("edges", *[rounded(c).alias(c) for c in ("mrr", "hits_at_1", "hits_at_10")])
