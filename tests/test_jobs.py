"""Jobs and sinks on disk."""

import json

import pytest
from rows import bag
from pyspark.sql import functions as F

from graphprep import schemas
from graphprep.functions import vectors
from graphprep.functions.text import RDFS_LABEL
from graphprep.operators import buckets, dictionary, encode, splits
from graphprep.plans import jobs
from graphprep.sources import documents, sinks, tables


@pytest.fixture(scope="module")
def graph(spark):
    rows = [(f"s{i % 90}", f"r{i % 6}", f"o{(i * 7) % 110}") for i in range(2000)] + [("s1", "r1", "s1")] * 5
    return tables.triples_from_rows(spark, rows)


@pytest.fixture(scope="module")
def layout(spark, graph, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("dataset"))
    layout = jobs.create_dataset(graph, 3, root)
    jobs.generate_names(spark, root)
    return layout


def test_columns_on_disk(spark, layout):
    # Of the files themselves, without the columns that come from directories.
    files = {
        layout.entities: ["index", "ent"],
        layout.relations: ["index", "relation"],
        layout.split("train"): ["subj", "obj", "rel"],
        layout.entity_names: ["name", "ent", "count", "index", "partition"],
    }
    for path, columns in files.items():
        one = spark.read.option("recursiveFileLookup", "true").parquet(path)
        assert one.columns == columns


def test_splits_decode_to_the_input(spark, graph, layout):
    ents, rels = tables.read_entities(spark, layout.entities), tables.read_relations(spark, layout.relations)
    parts = [
        encode.decode_triples(tables.read_coded(spark, layout.split(name)), ents, rels)
        for name in ("train", "valid", "test")
    ]
    sizes = [part.count() for part in parts]
    assert bag(parts[0].union(parts[1]).union(parts[2])) == bag(graph)
    assert sizes[0] > 1400 and all(sizes)


def test_a_written_partition_is_read_alone(spark, layout):
    plan = tables.read_entities(spark, layout.entities, 1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(partition" in plan
    scan = buckets.bucket_scan(tables.read_coded(spark, layout.split("train")), 0, 1)
    assert len(scan.inputFiles()) >= 1
    assert "part_left" in scan._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1]
    expected = tables.read_coded(spark, layout.split("train")).where("part_left = 0 and part_right = 1")
    assert bag(scan) == bag(expected) != []


def test_files_are_sorted_by_index(spark, layout):
    rows = spark.read.parquet(layout.entities).withColumn("file", F.input_file_name()).collect()
    by_file = {}
    for row in rows:
        by_file.setdefault(row.file, []).append(row["index"])
    assert all(indexes == sorted(indexes) for indexes in by_file.values())


def test_names_tables(spark, layout):
    names = tables.read_names(spark, layout.entity_names)
    coded = tables.read_coded(spark, layout.split("train"))
    assert names.agg(F.sum("count")).first()[0] == 2 * coded.count()
    relations = tables.read_names(spark, layout.relation_names)
    assert relations.agg(F.sum("count")).first()[0] == coded.count()
    assert len(spark.read.parquet(layout.relation_names).inputFiles()) == 1


def test_encoding_with_stored_dictionaries(spark, layout, tmp_path):
    other = tables.triples_from_rows(spark, [("s1", "r1", "o7"), ("s1", "r1", "nobody")])
    jobs.write_coded_triples(other, layout.relations, layout.entities, str(tmp_path / "coded"))
    assert tables.read_coded(spark, str(tmp_path / "coded")).count() == 1


def test_build_dataset_uses_all_triples(spark, graph, tmp_path):
    paths = [str(tmp_path / name) for name in ("relations", "entities", "train")]
    jobs.build_dataset(graph, 2, *paths)
    assert tables.read_coded(spark, paths[2]).count() == graph.count()
    assert tables.read_entities(spark, paths[1]).count() == 90 + 110


def test_overwrite(spark, tmp_path):
    path = str(tmp_path / "relations")
    for names in (["a", "b"], ["c"]):
        sinks.write_relations(spark.createDataFrame(list(enumerate(names)), schemas.RELATION), path)
    assert bag(tables.read_relations(spark, path)) == [(0, "c")]


def test_fixed_tasks_give_one_file_per_bucket(spark, layout, tmp_path):
    coded = tables.read_coded(spark, layout.split("train")).repartition(6)
    sinks.write_coded(coded, str(tmp_path), tasks=4)
    assert len(spark.read.parquet(str(tmp_path)).inputFiles()) == 9


def test_a_large_bucket_is_split_over_files(spark, layout, tmp_path):
    coded = tables.read_coded(spark, layout.split("train")).repartition(6)
    hot = coded.where("part_left = 0 and part_right = 0")
    for _ in range(7):
        hot = hot.union(hot)
    skewed = hot.union(coded).repartition(6)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "32k")
    try:
        sinks.write_coded(skewed, str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    written = tables.read_coded(spark, str(tmp_path))
    assert written.count() == skewed.count()
    assert len(buckets.bucket_scan(spark.read.parquet(str(tmp_path)), 0, 0).inputFiles()) > 1
    largest = written.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert largest < hot.count() / 2


def test_export(spark, layout, tmp_path):
    edges, metadata = str(tmp_path / "edges"), str(tmp_path / "metadata")
    jobs.export_dataset(spark, layout.split("train"), 3, edges, layout.entities, layout.relations, metadata)
    coded = tables.read_coded(spark, layout.split("train"))
    exported = spark.read.parquet(f"{edges}/edges")
    assert bag(exported, "lhs", "rhs", "rel", "part_left", "part_right") == bag(coded)
    manifest = spark.read.json(f"{edges}/manifest")
    assert manifest.count() == 9 and manifest.agg(F.sum("count")).first()[0] == coded.count()
    assert manifest.select("format_version").distinct().collect()[0][0] == 1
    lists = spark.read.json(f"{metadata}/entity_names_all")
    ents = tables.read_entities(spark, layout.entities)
    assert bag(documents.listed_names(lists), "index", "name", "partition") == bag(ents)
    counts = spark.read.text(f"{metadata}/entity_count_all")
    assert bag(counts, "partition", "value") == bag(ents.groupBy("partition").agg(F.count("*").cast("string")))
    names = spark.read.json(f"{metadata}/dynamic_rel_names").first()["names"]
    assert names == [r.relation for r in tables.read_relations(spark, layout.relations).orderBy("index").collect()]
    assert spark.read.text(f"{metadata}/dynamic_rel_count").first()[0] == str(len(names))


def test_export_skips_metadata_not_asked_for(spark, layout, tmp_path):
    jobs.export_dataset(spark, layout.split("valid"), 3, str(tmp_path / "a"), layout.entities, layout.relations)
    assert sorted(p.name for p in tmp_path.iterdir()) == ["a"]
    jobs.export_dataset(spark, layout.split("valid"), 3, str(tmp_path / "b"), None, layout.relations, str(tmp_path / "c"))
    assert sorted(p.name for p in (tmp_path / "c").iterdir()) == ["dynamic_rel_count", "dynamic_rel_names"]


def test_empty_buckets_are_in_the_manifest(spark):
    coded = spark.createDataFrame([(0, 0, 0, 0, 1)], schemas.CODED)
    assert bag(buckets.manifest(coded, 2), "part_left", "part_right", "count") == [(0, 0, 0), (0, 1, 1), (1, 0, 0), (1, 1, 0)]


def test_name_list_is_in_index_order_whatever_the_row_order(spark):
    ents = spark.createDataFrame([(i, f"e{i:03d}", 0) for i in range(250)], schemas.ENTITY).orderBy(F.rand(3))
    lists = buckets.name_list(ents, "ent", chunk_rows=100).orderBy("first").collect()
    assert [r.first for r in lists] == [0, 100, 200]
    assert [name for r in lists for name in r.names] == [f"e{i:03d}" for i in range(250)]


def test_label_names_job(spark, layout, tmp_path):
    raw = tables.triples_from_rows(
        spark, [("s1", "r1", "o1"), ("s1", RDFS_LABEL, '"Ann"@en'), ("r1", RDFS_LABEL, '"likes"@en'), ("x", RDFS_LABEL, '"x"@en')]
    )
    raw.write.parquet(str(tmp_path / "raw"))
    stored = tables.read_triples(spark, str(tmp_path / "raw"))
    out = [str(tmp_path / name) for name in ("entities", "relations")]
    jobs.generate_label_names(stored, layout.entities, layout.relations, *out)
    assert bag(tables.read_names(spark, out[0]), "name", "ent", "count") == [("Ann", "s1", 2)]
    assert bag(tables.read_names(spark, out[1]), "name", "ent", "count") == [("likes", "r1", 1)]


def test_label_filter_reaches_the_scan(spark, tmp_path):
    from graphprep.operators.filters import english_labels

    tables.triples_from_rows(spark, [("a", "b", "c")]).write.parquet(str(tmp_path / "raw"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        found = english_labels(tables.read_triples(spark, str(tmp_path / "raw")))
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan.split("PushedFilters")[1]
    assert "EqualTo(rel" in pushed and "StringContains(obj" in pushed


def test_search_jobs(spark, layout, tmp_path):
    asked = spark.createDataFrame([(1, "S1", 5, 0)], schemas.SEARCH_REQUEST)
    assert bag(jobs.search_entities(asked, layout.entity_names), "value") == [("s1",)]
    relations = spark.createDataFrame([(1, "R", 2, 1)], schemas.SEARCH_REQUEST)
    assert bag(jobs.search_relation_uris(relations, layout.relation_names)) == [(1, 2, "r1", "r1", 6), (1, 3, "r2", "r2", 6)]
    label_file = tmp_path / "labels.json"
    label_file.write_text(json.dumps({"/a": "Ann Lee", "/b": "Bob"}, indent=1))
    labels = spark.createDataFrame([(1, "n l", 5, 0)], schemas.SEARCH_REQUEST)
    assert bag(jobs.search_entity_labels(labels, str(label_file))) == [(1, 1, "/a", "Ann Lee", 1)]
    table, index = jobs.load_names(spark, layout.entity_names)
    assert index.count() == table.count()


def test_json_dictionaries(spark, tmp_path):
    path = tmp_path / "dictionary.json"
    path.write_text(json.dumps({"entities": {"all": ["/a", "/b", "/a"]}, "relations": ["r", 'q"']}, indent=1))
    listed = documents.read_documents(spark, str(path))
    assert bag(documents.entity_ids(listed)) == [(0, "/a"), (1, "/b"), (2, "/a")]
    assert bag(documents.ids_by_uri(documents.entity_ids(listed))) == [("/a", 2), ("/b", 1)]
    assert bag(documents.relation_ids(listed)) == [(0, "r"), (1, 'q"')]


def test_knn_jobs_on_stored_tables(spark, tmp_path):
    embeddings = spark.createDataFrame([(0, 0, [1.0, 0.0]), (0, 1, [0.0, 2.0]), (0, 2, [3.0, 0.0])], schemas.EMBEDDING)
    operators = spark.createDataFrame(
        [(0, s, vectors.COMPLEX, [1.0], [0.0], None) for s in ("lhs", "rhs")]
        + [(0, s, vectors.TRANSLATION, None, None, [9.0, 9.0]) for s in ("lhs", "rhs")],
        schemas.OPERATOR,
    )
    names = spark.createDataFrame([("A", "/a", 1, 0, 0), ("C", "/c", 1, 2, 0)], schemas.NAMES)
    relations = spark.createDataFrame([("R", "/r", 1, 0, 0)], schemas.NAMES)
    paths = {n: str(tmp_path / n) for n in ("embeddings", "operators", "names", "relations")}
    for name, table in zip(paths, (embeddings, operators, names, relations)):
        table.write.parquet(paths[name])
    asked = spark.createDataFrame([(7, "/a", "/r", 3, "left")], schemas.KNN_REQUEST)
    assert bag(jobs.knn_partitioned(asked, *paths.values())) == [(7, 1, "/c", 3.0, "C"), (7, 2, "/a", 1.0, "A")]
    dictionary_file, label_file = tmp_path / "dictionary.json", tmp_path / "labels.json"
    dictionary_file.write_text(json.dumps({"entities": {"all": ["/a", "/b", "/c"]}, "relations": ["/r"]}))
    label_file.write_text(json.dumps({"/a": "A", "/c": "C"}))
    found = jobs.knn_single(asked, paths["embeddings"], paths["operators"], str(dictionary_file), str(label_file))
    assert bag(found) == [(7, 1, "/c", 3.0, "C"), (7, 2, "/a", 1.0, "A"), (7, 3, "/b", 0.0, "")]
    unknown = spark.createDataFrame([(7, "/x", "/r", 3, "left")], schemas.KNN_REQUEST)
    with pytest.raises(KeyError):
        jobs.knn_single(unknown, paths["embeddings"], paths["operators"], str(dictionary_file), str(label_file))


def test_scratch_tables_go_to_the_shared_folder(spark):
    from graphprep.workspace import scratch_path

    configured = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch_path(spark, "x")
    assert path != scratch_path(spark, "x")
    if configured:
        assert path.startswith(configured)


def test_missing_columns_are_an_error(spark):
    with pytest.raises(ValueError, match="missing columns"):
        schemas.conform(spark.createDataFrame([(1,)], "index int"), schemas.RELATION)


def test_dictionary_needs_a_partition(graph):
    with pytest.raises(ValueError):
        dictionary.entity_dictionary(graph, 0)


def test_a_dataset_is_encoded_and_exported_without_needless_shuffles(spark, graph, tmp_path, monkeypatch):
    calls, asked = [], []
    encode_triples, hint = encode.encode_triples, type(graph).hint

    def encoding(*args, **named):
        calls.append(1)
        return encode_triples(*args, **named)

    monkeypatch.setattr(encode, "encode_triples", encoding)
    layout = jobs.create_dataset(graph, 3, str(tmp_path / "dataset"))
    assert len(calls) == 1
    entities, relations = tables.read_entities(spark, layout.entities), tables.read_relations(spark, layout.relations)
    for name in ("train", "valid", "test"):
        rows = splits.split_triples(graph).where(F.col("split") == name)
        assert bag(tables.read_coded(spark, layout.split(name))) == bag(encode_triples(rows, entities, relations))
    left = [p.name for p in (tmp_path / "dataset").iterdir()]
    assert sorted(n for n in left if not n.endswith(".crc")) == ["entities", "relations", "test", "train", "valid"]

    stored = tables.read_coded(spark, layout.split("train"))

    def hinting(table, name, *columns):
        asked.append(name)
        return hint(table, name, *columns)

    monkeypatch.setattr(type(graph), "hint", hinting)
    jobs.export_dataset(spark, layout.split("train"), 3, str(tmp_path / "out"))
    assert "rebalance" not in asked
    assert bag(spark.read.parquet(str(tmp_path / "out" / "edges"))) == bag(buckets.bucket_export(stored))
