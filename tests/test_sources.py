"""Sources that must not lose rows, scratch space, pages of very different widths."""

import json
from types import SimpleNamespace

import pytest
from rows import bag
from pyspark.sql import functions as F

from graphprep import workspace
from graphprep.operators import evaluate, search
from graphprep.sources import documents, tables


def values(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


@pytest.mark.parametrize("text", ['{"relations": ["a", ', "nonsense", '{"relations": 3}'])
def test_malformed_documents_are_errors(spark, text):
    with pytest.raises(Exception):
        documents.relation_ids(values(spark, text)).collect()


def test_a_missing_list_is_an_error(spark):
    with pytest.raises(Exception):
        documents.relation_ids(values(spark, '{"other": 1}')).collect()


def test_malformed_label_maps_are_errors(spark):
    with pytest.raises(Exception):
        documents.label_map(values(spark, '{"a": ')).collect()


def test_several_documents_need_their_first_ids(spark):
    two = values(spark, '{"relations": ["x", "y"]}', '{"relations": ["z"]}')
    with pytest.raises(ValueError):
        documents.relation_ids(two)
    placed = two.withColumn("first", F.when(F.contains("value", F.lit("z")), 2).otherwise(0))
    assert bag(documents.relation_ids(placed), "id", "uri") == [(0, "x"), (1, "y"), (2, "z")]


def test_the_last_label_counts(spark, tmp_path):
    (tmp_path / "1.json").write_text('{"a": "A1", "b": "B", "a": "A2"}')
    (tmp_path / "2.json").write_text('{"c": "C", "b": "B2"}')
    found = documents.label_map(documents.read_documents(spark, str(tmp_path)))
    assert bag(found) == [("a", "A2"), ("b", "B2"), ("c", "C")]


def test_lists_in_rows(spark, tmp_path):
    rows = [{"first": 0, "names": ["x", "y"]}, {"first": 2, "names": ["z"]}]
    (tmp_path / "l.json").write_text("\n".join(map(json.dumps, rows)))
    assert bag(documents.read_lists(spark, str(tmp_path))) == [(0, "x"), (1, "y"), (2, "z")]
    (tmp_path / "m.json").write_text("{broken")
    with pytest.raises(Exception):
        documents.read_lists(spark, str(tmp_path)).collect()


def test_triples_without_a_column_are_an_error(spark, tmp_path):
    spark.createDataFrame([("a", "b")], "subj string, rel string").write.parquet(f"{tmp_path}/t")
    with pytest.raises(ValueError):
        tables.read_triples(spark, f"{tmp_path}/t")


def session(setting=None, given=None, master="local[8]"):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: given)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: setting or default), sparkContext=context)


def test_scratch_paths():
    assert workspace.scratch_path(session("s3://x/"), "t").startswith("s3://x/graphprep/t-")
    assert workspace.scratch_path(session(given="hdfs://y"), "t").startswith("hdfs://y/graphprep/t-")
    assert "graphprep-" in workspace.scratch_path(session(), "t")
    for master in ("yarn", "local-cluster[2,1,1024]", "spark://host:7077"):
        with pytest.raises(RuntimeError):
            workspace.scratch_path(session(master=master), "t")


def test_scratch_tables_can_be_cleared(spark):
    before = list(workspace._written)
    workspace._written.clear()
    path = workspace.stage(spark.range(3), "t").inputFiles()[0].rsplit("/", 1)[0]
    workspace.clear(spark)
    workspace._written.extend(before)
    with pytest.raises(Exception):
        spark.read.parquet(path).count()


def test_one_deep_request_leaves_small_pages_small(spark):
    """Many small pages and one request for everything, all on one question."""
    names = spark.range(3000).select(
        F.lit("red").alias("name"), F.concat(F.lit("/e/"), "id").alias("ent"), F.lit(1).cast("bigint").alias("count"), F.col("id").cast("int").alias("index"), F.lit(0).alias("partition")
    )
    rows = [(i, "red", 10, i * 10) for i in range(100)] + [(1000, "red", 2**31 - 1, 0)]
    requests = spark.createDataFrame(rows, "query_id bigint, query string, limit int, offset int")
    found = search.word_search(requests, names)
    assert found.count() == 100 * 10 + 3000
    pages = bag(found.where("query_id = 7"), "rank")
    assert pages == [(r,) for r in range(71, 81)]
    asked = search._ask(requests, F.lit("red"))
    widths = asked.rows.select(F.ceil(F.log2((F.col("_end") - F.col("offset")) / search.PAGE_BLOCK))).distinct().count()
    assert widths == 2  # each small page meets blocks of its own width only


def test_gaps_in_embeddings_are_not_passed_over(spark):
    vectors = spark.createDataFrame([(0, 0, [1.0, 0.0]), (0, 2, [0.0, 1.0])], "partition int, index int, embedding array<float>")
    edges = spark.createDataFrame([(0, 2, 0, 0, 0), (0, 1, 0, 0, 0)], "subj int, obj int, rel int, part_left int, part_right int")
    moves = spark.createDataFrame([(0, "lhs", "translation", None, None, [0.0, 0.0])], "rel int, side string, kind string, real array<float>, imag array<float>, translation array<float>")
    with pytest.raises(Exception):
        evaluate.score_triples(edges, vectors, moves).collect()
    assert evaluate.score_triples(edges, vectors, moves, on_missing="drop").count() == 1
    with pytest.raises(Exception):
        evaluate.negative_samples(edges, vectors, 2).collect()
    assert bag(evaluate.missing_vectors(edges, vectors)) == [(2, 0, 1, 1)]
    ranks = evaluate.rank_edges(edges, vectors, moves, n=50, on_missing="drop")
    assert bag(ranks, "obj", "copies") == [(2, 1)]
