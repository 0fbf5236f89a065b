"""Held-out ranks in slices, and rank and select over the entities that exist."""

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from rows import bag

from graphprep import schemas
from graphprep.operators import evaluate, slices

DIMENSION = 6


@pytest.fixture(scope="module")
def graph(spark):
    """300 vectors in three partitions (and 200 with gaps), 60 edges with copies, translation operators."""
    rng = np.random.default_rng(12)
    rows = [(p, i, [float(x) for x in rng.integers(-3, 4, DIMENSION)]) for p in (0, 1, 4) for i in range(100)]
    vectors = spark.createDataFrame(rows, schemas.EMBEDDING)
    gaps = vectors.where((F.col("index") + F.col("partition")) % 3 != 1)
    edges = [(int(a), int(b), int(r), int(rng.choice([0, 1, 4])), int(rng.choice([0, 1, 4]))) for a, b, r in zip(rng.integers(100, size=60), rng.integers(100, size=60), rng.integers(2, size=60))]
    edges = spark.createDataFrame(edges + edges[:7], schemas.CODED)
    moves = [(r, side, "translation", None, None, [float(r + 1)] * DIMENSION) for r in (0, 1) for side in ("lhs", "rhs")]
    return vectors, gaps, edges, spark.createDataFrame(moves, schemas.OPERATOR)


def ranks_by_hand(graph, entities, drop, n, side):
    vectors, _, edges, _ = graph
    have = {(r["partition"], r["index"]): np.array(r["embedding"], float) for r in entities.collect()}
    draws = evaluate.negative_samples(edges.distinct(), entities, n, "rhs" if side == "lhs" else "lhs", on_missing="drop" if drop else "error")
    found = {}
    for r in draws.collect():
        a, b = (r.part_left, r.subj), (r.part_right, r.obj)
        if a in have and b in have:
            source, target = (a, b) if side == "lhs" else (b, a)
            asked = have[source] + r.rel + 1
            key = (r.subj, r.obj, r.rel, r.part_left, r.part_right)
            found[key] = found.get(key, 1) + int(asked @ have[r.cand_part, r.cand_index] > asked @ have[target])
    return found


@pytest.mark.parametrize("slice_bytes", [1, 4 * DIMENSION * 7, 1 << 20])
@pytest.mark.parametrize(("drop", "side"), [(False, "lhs"), (True, "lhs"), (True, "rhs")])
def test_ranks_do_not_depend_on_slices(spark, graph, slice_bytes, drop, side):
    """One slice for each entity, slices of seven indexes, and one for each partition."""
    vectors, gaps, edges, moves = graph
    entities = gaps if drop else vectors
    ranks = evaluate.rank_edges(edges, entities, moves, n=40, side=side, on_missing="drop" if drop else "error", slice_bytes=slice_bytes)
    wanted = ranks_by_hand(graph, entities, drop, 40, side)
    rows = ranks.collect()
    assert {tuple(r)[:5]: r["rank"] for r in rows} == wanted and len(rows) == len(wanted)
    assert sum(r.copies for r in rows) == sum(1 for e in edges.collect() if tuple(e) in wanted)


def test_a_vector_goes_to_a_slice_once_however_many_draws_it_has_there(spark, graph):
    vectors, _, edges, _ = graph
    found = slices.slice_map(vectors, 50, dense=True)
    assert len(found.numbers) == 6
    asked = edges.withColumns({"vector": F.array(F.lit(1.0)), "draws": F.transform(F.sequence(F.lit(0), F.lit(499)), lambda i: (i * 7919 + F.col("subj")) % 300)})
    rows = evaluate.dealt_to_slices(asked.withColumn("draws", F.col("draws").cast("array<bigint>")), found, 1).collect()
    assert len(rows) == 67 * 6  # and not 67 * 500
    assert sum(len(r["places"]) for r in rows) == 67 * 500
    assert all(0 <= p < 50 for r in rows for p in r["places"])


def test_the_plan_does_not_join_candidates(spark, graph):
    vectors, _, edges, moves = graph
    plan = evaluate.rank_edges(edges, vectors, moves, n=40)._jdf.queryExecution().optimizedPlan().toString()
    assert "cand_index" not in plan
    assert plan.count("Generate ") == 1  # copies of slices; draws are never exploded


def test_a_true_end_drawn_as_candidate_is_not_better_than_itself(spark):
    """Scores of candidates are added up as the true end's is: no last bit makes a difference."""
    rng = np.random.default_rng(3)
    one = [float(np.float32(x)) for x in rng.normal(size=100)]
    vectors = spark.createDataFrame([(0, i, one) for i in range(4)], schemas.EMBEDDING)
    edges = spark.createDataFrame([(0, 1, 0, 0, 0), (2, 3, 0, 0, 0)], schemas.CODED)
    moves = spark.createDataFrame([(0, "lhs", "translation", None, None, [float(x) for x in rng.normal(size=100)])], schemas.OPERATOR)
    assert bag(evaluate.rank_edges(edges, vectors, moves, n=100), "rank") == [(1,), (1,)]


def test_gaps_are_an_error_unless_they_are_to_be_passed_over(spark, graph):
    vectors, gaps, edges, moves = graph
    complete = gaps.unionByName(vectors.join(gaps.select("partition", "index"), ["partition", "index"], "left_anti"))
    assert slices.slice_map(complete, 7, dense=True).total == 300
    for odd in (gaps, vectors.where("index > 10"), vectors.where("index <> 14")):
        with pytest.raises(ValueError, match="have gaps"):
            slices.slice_map(odd, 7, dense=True)


def test_no_edges_and_no_entities(spark, graph):
    vectors, _, edges, moves = graph
    assert evaluate.rank_edges(edges.limit(0), vectors, moves).count() == 0
    with pytest.raises(ValueError, match="no entities"):
        evaluate.negative_samples(edges, vectors.limit(0), on_missing="drop")


@given(st.sets(st.integers(0, 300), min_size=1))
@settings(max_examples=60, deadline=None)
def test_select_is_the_place_in_the_sorted_list(ids):
    bits = np.zeros(301, bool)
    bits[list(ids)] = True
    packed = np.packbits(bits, bitorder="little").tobytes()
    assert slices.select(packed, np.arange(len(ids))).tolist() == sorted(ids)


@pytest.mark.parametrize("rows", [1, 7, 1000])
def test_ordinals_lead_to_entities_in_order(spark, graph, rows):
    _, gaps, _, _ = graph
    there = bag(gaps, "partition", "index")
    there = sorted((p, i) for p, i in there)
    asked = spark.createDataFrame([(o, "x") for o in [*range(len(there)), 5, 5, 198]], "ordinal long, note string")
    found = slices.existing(asked.withColumn("ordinal_too", F.col("ordinal")), gaps, rows=rows).collect()
    assert len(found) == len(there) + 3
    assert all((r.cand_part, r.cand_index) == there[r.ordinal_too] and r.note == "x" for r in found)


def test_floats_keep_their_precision_and_must_agree_in_length():
    assert evaluate._floats(pa.array([[1.0, 2.0]], pa.list_(pa.float32()))).dtype == np.float32
    with pytest.raises(ValueError, match="same dimension"):
        evaluate._floats(pa.array([[1.0, 2.0], [1.0]], pa.list_(pa.float32())))


@pytest.mark.parametrize("bitmap_bytes", [0, 1 << 20])
def test_draws_of_one_slice_are_dealt_to_several_tasks(spark, bitmap_bytes):
    """One slice of all entities, and one partition of draws: either way finds the entities, and not in one task."""
    gaps = spark.range(300).where("id % 3 != 1").select(F.lit(2).alias("partition"), F.col("id").cast("int").alias("index"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        asked = spark.range(0, 4000, 1, 5).select(F.col("id").alias("draw"), (F.col("id") % 200).alias("ordinal"))
        found = slices.existing(asked, gaps, bitmap_bytes=bitmap_bytes).withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    there = [i for i in range(300) if i % 3 != 1]
    assert sorted((r["draw"], r["cand_part"], r["cand_index"]) for r in found) == [(i, 2, there[i % 200]) for i in range(4000)]
    assert len({r["task"] for r in found}) > 1


def test_few_edges_draw_in_many_tasks(spark):
    """Edges that came in one partition are spread before they become many rows."""
    edges = spark.range(0, 50, 1, 1).selectExpr("cast(id as int) subj", "0 obj", "0 rel", "0 part_left", "0 part_right")
    entities = spark.range(50).selectExpr("0 partition", "cast(id as int) index")
    for options in ({}, {"on_missing": "drop"}):
        drawn = evaluate.negative_samples(edges, entities, n=20, **options).withColumn("task", F.spark_partition_id())
        assert drawn.count() == 1000
        assert drawn.select("task").distinct().count() > 1


@pytest.mark.parametrize("dimension, n_slices, n", [(64, 4, 500), (64, 10_000, 500), (2, 1, 100_000), (4, 3, 0)])
def test_dealing_is_bounded_by_the_draws_too(dimension, n_slices, n):
    """Few slices and many draws: the draws take more than the vectors."""
    rows = evaluate.deal_rows(dimension, n_slices, n)
    assert rows == 1 or rows * n * 8 * evaluate.DEALT_NUMBERS <= evaluate.DEAL_BYTES
    assert rows == 1 or rows * 8 * dimension * min(n_slices, n) <= evaluate.DEAL_BYTES
