"""Neighbour queries, scores and ranks against numpy."""

import math

import numpy as np
import pyarrow as pa
import pytest
from rows import bag
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from graphprep import schemas
from graphprep.functions import blocks, vectors
from graphprep.operators import evaluate, lookup
from graphprep.operators import knn as knn_module
from graphprep.operators.knn import knn
from graphprep.plans.jobs import knn_one_index
from graphprep.sources import sinks
from graphprep.sources.tables import check_embeddings, read_by_norm

DIM = 6
PARTITIONS = 3


class World:
    """Some entities, a third of them copies of one vector, with two complex and one translation relation."""

    def __init__(self, spark, n=60, named=lambda i: i % 4 != 0):
        rng = np.random.default_rng(5)
        self.vectors = rng.normal(size=(n, DIM)).astype(np.float32)
        self.vectors[::3] = self.vectors[0]
        self.position = [(i % PARTITIONS, i // PARTITIONS) for i in range(n)]
        self.operators = {}
        rows = []
        for rel in range(2):
            for side in ("lhs", "rhs"):
                real, imag = rng.normal(size=(2, DIM // 2)).astype(np.float32)
                self.operators[rel, side] = lambda x, c=real.astype(float), d=imag.astype(float): np.concatenate(
                    [x[: DIM // 2] * c - x[DIM // 2 :] * d, x[: DIM // 2] * d + x[DIM // 2 :] * c]
                )
                rows.append((rel, side, vectors.COMPLEX, real.tolist(), imag.tolist(), None))
        for side in ("lhs", "rhs"):
            t = rng.normal(size=DIM).astype(np.float32)
            self.operators[2, side] = lambda x, t=t.astype(float): x + t
            rows.append((2, side, vectors.TRANSLATION, None, None, t.tolist()))
        self.operator_table = spark.createDataFrame(rows, schemas.OPERATOR)
        self.embeddings = spark.createDataFrame(
            [(p, i, v.tolist()) for (p, i), v in zip(self.position, self.vectors)], schemas.EMBEDDING
        ).repartition(4)
        self.names = {i: f"name {i}" for i in range(n) if named(i)}
        self.name_table = spark.createDataFrame(
            [(name, f"/e/{i}", 1, self.position[i][1], self.position[i][0]) for i, name in self.names.items()],
            schemas.NAMES,
        )
        self.relation_table = spark.createDataFrame([(f"/r/{r}", f"/r/{r}", 1, r, 0) for r in range(3)], schemas.NAMES)

    def scores(self, entity, rel, side):
        projected = self.operators[rel, side](self.vectors[entity].astype(float))
        return (self.vectors.astype(float) @ projected).astype(np.float32)

    def expected(self, requests, named_only="after", partitioned=True):
        rows = []
        for query_id, entity, relation, k, direction in requests:
            e, r = int(entity.split("/")[2]), int(relation.split("/")[2])
            if r > 2 or (e not in self.names if partitioned else e >= len(self.vectors)):
                continue
            scores = self.scores(e, r, "lhs" if direction == "left" else "rhs")
            order = sorted(range(len(scores)), key=lambda i: (-scores[i], self.position[i] if partitioned else i))
            if partitioned and named_only == "after":
                order = [i for i in order if [j for j in order if self.position[j][0] == self.position[i][0]].index(i) < k]
            if partitioned:
                order = [i for i in order if i in self.names]
            rows += [
                (query_id, place + 1, f"/e/{i}", float(scores[i]), self.names.get(i, ""))
                for place, i in enumerate(order[:k])
            ]
        return sorted(rows, key=repr)


@pytest.fixture(scope="module")
def world(spark):
    return World(spark)


def requests(n=60):
    rows = [(i, f"/e/{i % 70}", f"/r/{i % 4}", 1 + i % 7, ("left", "right", "xyz")[i % 3]) for i in range(n)]
    # A third of all requests are the same question.
    return rows + [(1000 + i, "/e/1", "/r/0", 5, "left") for i in range(n // 2)]


def close(found, wanted):
    assert [(r[0], r[1], r[2], r[4]) for r in found] == [(r[0], r[1], r[2], r[4]) for r in wanted]
    assert np.allclose([r[3] for r in found], [r[3] for r in wanted], rtol=1e-6)


@pytest.fixture(params=["scan", "scan in pieces", "grid"])
def way(request, monkeypatch):
    if request.param != "grid":
        monkeypatch.setattr(knn_module, "TASK_HITS", 5_000_000 if request.param == "scan" else 10)
        return {}
    monkeypatch.setattr(lookup, "SMALL_ROWS", 2)
    monkeypatch.setattr(knn_module, "hot_keys", lambda df, key: lookup.hot_keys(df, key, min_hits=20))
    monkeypatch.setattr(knn_module, "CELL_BYTES", 45 * 8 * DIM)
    return {"broadcast_rows": 1}


@pytest.mark.parametrize("named_only", ["after", "before"])
def test_partitioned(spark, world, way, named_only):
    asked = requests()
    table = spark.createDataFrame(asked, schemas.KNN_REQUEST)
    found = knn(
        table, world.embeddings, world.operator_table, world.name_table, world.relation_table, named_only=named_only, **way
    )
    close(bag(found), world.expected(asked, named_only))


def test_single_index(spark, world, way):
    asked = [r for r in requests() if int(r[1][3:]) < 60 and r[2] != "/r/3"]
    ids = spark.createDataFrame([(i, f"/e/{i}") for i in range(60)], "id int, uri string")
    single = spark.createDataFrame([(0, i, v.tolist()) for i, v in enumerate(world.vectors)], schemas.EMBEDDING)
    found = knn_one_index(
        spark.createDataFrame(asked, schemas.KNN_REQUEST),
        single,
        world.operator_table,
        ids,
        spark.createDataFrame([(r, f"/r/{r}") for r in range(3)], "id int, uri string"),
        world.name_table.selectExpr("ent as uri", "name as label"),
        **way,
    )
    close(bag(found), world.expected(asked, partitioned=False))


def test_unnamed_winners_leave_fewer_than_k(spark):
    # One partition whose two best are unnamed.
    rows = [(0, 0, [3.0, 0.0]), (0, 1, [2.0, 0.0]), (0, 2, [1.0, 0.0]), (0, 3, [0.5, 0.0])]
    embeddings = spark.createDataFrame(rows, schemas.EMBEDDING)
    operators = spark.createDataFrame([(0, "lhs", vectors.COMPLEX, [1.0], [0.0], None)], schemas.OPERATOR)
    named = spark.createDataFrame([("c", "/c", 1, 2, 0), ("d", "/d", 1, 3, 0)], schemas.NAMES)
    relation = spark.createDataFrame([("r", "/r", 1, 0, 0)], schemas.NAMES)
    asked = spark.createDataFrame([(1, "/c", "/r", 2, "left")], schemas.KNN_REQUEST)
    assert bag(knn(asked, embeddings, operators, named, relation)) == []
    before = knn(asked, embeddings, operators, named, relation, named_only="before")
    # The identity operator leaves the entity among its own neighbours, at its squared norm.
    assert bag(before) == [(1, 1, "/c", 1.0, "c"), (1, 2, "/d", 0.5, "d")]


def test_unknown_keys_are_empty_or_an_error(spark, world):
    asked = spark.createDataFrame([(1, "/e/none", "/r/0", 2, "left"), (2, "/e/1", "/none", 2, "left")], schemas.KNN_REQUEST)
    tables = (world.embeddings, world.operator_table, world.name_table, world.relation_table)
    assert bag(knn(asked, *tables)) == []
    with pytest.raises(KeyError):
        knn(asked, *tables, on_missing="error")


@pytest.mark.parametrize("broadcast_rows", [10, -1])
def test_no_requests(spark, world, broadcast_rows):
    asked = spark.createDataFrame([], schemas.KNN_REQUEST)
    tables = (world.embeddings, world.operator_table, world.name_table, world.relation_table)
    assert bag(knn(asked, *tables, broadcast_rows=broadcast_rows)) == []
    assert bag(knn(spark.createDataFrame([(1, "/e/1", "/r/0", 2, "left")], schemas.KNN_REQUEST), world.embeddings.limit(0), *tables[1:], broadcast_rows=broadcast_rows)) == []


def test_k_must_be_positive(spark, world):
    asked = spark.createDataFrame([(1, "/e/1", "/r/0", 0, "left")], schemas.KNN_REQUEST)
    with pytest.raises(Exception, match="k must be positive"):
        knn(asked, world.embeddings, world.operator_table, world.name_table, world.relation_table).collect()


def test_partitions_do_not_matter_when_all_are_named(spark):
    world = World(spark, named=lambda i: True)
    asked = spark.createDataFrame(requests(30), schemas.KNN_REQUEST)
    tables = (world.operator_table, world.name_table, world.relation_table)
    several = knn(asked, world.embeddings, *tables)
    # The same entities as one partition, in the order of (partition, index).
    key = (F.col("partition") * 20 + F.col("index")).cast("int")
    together = [df.withColumn("index", key).withColumn("partition", F.lit(0)) for df in (world.embeddings, world.name_table)]
    one = knn(asked, together[0], world.operator_table, together[1], world.relation_table)
    close(bag(one), bag(several))


def test_tasks_cut_hits_before_the_shuffle(spark, world):
    asked = spark.createDataFrame(requests(), schemas.KNN_REQUEST)
    found = knn(asked, world.embeddings, world.operator_table, world.name_table, world.relation_table)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 4
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


@settings(deadline=None, max_examples=200)
@given(st.data())
def test_best_keeps_the_lowest_ids_among_ties(data):
    rows, columns = data.draw(st.integers(1, 4)), data.draw(st.integers(1, 12))
    k = data.draw(st.integers(1, 14))
    scores = np.array(data.draw(st.lists(st.integers(0, 3), min_size=rows * columns, max_size=rows * columns)), np.float32)
    scores = scores.reshape(rows, columns)
    ids = np.array([data.draw(st.permutations(range(columns))) for _ in range(rows)], np.int32)
    got_scores, got_ids = blocks.best(scores, ids, k)
    for r in range(rows):
        wanted = sorted(zip(-scores[r], ids[r]))[:k]
        assert sorted(zip(-got_scores[r], got_ids[r])) == wanted


def test_scorer_over_many_batches():
    rng = np.random.default_rng(1)
    questions, entities = rng.normal(size=(600, 4)), rng.normal(size=(500, 4))
    entities[::2] = entities[0]
    ks = np.where(np.arange(600) % 300 == 0, 40, 7)
    scorer = blocks.Scorer(np.arange(600), questions, ks)
    for start in range(0, 500, 90):
        part = np.arange(start, min(start + 90, 500))
        scorer.add(part % 2, part, entities[part])
    # Only the last block is as wide as the two large ones.
    assert scorer.size == 2 * (512 * 7 + 88 * 40)
    hits = pa.Table.from_batches(scorer.drain()).to_pandas()
    assert scorer.size == 0
    scores = (questions @ entities.T).astype(np.float32)
    for q in (0, 255, 256, 599):
        for p in (0, 1):
            wanted = sorted(range(p, 500, 2), key=lambda i: (-scores[q, i], i))[: ks[q]]
            assert set(hits[(hits.question_id == q) & (hits.partition == p)]["index"]) >= set(wanted)


def skewed(n, rng, d=8):
    """Vectors of which a few are very long."""
    return rng.normal(size=(n, d)) * np.geomspace(100, 0.01, n)[:, None]


def best_of(hits, k):
    """The k best of each question and partition, as ``(score, index)``."""
    found = {}
    for row in hits.itertuples(index=False):
        found.setdefault((row.question_id, row.partition), []).append((-row.dist, row[3]))
    return {key: sorted(rows)[:k] for key, rows in found.items()}


def test_short_vectors_are_passed_over():
    rng = np.random.default_rng(7)
    entities, questions = skewed(60_000, rng), rng.normal(size=(50, 8))
    scorer = blocks.Scorer(np.arange(50), questions, np.full(50, 10))
    partitions = np.arange(60_000) % 2
    for start in range(0, 60_000, 20_000):
        part = np.arange(start, start + 20_000)
        scorer.add(partitions[part], part, entities[part])
    assert scorer.skipped > 45_000 and scorer.scored + scorer.skipped == 60_000
    scores = (questions @ entities.T).astype(np.float32)
    found = best_of(pa.Table.from_batches(scorer.drain()).to_pandas(), 10)
    for q in range(50):
        for p in range(2):
            assert found[q, p] == sorted((-scores[q, i], i) for i in range(p, 60_000, 2))[:10]
    known = {p: np.array([-found[q, p][-1][0] for q in range(50)]) for p in (0, 1)}
    again = blocks.Scorer(np.arange(50), questions, np.full(50, 10), known)
    again.add(partitions[30_000:], np.arange(30_000, 60_000), entities[30_000:])
    assert again.scored == 0  # what is known from the long ones rules out all of the short ones


@given(st.data())
@settings(max_examples=60, deadline=None)
def test_passing_over_changes_no_answer(data):
    """Ties, zero vectors, negative scores, questions of different k, batches in any order."""
    rng = np.random.default_rng(data.draw(st.integers(0, 10**6)))
    n, q = data.draw(st.integers(1, 80)), data.draw(st.integers(1, 6))
    entities = rng.integers(-2, 3, size=(n, 3)) * rng.choice([0.0, 1.0, 7.0], size=(n, 1))
    questions = rng.integers(-2, 3, size=(q, 3)).astype(float)
    ks = rng.integers(1, 9, size=q)
    old = blocks.ENTITY_BLOCK
    blocks.ENTITY_BLOCK = data.draw(st.integers(1, 9))
    try:
        scorer = blocks.Scorer(np.arange(q), questions, ks)
        for part in np.array_split(rng.permutation(n), 3):
            scorer.add(part % 2, part, entities[part])
    finally:
        blocks.ENTITY_BLOCK = old
    hits = pa.Table.from_batches(scorer.drain(), schema=blocks.HITS_ARROW).to_pandas()
    found = best_of(hits, 10**6)
    scores = (questions @ entities.T).astype(np.float32)
    for i in range(q):
        for p in range(2):
            wanted = sorted((-scores[i, e], e) for e in range(p, n, 2))[: ks[i]]
            assert found.get((i, p), [])[: ks[i]] == wanted


@pytest.mark.parametrize("head_rows", [1, 5, 1000])
@pytest.mark.parametrize("named_only", ["after", "before"])
def test_embeddings_stored_by_norm(spark, world, tmp_path, head_rows, named_only):
    sinks.write_by_norm(world.embeddings, str(tmp_path), head_rows)
    stored = read_by_norm(spark, str(tmp_path))
    assert bag(stored.all) == bag(world.embeddings)
    asked = requests()
    table = spark.createDataFrame(asked, schemas.KNN_REQUEST)
    found = knn(table, stored, world.operator_table, world.name_table, world.relation_table, named_only=named_only)
    close(bag(found), world.expected(asked, named_only))


def test_blocks_of_short_embeddings_are_not_read(spark, tmp_path):
    rng = np.random.default_rng(1)
    rows = [(p, i, v.tolist()) for p in (0, 1) for i, v in enumerate(skewed(20_000, rng).astype(np.float32))]
    table = spark.createDataFrame(rows, schemas.EMBEDDING)
    sinks.write_by_norm(table, str(tmp_path), head_rows=50, block_bytes=100_000)
    stored = read_by_norm(spark, str(tmp_path))
    asked = knn_module._Asked(np.arange(20), rng.normal(size=(20, 8)), np.full(20, 5))
    whole = knn_module._top(knn_module._scan(table, asked), ["question_id", "partition"], "_place", 5)
    found = knn_module._top(knn_module._scan_by_norm(stored, asked, 5), ["question_id", "partition"], "_place", 5)
    columns = ["question_id", "partition", "index", "dist"]
    assert bag(found, *columns) == bag(whole, *columns)
    floors = {p: np.full(20, 100.0) for p in (0, 1)}
    long_ones = stored.rest.where(knn_module.long_enough(asked, floors))
    plan = long_ones._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(norm" in plan
    assert 0 < long_ones.count() < 10_000


def test_cells_are_bounded_by_bytes():
    for questions, dimension in ((10, 100), (10**6, 100), (10**9, 1000)):
        shares, entities = knn_module.cell_shares(questions, 0, dimension, 1 << 26)
        assert (-(-questions // shares) + entities) * 8 * dimension <= 1 << 26
    shares, entities = knn_module.cell_shares(10**9, 0, 64, 1 << 26)
    assert abs(entities - 10**9 / shares) < 2  # balanced between the sides


def test_dimension_is_checked(spark):
    mixed = spark.createDataFrame([(0, 0, [1.0, 2.0]), (0, 1, [1.0])], schemas.EMBEDDING)
    with pytest.raises(Exception, match="dimension is not"):
        check_embeddings(mixed, 2).collect()
    with pytest.raises(ValueError, match="same dimension"):
        blocks.matrix(pa.array([[1.0, 2.0], [1.0], [3.0]], pa.list_(pa.float32())))
    with pytest.raises(ValueError, match="same dimension"):
        blocks.matrix(pa.array([[1.0, 2.0, 3.0], [1.0]], pa.list_(pa.float32())))


# Scores, negatives and ranks


def edges_of(spark, world):
    rng = np.random.default_rng(2)
    pairs = [(int(a), int(r), int(b)) for a, r, b in zip(rng.integers(60, size=40), rng.integers(3, size=40), rng.integers(60, size=40))]
    pairs += [(7, 1, 8)] * 20  # copies
    rows = [(world.position[a][1], world.position[b][1], r, world.position[a][0], world.position[b][0]) for a, r, b in pairs]
    return pairs, spark.createDataFrame(rows, schemas.CODED)


def entity(partition, index):
    return index * PARTITIONS + partition


@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize("side", ["lhs", "rhs"])
def test_scores(spark, world, side, hot):
    pairs, edges = edges_of(spark, world)
    keys = evaluate.hot_positions(edges, min_hits=10) if hot else ()
    assert len(keys) == (2 if hot else 0)
    found = bag(evaluate.score_triples(edges, world.embeddings, world.operator_table, side, keys))
    wanted = []
    for a, r, b in pairs:
        source, target = (a, b) if side == "lhs" else (b, a)
        score = world.operators[r, side](world.vectors[source].astype(float)) @ world.vectors[target].astype(float)
        wanted.append((world.position[a][1], world.position[b][1], r, world.position[a][0], world.position[b][0], score))
    wanted.sort(key=repr)
    assert len(found) == len(wanted)
    order = lambda row: (row[:5], row[5])
    for got, want in zip(sorted(found, key=order), sorted(wanted, key=order)):
        assert got[:5] == want[:5] and got[5] == pytest.approx(want[5], rel=1e-9)


def test_negatives_are_uniform_over_all_partitions(spark):
    sizes = {0: 10, 2: 30, 5: 60}
    entities = spark.createDataFrame([(p, i) for p, n in sizes.items() for i in range(n)], "partition int, index int")
    edges = spark.createDataFrame([(0, i, 0, 0, 2) for i in range(30)], schemas.CODED)
    drawn = evaluate.negative_samples(edges, entities, n=200)
    rows = drawn.collect()
    assert len(rows) == 6000 and len({(r.obj, r.draw) for r in rows}) == 6000
    seen = {}
    for r in rows:
        seen[r.cand_part, r.cand_index] = seen.get((r.cand_part, r.cand_index), 0) + 1
    assert set(seen) == {(p, i) for p, n in sizes.items() for i in range(n)}
    assert 25 < min(seen.values()) and max(seen.values()) < 110
    assert bag(drawn) == bag(evaluate.negative_samples(edges.repartition(3), entities, n=200))
    assert bag(drawn) != bag(evaluate.negative_samples(edges, entities, n=200, seed=12))


@pytest.mark.parametrize("side", ["lhs", "rhs"])
def test_ranks(spark, world, side):
    pairs, edges = edges_of(spark, world)
    ranks = evaluate.rank_edges(edges, world.embeddings, world.operator_table, n=15, side=side)
    drawn = evaluate.negative_samples(
        edges.distinct(), world.embeddings, n=15, side="rhs" if side == "lhs" else "lhs"
    ).collect()
    candidates = {}
    for r in drawn:
        candidates.setdefault((r.part_left, r.subj, r.rel, r.part_right, r.obj), []).append(entity(r.cand_part, r.cand_index))
    rows = ranks.collect()
    assert sum(r.copies for r in rows) == len(pairs)
    total = 0.0
    for r in rows:
        a, b = entity(r.part_left, r.subj), entity(r.part_right, r.obj)
        source, target = (a, b) if side == "lhs" else (b, a)
        projected = world.operators[r.rel, side](world.vectors[source].astype(float))
        scores = world.vectors.astype(float) @ projected
        others = candidates[r.part_left, r.subj, r.rel, r.part_right, r.obj]
        assert len(others) == 15
        assert r.rank == 1 + sum(scores[c] > scores[target] + 1e-12 for c in others)
        total += r.copies / r.rank
    summary = evaluate.rank_summary(ranks, 1, 10).first()
    assert summary.edges == len(pairs) and summary.mrr == pytest.approx(total / len(pairs))
    assert 0 <= summary.hits_at_1 <= summary.hits_at_10 <= 1


def test_a_cell_is_bounded_in_work_and_not_only_in_bytes():
    """A million questions of few bytes against as many embeddings: cells of bounded work, not one of all that fits."""
    shares, entities = knn_module.cell_shares(1_000_000, 1_000_000, 4, 1 << 40)
    assert math.ceil(1_000_000 / shares) * entities <= knn_module.CELL_PAIRS
    assert math.ceil(1_000_000 / entities) * shares >= 400


def test_few_cells_are_not_put_together_in_one_task(spark, monkeypatch):
    """Small cells are much work for their bytes: each has a task, whatever their bytes."""
    monkeypatch.setattr(knn_module, "CELL_PAIRS", 40 * 40)
    rows = spark.range(200).select(F.lit(0).alias("partition"), F.col("id").cast("int").alias("index"), F.array(F.col("id").cast("float"), F.lit(1.0).cast("float")).alias("embedding"))
    asked = spark.range(200).select(F.col("id").alias("question_id"), F.array(F.lit(1.0), F.lit(0.0)).alias("vector"), F.lit(3).alias("k"))
    hits = knn_module._grid(rows, asked, *knn_module.cell_shares(200, 600, 2, 1 << 30))
    assert hits.rdd.getNumPartitions() == 25
    assert {r["index"] for r in hits.orderBy(F.desc("dist")).limit(600).collect()} == {197, 198, 199}


def test_scores_ruled_out_in_single_precision_are_those_that_lose():
    """Against a full comparison: ties, zeros, copies and vectors of very small and very large norm."""
    draw = np.random.default_rng(5)
    for trial in range(6):
        vectors, asked = draw.normal(size=(6000, 8)), draw.normal(size=(300, 8))
        if trial == 1:
            vectors, asked = np.round(vectors), np.round(asked)
        elif trial == 2:
            vectors[:] = vectors[0]
        elif trial == 3:
            vectors *= 10.0 ** draw.integers(-42, 14, size=(6000, 1))
        elif trial == 4:
            asked[::5], vectors[::3] = 0, 0
        elif trial == 5:
            asked *= 10.0 ** draw.integers(-30, 20, size=(300, 1))
        with np.errstate(all="ignore"):
            vectors = vectors.astype(np.float32).astype(np.float64)
            scorer = blocks.Scorer(np.arange(300), asked, np.full(300, 7))
            scorer.add(np.zeros(6000, int), np.arange(6000), vectors)
            scores = np.einsum("qd,ed->qe", asked, vectors).astype(np.float32)
        found = {}
        for batch in scorer.drain():
            for row in batch.to_pylist():
                found.setdefault(row["question_id"], []).append(row["dist"])
        # By score: what ties for the last place may differ by the rounding of the sums.
        for question in range(300):
            np.testing.assert_allclose(sorted(found[question]), np.sort(scores[question])[-7:], rtol=1e-6)
