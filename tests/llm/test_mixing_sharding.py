"""Mixing by systematic sampling, resharding by flow, running sums."""

import itertools
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from graphprep.llm import mixing, resharding
from graphprep.llm.common import cumulate, word_count
from graphprep.llm.queries import QUERIES
from graphprep.workspace import scratch_path, stage


def test_word_count(spark):
    texts = [None, "", "  ", "a", " a", "a ", " a\tb\n", "a\x0bb\x0cc\rd", "a b c", "\x1c a"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = [r[0] for r in rows.orderBy("i").select(word_count(F.col("t"))).collect()]
    assert found == [len((t or "").encode().split()) for t in texts]


def test_running_sums(spark):
    random.seed(3)
    rows = [(random.choice(["a", "b", None]), random.randrange(50), i, random.randrange(9)) for i in range(500)]
    table = stage(spark.createDataFrame(rows, "g string, o int, i int, v int"), "t")
    found = cumulate(table, ["g"], ["o", "i"], {"before": F.col("v"), "rank": F.lit(1)}, "t").collect()
    sums, ranks = Counter(), Counter()
    expected = {}
    for g, o, i, v in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2])):
        expected[i] = (sums[g], ranks[g])
        sums[g] += v
        ranks[g] += 1
    assert {r["i"]: (r["before"], r["rank"]) for r in found} == expected


def targets(spark, sizes):
    found = mixing.source_targets(spark.createDataFrame(sizes, "source string, source_size bigint"))
    return {r["source"]: r["target"] for r in found.collect()}


def test_targets_are_filled_by_weight(spark):
    found = targets(spark, [("a", 100), ("b", 1000), ("c", 1000), (None, 0)])
    # 3150 words: a (5) and null (5) full, the rest by 2 : 1, b full at 2000, c the last.
    assert found == {"a": 200.0, "b": pytest.approx(1966.6667, abs=1e-3), "c": pytest.approx(983.3333, abs=1e-3), None: 0.0}
    assert targets(spark, []) == {}


def test_taken_words_come_near_their_targets(spark, docs_of):
    random.seed(1)
    rows = [(i, "w " * int(random.paretovariate(1.2) * 20), "en", random.choice("abcdefg")) for i in range(4000)]
    rows += [(5000, "w " * 9, "en", "a")] * 3
    plan = mixing.mix_plan(docs_of(rows)).collect()
    assert len(plan) == len(rows)
    taken, target, longest = Counter(), {}, Counter()
    for r in plan:
        assert 0 <= r["copies"] <= 2
        taken[r["source"]] += r["copies"] * r["size"]
        target[r["source"]] = r["target"]
        longest[r["source"]] = max(longest[r["source"]], r["size"])
    for source in target:
        assert abs(taken[source] - target[source]) <= longest[source]
    again = mixing.mix_plan(docs_of(rows).repartition(7)).collect()
    assert Counter((r["doc_id"], r["copies"]) for r in again) == Counter((r["doc_id"], r["copies"]) for r in plan)


def test_mix_returns_each_copy(spark, docs_of, odd, empty):
    rows = [(i, f"text {i} " * (i % 7 + 1), "en", f"s{i % 3}") for i in range(90)]
    plan = {r["doc_id"]: r["copies"] for r in mixing.mix_plan(docs_of(rows)).collect()}
    mixed = Counter(r["doc_id"] for r in mixing.mix(docs_of(rows)).collect())
    assert mixed == Counter({k: v for k, v in plan.items() if v})
    result = mixing.mix(odd)
    assert result.columns == odd.columns
    assert {r["doc_id"] for r in result.collect()} <= {1, 2, None, 3, 4, 5, 6, 7, 8}
    assert mixing.mix(empty).count() == 0


def test_flow_moves_the_fewest_bytes():
    random.seed(5)
    for _ in range(40):
        supply = {i: random.randrange(9) for i in range(3)}
        capacity = [random.randrange(1, 9) for _ in range(4)]
        if sum(supply.values()) > sum(capacity):
            with pytest.raises(ValueError):
                resharding.cheapest_flow(supply, capacity)
            continue
        flow = resharding.cheapest_flow(supply, capacity)
        moved = sum(n for (i, j), n in flow.items() if i != j)
        assert moved == sum(max(0, n - capacity[i]) for i, n in supply.items())
        for i, n in supply.items():
            assert sum(v for (a, _), v in flow.items() if a == i) == n
        for j, n in enumerate(capacity):
            assert sum(v for (_, b), v in flow.items() if b == j) <= n


def test_flow_follows_costs():
    supply, capacity = {0: 2, 1: 2}, [1, 2, 1]
    cost = {(i, j): random.Random(i * 7 + j).randrange(5) for i in supply for j in range(3)}
    flow = resharding.cheapest_flow(supply, capacity, cost)
    spent = sum(cost[a] * n for a, n in flow.items())
    best = min(
        sum(cost[i, j] for i, j in zip((0, 0, 1, 1), places))
        for places in itertools.product(range(3), repeat=4)
        if all(places.count(j) <= capacity[j] for j in range(3))
    )
    assert spent == best


def test_shards_are_even_and_gapless(spark, docs_of, tmp_path):
    random.seed(2)
    rows = [(i, "x" * random.randrange(400), "en", f"src{min(i % 40, 9)}") for i in range(3000)] + [(None, None, "en", None)] * 3
    docs_of(rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["op10_flow_resharding"](spark, str(tmp_path)).collect()
    assert len(found) == len(rows)
    size, slots = Counter(), defaultdict(list)
    texts = {r[0]: r[1] or "" for r in rows}
    for r in found:
        assert r["size"] == len(texts[r["doc_id"]].encode()) + 8
        assert r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode())
        size[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert set(size) == set(range(24))
    assert max(size.values()) - min(size.values()) <= 3 * 408
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    # Old shards lose what is above their new capacity, give or take a document for each block.
    old = Counter()
    for r in found:
        old[r["old_shard"]] += r["size"]
    stays = sum(r["size"] for r in found if r["old_shard"] == r["shard"])
    even = sum(old.values()) / 24
    assert abs(stays - sum(min(n, even) for n in old.values())) <= 24 * 408


def test_rewrite_leaves_other_shards_alone(spark, docs_of):
    rows = docs_of([(i, "x" * 92, "en", "s") for i in range(60)])
    table = stage(rows.select("doc_id", F.lit(100).cast("bigint").alias("size"), F.when(F.col("doc_id") < 40, 0).when(F.col("doc_id") < 60, 1).cast("int").alias("old"), F.col("doc_id").alias("id")), "t")
    path = scratch_path(spark, "shards")
    table.select("doc_id", F.col("old").alias("shard")).write.partitionBy("shard").parquet(path)
    kept = {f for f in spark.read.parquet(path).inputFiles() if "/shard=1/" in f}
    placed = resharding.assign(table, 3, ["doc_id"])
    written, emptied = resharding.rewrite(table.select("doc_id", "id"), placed, path)
    assert (written, emptied) == ([0, 2], [])
    after = spark.read.parquet(path)
    assert {f for f in after.inputFiles() if "/shard=1/" in f} == kept
    assert {(r["shard"], r["count"]) for r in after.groupBy("shard").count().collect()} == {(0, 20), (1, 20), (2, 20)}


def test_sharding_of_an_empty_table(spark, empty, tmp_path):
    empty.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    assert QUERIES["op10_flow_resharding"](spark, str(tmp_path)).count() == 0
