"""Registered queries against their DuckDB twins, and the pipeline stage by stage."""

from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from compare import DATA, connect, difference

import __spark_entry__
from graphprep.llm import secret_scan
from graphprep.llm.common import shingle_set
from graphprep.llm.host_rules import MEASURES, measure
from graphprep.llm.oracle import ORACLE
from graphprep.llm.packing import Encoder, default_tokenizer
from graphprep.llm.queries import QUERIES

SF = f"{DATA}/sf0.001"


@pytest.mark.parametrize("name", ORACLE)
def test_matches_twin(spark, name):
    assert difference(QUERIES[name](spark, SF), connect("sf0.001"), ORACLE[name]) == ""


def test_queries_are_registered():
    names = set(__spark_entry__.queries())
    assert {*QUERIES, "pipeline"} <= names
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(__spark_entry__.oracle_sql())


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    frames = [docs]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(spark.createDataFrame(stage(spark, frames[-1], SF).toArrow()))
    start, good, single, masked, mixed, packed = ([r.asDict() for r in f.collect()] for f in frames)
    assert all(f.columns == columns for f in frames[:-1])

    def passes(row):
        m = dict(zip(MEASURES, measure(row["text"])))
        return m["n_words"] >= 50 and 100 * m["n_repeat_words"] <= 50 * m["n_words"]

    assert {r["doc_id"] for r in good} == {r["doc_id"] for r in start if passes(r)}  # no host is rejected here
    sets = {r["doc_id"]: shingle_set(r["text"]) for r in good}
    near = lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    ids = sorted(sets)
    left = {r["doc_id"] for r in single}
    group = {i: i for i in ids}
    for i in ids:
        for j in ids:
            if j < i and near(i, j):
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = {k: new if v == old else v for k, v in group.items()}
    assert left == set(group.values())
    texts = {r["doc_id"]: r["text"] for r in single}
    assert {r["doc_id"] for r in masked} == left
    for r in masked:
        assert r["n_chars"] == len(r["text"])
        if r["text"] != texts[r["doc_id"]]:
            assert secret_scan.MASK in r["text"] and secret_scan.scan(texts[r["doc_id"]])
    copies = Counter(r["doc_id"] for r in mixed)
    assert set(copies) <= left and max(copies.values()) <= 2
    words = sum(len(r["text"].encode().split()) for r in masked)
    taken = sum(len(r["text"].encode().split()) for r in mixed)
    assert abs(taken / words - 1.5) < 0.2
    encode = Encoder(*default_tokenizer())
    tokens = Counter()
    for r in packed:
        tokens[r["doc_id"]] += r["length"]
        assert len(r["ids"]) == 2 * r["length"]
    for r in mixed:
        assert tokens[r["doc_id"]] == copies[r["doc_id"]] * (len(encode(r["text"])) // 2 + 1)
    sizes = Counter()
    for r in packed:
        sizes[r["sequence_id"]] += r["length"]
    assert all(n == 1024 or np.log2(n) % 1 == 0 for n in sizes.values())


def test_run_gives_the_last_stage(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert rows.columns == ["doc_id", "source", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
