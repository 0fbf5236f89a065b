"""The n-gram Jaccard join against comparing all pairs."""

import random
from collections import defaultdict

import numpy as np
import pytest

from graphprep.llm import jaccard_join
from graphprep.llm.common import Shingles, shingle_set


def variants(seed, groups=25, size=5):
    random.seed(seed)
    word = lambda: "".join(random.choices("abcdefghij", k=4))
    rows = []
    for _ in range(groups):
        base = [word() for _ in range(random.randrange(8, 160))]
        for _ in range(random.randrange(1, size)):
            own = list(base)
            for _ in range(random.randrange(0, 6)):
                own[random.randrange(len(own))] = word()
            rows += [" ".join(own)] * random.choice([1, 1, 3])
    random.shuffle(rows)
    return rows


def brute(texts, threshold=0.8):
    sets = [shingle_set(t or "") for t in texts]
    links = defaultdict(int)
    root = list(range(len(texts)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= threshold:
                links[i] += 1
                links[j] += 1
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    return {i: (top(i), links[i]) for i in range(len(texts))}


@pytest.mark.parametrize("cell", [jaccard_join.CELL, 3])
def test_classes_and_links_match_all_pairs(docs_of, monkeypatch, cell):
    texts = variants(11)
    monkeypatch.setattr(jaccard_join.candidate_cells, "__defaults__", (cell,))
    monkeypatch.setattr(jaccard_join, "PAIRS", 50)
    rows = jaccard_join.near_duplicates(docs_of(texts)).collect()
    assert {r["doc_id"]: (r["class_id"], r["n_links"]) for r in rows} == brute(texts)


def test_one_of_each_group_stays(docs_of):
    texts = variants(12)
    docs = docs_of(texts, clashing=True)
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for c, _ in brute(texts).values()})


def test_odd_documents_stay_or_meet(odd, empty):
    found = sorted(jaccard_join.near_duplicates(odd).collect(), key=str)
    by_id = {r["doc_id"]: r for r in found}
    assert len(found) == 10
    assert by_id[1]["class_id"] == 1 and by_id[1]["n_links"] == 0  # null, empty and blank texts stand alone
    assert by_id[2]["class_id"] == 2 and by_id[3]["class_id"] == 3
    assert by_id[5]["class_id"] == 5 and by_id[6]["class_id"] == 5 and by_id[6]["n_links"] == 2
    kept = [r["doc_id"] for r in jaccard_join.keep_one(odd).collect()]
    assert sorted(kept, key=str) == sorted([1, 2, 3, None, 4, 5, 7, 8], key=str)
    assert jaccard_join.near_duplicates(empty).count() == 0
    assert jaccard_join.keep_one(empty).count() == 0


def test_hashes_follow_the_shingles():
    hashes = Shingles()
    hashes.segment = 7
    whole = Shingles()
    for text in variants(13):
        assert np.array_equal(hashes(text), whole(text))
        assert len(set(whole(text).tolist())) == len(shingle_set(text))
    assert whole("a b c d e f")[1] == whole("b  c\td e f")[0]
    assert len(whole(" \n")) == 0 and len(whole("x" * 200_000)) == 1


def test_pruning_keeps_what_can_reach_the_threshold():
    least = jaccard_join.least_matches(96, 0.8, 1e-6, 16)
    random.seed(2)
    lost = 0
    for _ in range(20_000):
        equal = np.cumsum([random.random() < 0.8 for _ in range(96)])[15::16]
        lost += any(e < m for e, m in zip(equal, least))
    assert lost == 0
    assert least[-1] > 96 * 0.5  # pairs far below the threshold are dropped


def test_minhash_estimates_similarity():
    hashes = Shingles()
    words = [f"w{i}" for i in range(2000)]
    a, b = hashes(" ".join(words)), hashes(" ".join(words[:1600] + [f"v{i}" for i in range(400)]))
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    same = (jaccard_join.minhash(a, 512) == jaccard_join.minhash(b, 512)).mean()
    assert abs(same - true) < 0.08
