"""The URL cascade against a set, language-model scores against a model in plain Python."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from graphprep import workspace
from graphprep.llm import lm_scoring, url_cascade
from graphprep.llm.queries import RULES


@pytest.mark.parametrize("broadcast", [True, False])
@pytest.mark.parametrize("share", [0.0, 0.05, 0.6, 1.0])
def test_membership_is_exact(spark, monkeypatch, broadcast, share):
    random.seed(9)
    keys = [f"host{i}.example" for i in range(1500)] + [""]
    listed = {k for k in keys if random.random() < share}
    monkeypatch.setattr(url_cascade, "SHARD_BITS", 4096)
    if not broadcast:
        monkeypatch.setattr(url_cascade, "BROADCAST_BYTES", 0)
    universe = spark.createDataFrame([(k, k in listed) for k in keys] + [(None, True)], "key string, listed boolean")
    rows = spark.createDataFrame([(i, k) for i, k in enumerate(keys * 2)], "i int, key string")
    found = url_cascade.judge_keys(rows, universe).collect()
    assert len(found) == 2 * len(keys)
    assert all(r["listed"] == (r["key"] in listed) for r in found)


URLS = [
    (1, "http://WWW.Example.ORG/es/1?x=/y", "www.example.org", "/es/1", "example.org/es/", "block"),
    (2, "https://example.org/en/100#a", "example.org", "/en/100", "example.org/en/1", "block"),
    (3, "https://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
    (4, "https://example.org", "example.org", "", None, "allow"),
    (5, "http://a.com/de/1", "a.com", "/de/1", "com/de/", "block"),
    (6, "http://acom/de/1", "acom", "/de/1", None, "allow"),
    (7, "http://com/fr/", "com", "/fr/", "com/fr/", "allow"),
    (8, None, "", "", None, "allow"),
    (9, "no scheme/de/", "", "", None, "allow"),
    (10, "http://x?u=http://y.com/de/", "x", "", None, "allow"),
    (11, "http://bad.net/p", "bad.net", "/p", None, "block"),
    (12, "a\nb://É.net/p\n?q", "É.net", "/p\n", None, "allow"),
    (13, "http://bad.org/p", "bad.org", "/p", "org/", "allow"),
    (13, "http://bad.org/p", "bad.org", "/p", "org/", "allow"),
]


def test_urls(spark):
    pages = spark.createDataFrame([(u[0], u[1], "x") for u in URLS], "page_id bigint, url string, key string")
    listed = spark.createDataFrame([("bad.net/p",), ("bad.org/p",), ("nowhere",), (None,)], "key string")
    found = [(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in url_cascade.judge_urls(pages, RULES, listed).collect()]
    assert sorted(found, key=str) == sorted([(u[0], *u[2:]) for u in URLS], key=str)
    assert url_cascade.judge_urls(pages.limit(0), RULES, listed).count() == 0
    assert url_cascade.judge_urls(pages, RULES, listed.limit(0)).where("listed").count() == 0


def brute_scores(texts, targets, least=2):
    words = [(t or "").split() for t in texts]
    count = Counter(w for ws in words for w in ws)
    total = sum(count.values())
    known = {w for w, n in count.items() if n >= least}
    seqs = [[w if w in known else None for w in ws] for ws in words]
    pairs = Counter(p for s in seqs for p in zip(s, s[1:]))
    kept = {p for p, n in pairs.items() if n >= least}

    def model(chosen):
        one = Counter(w for s in chosen for w in s)
        two = Counter(p for s in chosen for p in zip(s, s[1:]))
        n = sum(one.values())
        single = lambda w: (one[w] + 0.5) / (n + 0.5 * (len(known) + 1))
        share = lambda v, w: two[v, w] / one[v] if (v, w) in kept and one[v] else 0.0
        own = Counter()
        for v, w in kept:
            own[v] += share(v, w)

        def p(v, w):
            return 0.7 * share(v, w) + (1 - 0.7 * own[v]) * single(w)

        return single, p

    models = [model(seqs), model([s for s, t in zip(seqs, targets) if t])]
    for _, p in models:  # probabilities sum to one
        assert sum(p(next(iter(known)), w) for w in [*known, None]) == pytest.approx(1)
    losses = []
    for s in seqs:
        losses.append([-(math.log(single(s[0])) + sum(math.log(p(v, w)) for v, w in zip(s, s[1:]))) / len(s) if s else None for single, p in models])
    return losses


def test_scores_match_plain_python(spark, docs_of, monkeypatch):
    random.seed(6)
    good = [f"g{i}" for i in range(30)]
    bad = [f"b{i}" for i in range(30)]
    texts = [" ".join(random.choices(good if i % 2 else bad, k=random.randrange(1, 60))) for i in range(60)] + [None, "", "rare"]
    labels = spark.createDataFrame([(i, int(i % 2 and i < 30)) for i in range(40)] + [(1, 1), (1, 0), (None, 1)], "doc_id bigint, quality int")
    monkeypatch.setattr(lm_scoring, "CHUNK", 50)
    rows = {r["doc_id"]: r for r in lm_scoring.score(docs_of(texts, clashing=True), labels).collect()}
    expected = brute_scores(texts, [i % 2 and i < 30 for i in range(len(texts))])
    for i, (background, target) in enumerate(expected):
        r = rows[i]
        assert r["n_words"] == len((texts[i] or "").split())
        if background is None:
            assert r["difference"] is None
        else:
            assert r["background_loss"] == pytest.approx(background)
            assert r["target_loss"] == pytest.approx(target)
            assert r["difference"] == pytest.approx(target - background)
    # Held out: good documents without a label score lower than bad ones.
    held = [(rows[i]["difference"], i % 2) for i in range(31, 60)]
    wins = [a < b for a, g in held if g for b, h in held if not h]
    assert np.mean(wins) > 0.95


def test_odd_documents_are_scored(spark, odd, empty):
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    assert lm_scoring.score(odd, labels).count() == odd.count()
    assert lm_scoring.score(empty, labels).count() == 0
    assert lm_scoring.score(odd.where(F.col("text") == ""), labels).first()["difference"] is None


def test_entries_are_kept_from_two_at_every_size(spark, docs_of):
    """Of 2.4 million words, a bigram that occurs twice has a probability of its own, and its loss is that of the formula."""
    texts = [" ".join(["filler"] * 600_000)] * 4 + ["left right", "left right", "once left"]
    labels = spark.createDataFrame([(4, 1), (5, 1)], "doc_id bigint, quality int")
    found = {r["doc_id"]: r for r in lm_scoring.score(docs_of(texts), labels).collect()}
    n = 2_400_000 + 6
    size = 4  # filler, left, right, all others
    p = lambda c, total: (c + 0.5) / (total + 0.5 * size)
    background = -(math.log(p(3, n)) + math.log(0.7 * 2 / 3 + (1 - 0.7 * 2 / 3) * p(2, n))) / 2
    target = -(math.log(p(2, 4)) + math.log(0.7 + 0.3 * p(2, 4))) / 2
    assert len(found) == len(texts)
    assert found[4]["background_loss"] == pytest.approx(background)
    assert found[4]["target_loss"] == pytest.approx(target)


@pytest.mark.parametrize("hot", [0.0, 0.02, 1.0])
def test_looked_up_and_sent_entries_score_alike(spark, docs_of, monkeypatch, hot):
    random.seed(8)
    texts = [" ".join(random.choice(["a", "b", "c", f"x{random.randrange(60)}", f"once{i}_{j}"]) for j in range(random.randrange(1, 30))) for i in range(40)]
    monkeypatch.setattr(lm_scoring, "HOT_SHARE", hot)
    monkeypatch.setattr(lm_scoring, "CHUNK", 70)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id bigint, quality int")
    rows = {r["doc_id"]: r for r in lm_scoring.score(docs_of(texts), labels).collect()}
    for i, (background, target) in enumerate(brute_scores(texts, [i % 2 for i in range(40)])):
        assert rows[i]["background_loss"] == pytest.approx(background)
        assert rows[i]["target_loss"] == pytest.approx(target)


def test_blocks_and_ranges_of_any_size_score_alike(spark, docs_of, monkeypatch):
    """A null, an empty text and words without a block of their own; ranges of a few words each."""
    random.seed(9)
    texts = [" ".join(random.choice(["a", "b", "c", f"x{random.randrange(60)}", f"once{i}_{j}"]) for j in range(random.randrange(0, 40))) for i in range(50)] + [None]
    labels = spark.createDataFrame([(i, i % 3 == 0) for i in range(51)], "doc_id bigint, quality boolean").select("doc_id", F.col("quality").cast("int"))
    expected = brute_scores(texts, [i % 3 == 0 for i in range(51)])
    for chunk, documents, range_ in ((30, 7, 20), (10_000, 3, 5)):
        monkeypatch.setattr(lm_scoring, "CHUNK", chunk)
        monkeypatch.setattr(lm_scoring, "DOCUMENTS", documents)
        monkeypatch.setattr(lm_scoring, "RANGE", range_)
        rows = {r["doc_id"]: r for r in lm_scoring.score(docs_of(texts), labels).collect()}
        for i, (background, target) in enumerate(expected):
            if background is None:
                assert rows[i]["difference"] is None and rows[i]["n_words"] == 0
            else:
                assert rows[i]["background_loss"] == pytest.approx(background)
                assert rows[i]["target_loss"] == pytest.approx(target)


def test_scoring_stores_little(spark, tmp_path, monkeypatch):
    """All intermediate tables together, each of which is kept until the end."""
    monkeypatch.setattr(workspace, "scratch_path", lambda spark, name: f"{tmp_path}/{name}")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lm_scoring.score(docs, spark.read.parquet("/root/testdata/sf0.01/labels.parquet")).write.format("noop").mode("overwrite").save()
    stored = sum(f.stat().st_size for f in tmp_path.rglob("*.parquet"))
    assert 0 < stored < 1.5 * docs.agg(F.sum(F.octet_length("text"))).first()[0]


def test_packed_numbers_come_back():
    arrays = [np.array([3, 2**63, 5], np.uint64), np.zeros(0, np.int64), np.arange(300, dtype=np.uint32)]
    for x, y in zip(arrays, lm_scoring.unpacked(lm_scoring.packed(*arrays), np.uint64, np.int64, np.uint32)):
        assert x.dtype == y.dtype and (x == y).all()
    assert (np.cumsum(lm_scoring.steps(np.sort(arrays[0])), dtype=np.uint64) == np.sort(arrays[0])).all()
