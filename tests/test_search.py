"""Name search against a plain Python scan of all names."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from rows import bag

from graphprep.functions import postings
from graphprep.operators import lookup, name_index, search

WORDS = ["red", "blue", "the", "widget", "Bolt", "", "röd", "in", "İx"]


def names_and_requests():
    draw = random.Random(3)
    names = [
        (" ".join(draw.choice(WORDS) for _ in range(draw.randint(1, 4))) + draw.choice(["", " the"]), f"/e/{i}", i % 17)
        for i in range(400)
    ]
    queries = [" ".join(draw.choice(WORDS) for _ in range(draw.randint(1, 3))) for _ in range(40)]
    queries += ["", "the", "THE red", "red red", "widge", "ge", "e", "zzz", " ", "a  b", "d b"]
    requests = [(i, q, draw.choice([0, 1, 5, 300, 2**31 - 1]), draw.choice([0, 1, 7, 150])) for i, q in enumerate(queries)]
    # A third of all requests ask the same.
    requests += [(1000 + i, "the", 3, i) for i in range(25)]
    return names, requests


def frames(spark, names, requests):
    return (
        spark.createDataFrame(requests, "query_id long, query string, limit int, offset int"),
        spark.createDataFrame(names, "name string, ent string, count long"),
    )


def expected(requests, hits):
    rows = []
    for query_id, query, limit, offset in requests:
        found = hits(query)
        rows += [
            (query_id, offset + place + 1, value, label, len(found))
            for place, (value, label) in enumerate(found[offset : offset + limit])
        ]
    return sorted(rows, key=repr)


@pytest.fixture(params=["few requests", "many requests"])
def size(request, monkeypatch):
    if request.param == "many requests":
        monkeypatch.setattr(lookup, "SMALL_ROWS", 3)
        monkeypatch.setattr(search, "BROADCAST_PAGES", 10)
        monkeypatch.setattr(name_index, "RANGE_BITS", 5)
        monkeypatch.setattr(name_index, "FLUSH_CHARS", 200)
        monkeypatch.setattr(search, "hot_keys", lambda df, *keys: lookup.hot_keys(df, *keys, min_hits=20))


def test_word_search(spark, size):
    names, requests = names_and_requests()

    def hits(query):
        wanted = set(query.lower().split(" "))
        found = [n for n in names if wanted <= set(n[0].lower().split(" "))]
        return [(uri, f"{name} {count} {uri}") for name, uri, count in sorted(found, key=lambda n: (-n[2], n[1]))]

    asked, table = frames(spark, names, requests)
    assert bag(search.word_search(asked, table)) == expected(requests, hits)


def test_substring_search(spark, size):
    names, requests = names_and_requests()

    def hits(query):
        return sorted((uri, name) for name, uri, _ in names if query.lower() in name.lower())

    asked, table = frames(spark, names, requests)
    labels = table.selectExpr("ent as uri", "name as label")
    assert bag(search.substring_search(asked, labels)) == expected(requests, hits)


def test_empty_tokens(spark):
    asked, table = frames(spark, [("a  b", "/1", 1), ("a b", "/2", 1)], [(1, "a ", 10, 0)])
    assert bag(search.word_search(asked, table), "value") == [("/1",)]


def test_word_index_holds_each_token_once(spark):
    _, table = frames(spark, [("Red red Bolt", "/1", 1)], [(0, "", 0, 0)])
    assert bag(search.word_index(table)) == [("bolt", "/1"), ("red", "/1")]


def test_negative_pages_are_rejected(spark):
    asked, table = frames(spark, [("a", "/1", 1)], [(1, "a", -1, 0)])
    with pytest.raises(Exception, match="must not be negative"):
        search.word_search(asked, table).collect()


def test_pages_are_cut_from_the_lists_of_matches(spark):
    """A question's matches beyond what is asked are never rows, and nothing is sorted by count."""
    asked, table = frames(spark, *names_and_requests())
    index = name_index.scratch_index(table, name_index.WORD)
    questions = search._ask(asked, F.lower("query")).questions.where("question = 'the'")
    found = name_index.matches(questions, index).collect()
    assert sum(r["n"] for r in found) > 100 and len(found) == 1
    first = search.word_search(spark.createDataFrame([(1, "the", 3, 2)], asked.schema), index)
    assert bag(first, "rank") == [(3,), (4,), (5,)]


def test_a_search_reads_the_buckets_of_its_terms(spark, tmp_path):
    _, table = frames(spark, *names_and_requests())
    index = name_index.write_word_index(table, str(tmp_path))
    assert len(list((tmp_path / "postings").glob("bucket=*"))) > 4
    few = index.postings.where(F.col("bucket").isin([1, 2]))
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan and "IN (1,2)" in plan
    asked = spark.createDataFrame([(1, "red the", 5, 0), (2, "zzz", 5, 0), (3, "the zzz", 5, 0)], "query_id long, query string, limit int, offset int")
    again = name_index.read_index(spark, str(tmp_path), name_index.WORD)
    assert bag(search.word_search(asked, again)) == bag(search.word_search(asked, table))


def test_two_common_words_leave_only_their_intersection(spark):
    rows = [(f"left {i}" if i % 2 else f"right {i}", f"/{i:04d}", 1) for i in range(2000)] + [("left right", "/x", 1)]
    asked, table = frames(spark, rows, [(1, "right left", 10, 0)])
    index = name_index.scratch_index(table, name_index.WORD)
    found = name_index.matches(search._ask(asked, F.lit("left right")).questions, index).collect()
    assert [(r["n"], len(r["ids"])) for r in found] == [(1, 1)]
    few = np.array([5, 900_000])
    assert postings.met(few, np.arange(0, 10**6, 5)).tolist() == [5, 900_000]


def test_places_of_trigrams_must_fit(spark):
    labels = [("/1", "abcabd"), ("/2", "abcd"), ("/3", "bcdabc"), ("/4", "xabcdé😀y"), ("/5", "ab"), ("/6", "")]
    asked = [(i, q, 10, 0) for i, q in enumerate(["abcd", "bcabd", "cabcd", "dé😀", "é😀y", "b", "ab", "", "xabcdé😀y", "xabcdé😀yy"])]
    table = spark.createDataFrame(labels, "uri string, label string")
    requests = spark.createDataFrame(asked, "query_id long, query string, limit int, offset int")
    wanted = sorted((i, uri) for i, q, _, _ in asked for uri, label in labels if q in label)
    assert bag(search.substring_search(requests, table), "query_id", "value") == sorted(wanted, key=repr)


@given(st.lists(st.sets(st.integers(0, 2**40), min_size=1), max_size=8))
@settings(max_examples=80, deadline=None)
def test_blocks_give_back_their_numbers(groups):
    lists = [sorted(g) for g in groups]
    values = np.array([v for g in lists for v in g], np.int64)
    begins = np.cumsum([0, *map(len, lists)])[: len(lists)].astype(np.int64)
    data, starts = postings.encode(values, begins)
    cuts = [*starts.tolist(), len(data)]
    assert [postings.decode(data[a:b].tobytes()).tolist() for a, b in zip(cuts[:-1], cuts[1:])] == lists


def test_nothing_to_search(spark):
    asked, table = frames(spark, [("a", "/1", 1)], [(1, "a", 5, 0)])
    labels = table.selectExpr("ent as uri", "name as label")
    for requests, names in ((asked.limit(0), table), (asked, table.limit(0))):
        assert bag(search.word_search(requests, names)) == []
    for requests, names in ((asked.limit(0), labels), (asked, labels.limit(0))):
        assert bag(search.substring_search(requests, names)) == []


def test_names_may_be_null(spark):
    asked, table = frames(spark, [("a", "/1", 1), (None, "/2", 1)], [(1, "a", 5, 0), (2, "", 5, 0)])
    assert bag(search.word_search(asked, table), "query_id", "value") == [(1, "/1")]
    found = search.substring_search(asked, table.selectExpr("ent as uri", "name as label"))
    assert bag(found, "query_id", "value") == [(1, "/1"), (2, "/1")]
