"""Parsing, filtering, dictionaries, splits and encoding on literal rows."""

import re

import pytest
from rows import bag
from pyspark.sql import functions as F

from graphprep.functions.text import RDFS_LABEL, extract_label
from graphprep.operators import dictionary, encode, filters, names, splits
from graphprep.operators.lookup import hot_keys, lookup_join, salted_join, unique_join
from graphprep.plans.jobs import import_triples
from graphprep.sources.text import parse_triples
from graphprep.workspace import stage


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_parse_takes_the_first_three_fields(spark):
    text = lines(spark, "a\tb\tc\t.", "a\tb\tc", "\tb\tc", 'a\tb\t"x, y"@en\t.')
    assert bag(parse_triples(text)) == sorted(
        [("a", "b", "c"), ("a", "b", "c"), ("", "b", "c"), ("a", "b", '"x, y"@en')], key=repr
    )


@pytest.mark.parametrize("bad", ["a\tb", "a\tb\t\t", "", "a"])
def test_malformed_lines(spark, bad):
    text = lines(spark, "a\tb\tc", bad)
    assert bag(parse_triples(text, "dropmalformed")) == [("a", "b", "c")]
    with pytest.raises(Exception, match="malformed triple"):
        parse_triples(text).collect()


def test_a_middle_field_may_be_empty_if_a_later_one_is_not(spark):
    assert bag(parse_triples(lines(spark, "a\tb\t\t."))) == [("a", "b", "")]


def test_import_reads_filters_and_keeps_copies(spark, tmp_path):
    (tmp_path / "part.txt").write_text("a\tr\tb\t.\n" * 5 + "a\tr\tc\t.\n")
    assert bag(import_triples(spark, str(tmp_path)), "subj", "rel", "obj") == [("a", "r", "b")] * 5


def test_counts_are_taken_before_filtering(triples):
    # x has five triples, three of them with rare entities; it stays with two.
    graph = triples(*["x r p1", "x r p2", "x r p3"], *["x r y"] * 2, *["y r y"] * 3)
    assert bag(filters.filter_min_count(graph)) == [("x", "r", "y")] * 2 + [("y", "r", "y")] * 3


def test_rare_relations_go(triples):
    graph = triples(*["x r y"] * 5, *["x s y"] * 4)
    assert bag(filters.filter_min_count(graph)) == [("x", "r", "y")] * 5


def test_a_self_loop_counts_once_as_triple_and_twice_as_endpoint(triples):
    graph = triples(*["a r a"] * 3)
    assert bag(filters.triples_per_entity(graph)) == [("a", 3)]
    ents, rels = dictionary.entity_dictionary(graph, 1), dictionary.relation_dictionary(graph)
    coded = encode.encode_triples(graph, ents, rels)
    assert bag(names.entity_names(coded, ents), "ent", "count") == [("a", 6)]


def test_subject_frequency_leaves_objects_out(triples):
    assert bag(names.subject_frequency(triples("a r b", "a r b", "b r c"))) == [("a", 2), ("b", 1)]


@pytest.mark.parametrize("partitions", [1, 3, 7])
def test_indexes_are_dense_and_unique(triples, partitions):
    graph = triples(*[f"s{i} r{i % 5} o{i % 700}" for i in range(3000)])
    ents = dictionary.entity_dictionary(graph, partitions)
    rows = ents.groupBy("partition").agg(
        F.min("index").alias("low"), F.max("index").alias("high"), F.count("*").alias("n"), F.countDistinct("index").alias("d")
    )
    for row in rows.collect():
        assert (row.low, row.high + 1, row.d) == (0, row.n, row.n)
    assert ents.count() == 3700
    assert bag(dictionary.relation_dictionary(graph), "index") == [(i,) for i in range(5)]


def test_dictionary_shuffles_the_distinct_keys_once(spark, triples):
    df = dictionary.entity_dictionary(stage(triples("a r b", "b r c"), "reuse"), 2)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("ReusedExchange") == 1 and plan.count("FileScan") == 1


def test_dictionary_does_not_depend_on_row_order(triples):
    rows = [f"s{i} r o{i % 50}" for i in range(200)]
    assert bag(dictionary.entity_dictionary(triples(*rows), 4)) == bag(
        dictionary.entity_dictionary(triples(*rows[::-1]).repartition(5), 4)
    )


def test_decode_inverts_encode_and_dropped_completes_it(triples):
    train = triples(*[f"s{i % 20} r{i % 3} o{i % 30}" for i in range(100)], "s1 r1 s1", "s1 r1 s1")
    other = triples("s1 r1 o1", "new r1 o1", "s1 new o1", "s1 r1 new", "new new new", "s1 r1 o1")
    ents, rels = dictionary.entity_dictionary(train, 3), dictionary.relation_dictionary(train)
    assert bag(encode.decode_triples(encode.encode_triples(train, ents, rels), ents, rels)) == bag(train)
    kept = encode.decode_triples(encode.encode_triples(other, ents, rels), ents, rels)
    dropped = encode.dropped_triples(other, ents, rels)
    assert bag(kept.union(dropped.drop("unknown"))) == bag(other)
    assert bag(dropped, "subj", "rel", "obj", "unknown") == [
        ("new", "new", "new", "subj,rel,obj"),
        ("new", "r1", "o1", "subj"),
        ("s1", "new", "o1", "rel"),
        ("s1", "r1", "new", "obj"),
    ]


def test_copies_share_a_hash_split(triples):
    rows = splits.split_triples(triples(*["a r b"] * 100))
    assert rows.select("split").distinct().count() == 1


def test_random_split_draws_as_random_split_does(spark, triples):
    graph = triples(*[f"s{i} r o{i % 7}" for i in range(1000)]).coalesce(1)
    ours = splits.split_triples(graph, "random")
    for name, theirs in zip(splits.WEIGHTS, graph.randomSplit(list(splits.WEIGHTS.values()), seed=splits.SEED)):
        assert bag(ours.where(F.col("split") == name).drop("split")) == bag(theirs)


def test_random_split_may_separate_copies(triples):
    rows = splits.split_triples(triples(*["a r b"] * 200), "random")
    assert rows.select("split").distinct().count() == 3


def test_english_labels(triples):
    graph = triples(
        ("a", RDFS_LABEL, '"x"@en-GB'),
        ("b", RDFS_LABEL, '"mail me@en.org"@de'),
        ("c", RDFS_LABEL, '"x"@de'),
        ("d", RDFS_LABEL, '"x"@en'),
        ("e", "other", '"x"@en'),
    )
    assert bag(filters.english_labels(graph), "subj") == [("a",), ("b",), ("d",)]
    assert bag(filters.english_labels(graph, strict=True), "subj") == [("d",)]


@pytest.mark.parametrize(
    "literal, label",
    [('"James Bond"@en', "James Bond"), ('"a \\"b\\" c"@en', " c"), ("noquote@en", "noquote@en"), ('one"q@en', "one")],
)
def test_extract_label(spark, literal, label):
    assert spark.range(1).select(extract_label(F.lit(literal))).first()[0] == label


def test_label_names_cover_only_labelled_entities(triples):
    graph = triples(
        "a r b", "b r a", ("a", RDFS_LABEL, '"Zed"@en'), ("a", RDFS_LABEL, '"Ann"@en'), ("r", RDFS_LABEL, '"likes"@en')
    )
    edges = graph.where(F.col("rel") == "r")
    ents, rels = dictionary.entity_dictionary(edges, 1), dictionary.relation_dictionary(edges)
    assert bag(names.label_entity_names(graph, ents), "name", "ent", "count") == [("Ann", "a", 3)]
    assert bag(names.label_relation_names(graph, rels), "name", "ent", "count", "partition") == [("likes", "r", 2, 0)]


def test_unique_names_keeps_the_most_frequent(spark):
    rows = [("x", "a", 1, 0, 0), ("y", "a", 2, 0, 0), ("z", "b", 2, 0, 0), ("w", "b", 2, 1, 0)]
    table = spark.createDataFrame(rows, "name string, ent string, count long, index int, partition int")
    assert bag(names.unique_names(table), "ent", "name") == [("a", "y"), ("b", "z")]
    assert bag(names.unique_names(table, "partition", "index"), "index", "name") == [(0, "z"), (1, "w")]


# Skew: one entity in a third of all rows, one triple in another third.


@pytest.fixture
def skewed(triples):
    return stage(
        triples(
            *[f"hub r{i % 3} o{i % 40}" for i in range(1000)],
            *["twin r0 twin2"] * 1000,
            *[f"s{i % 50} r1 o{i % 40}" for i in range(1000)],
        ),
        "skewed",
        row_ids=True,
    )


def test_hot_keys(skewed):
    assert set(hot_keys(skewed, "subj", "obj", min_hits=900)) == {"hub", "twin", "twin2"}
    assert hot_keys(skewed, "subj", "obj", min_hits=10_000) == []


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spreading_does_not_change_a_join(spark, skewed, how):
    known = spark.createDataFrame([("hub", 1), ("twin", None), ("s1", 3), ("s2", None), ("\0" + "1", 9)], "ent string, id int")
    plain = unique_join(skewed, known, "subj", "ent", how)
    spread = unique_join(skewed, known, "subj", "ent", how, ["hub", "twin", "absent", "s3"])
    assert spread.columns == plain.columns
    assert bag(spread) == bag(plain)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_null_and_numeric_keys(spark, how):
    left = spark.createDataFrame([(None, 0), (1, 1), (1, 2), (2, 3), (3, 4)], "k long, v int")
    right = spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string")
    assert bag(unique_join(left, right, "k", "id", how, [1, 3])) == bag(unique_join(left, right, "k", "id", how))


def test_salting_does_not_change_a_join(spark, skewed):
    known = spark.createDataFrame([("hub", 1), ("hub", 2), ("twin", 2), ("s1", 3)], "ent string, id int")
    salted = salted_join(skewed, known, "subj", "ent", ["hub", "twin", "absent"])
    assert bag(salted) == bag(salted_join(skewed, known, "subj", "ent"))


@pytest.mark.parametrize("join", [salted_join, lambda *a: unique_join(*a[:4], "inner", a[4])])
def test_copies_are_spread(spark, skewed, join):
    known = spark.createDataFrame([("twin", 2)], "ent string, id int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = join(skewed.where("subj = 'twin'"), known, "subj", "ent", ["twin"])
        sizes = [r[0] for r in joined.groupBy(F.spark_partition_id()).count().select("count").collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 1000 and len(sizes) > 1 and max(sizes) < 700


def test_a_lookup_too_large_to_broadcast_is_shuffled(spark, skewed):
    known = spark.createDataFrame([(f"r{i}", i) for i in range(10)], "name string, id int")
    small = lookup_join(skewed, known, "rel", "name")
    large = lookup_join(skewed, known, "rel", "name", max_rows=5)
    assert bag(small) == bag(large)


def test_hot_entities_do_not_change_filter_or_encoding(skewed):
    hot = ["hub", "twin", "twin2"]
    assert bag(filters.filter_min_count(skewed, hot=hot)) == bag(filters.filter_min_count(skewed))
    ents, rels = dictionary.entity_dictionary(skewed, 2), dictionary.relation_dictionary(skewed)
    assert bag(encode.encode_triples(skewed, ents, rels, hot)) == bag(encode.encode_triples(skewed, ents, rels))
    few = ents.where(F.col("ent") != "hub")
    assert bag(encode.dropped_triples(skewed, few, rels, hot)) == bag(encode.dropped_triples(skewed, few, rels))


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_a_key_is_sent_once(spark, how):
    """Beside the key that rows are dealt by, only hot rows carry their own; rows and nulls come out as they went in."""
    left = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("c", 4), (None, 5), ("d", 6)], "subj string, n int")
    right = spark.createDataFrame([("a", 10), ("b", 20)], "ent string, index int")
    joined = unique_join(left, right, "subj", "ent", how, ["a", "d"])
    sent = [line for line in _plan(joined).splitlines() if "AS _spread_key" in line]
    assert len(sent) == 1 and "subj#" not in re.sub(r"CASE WHEN.*?END", "", sent[0])
    plain = left.join(right, left["subj"] == right["ent"], how).drop("ent")
    key = lambda row: repr(tuple(row))
    assert joined.columns == plain.columns
    assert sorted(joined.collect(), key=key) == sorted(plain.collect(), key=key)


def test_digits_of_the_order_are_not_sent(spark):
    """A dictionary's keys are sent to their slice without the digest they are sorted by."""
    plan = _plan(dictionary.dense_index(spark.range(50).selectExpr("concat('/e/', id) as ent"), "ent", 3))
    above, below = plan.split("RepartitionByExpression")
    assert "_order" in above and "_order" not in below


def test_large_intermediate_tables_are_packed(spark):
    stored = stage(spark.range(5), "small", row_ids=True, packed=True)
    assert all(".zstd." in name for name in stored.inputFiles())


def test_triples_whose_slots_decide_are_not_shuffled(spark, monkeypatch):
    # Some entities are rare, some are not; there are many slots, or so few that none decides.
    ends = [F.concat(F.lit(end), F.col("id") % 4000 % (F.col("id") % 9 * 500 + 1)) for end in ("s", "o")]
    graph = stage(spark.range(20_000).select(ends[0].alias("subj"), F.lit("r").alias("rel"), ends[1].alias("obj")), "slots-test", row_ids=True)
    graph = graph.unionByName(spark.createDataFrame([(None, "r", "o1", 1), ("s1", "r", None, 2)] * 9, "subj string, rel string, obj string, _row smallint"))
    plain = bag(filters.filter_min_count(graph), "subj", "rel", "obj")
    asked = []

    def counting(left, *others):
        asked.append(left.count())
        return unique_join(left, *others)

    monkeypatch.setattr(filters, "unique_join", counting)
    monkeypatch.setattr(filters, "MANY_ENTITIES", 1)
    marked = filters.filter_min_count(graph)
    assert bag(marked, "subj", "rel", "obj") == plain
    semi = [line for line in marked._jdf.queryExecution().optimizedPlan().toString().splitlines() if "LeftSemi" in line]
    assert not [line for line in semi if "kept_rel" not in line]
    assert 0 < len(plain) < 20_000 and max(asked) < 4_000
    monkeypatch.setattr(filters, "_slot", lambda entity, slots: F.pmod(F.xxhash64(entity), F.lit(64)))
    assert bag(filters.filter_min_count(graph), "subj", "rel", "obj") == plain
    assert max(asked) > 4_000


def test_a_table_is_stored_by_folders_with_few_or_many_open_files(spark, monkeypatch):
    rows = spark.range(3000, numPartitions=1).select("id", (F.col("id") % 3).alias("folder"))
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", None)
    stored = stage(rows, "folders", partition_by=("folder",))
    assert bag(stored) == bag(rows)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", None) == before
    monkeypatch.setattr("graphprep.workspace.OPEN_WRITERS", 2)
    assert bag(stage(rows, "folders", partition_by=("folder",))) == bag(rows)
