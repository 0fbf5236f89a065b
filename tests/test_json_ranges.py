"""Large JSON documents, read in byte ranges, against the json module."""

import json
import random
from types import SimpleNamespace

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from graphprep.sources import documents, json_ranges
from graphprep.sources.json_ranges import read_list, read_map

RANGES = "spark.sql.files.maxPartitionBytes"


@pytest.fixture(params=[None, 900])
def width(spark, request):
    """Bytes of a range: the default, and some, fewer than long strings have."""
    old = spark.conf.get(RANGES), spark.conf.get("spark.sql.files.openCostInBytes")
    if request.param:
        spark.conf.set(RANGES, request.param)
        spark.conf.set("spark.sql.files.openCostInBytes", 0)
    yield request.param
    spark.conf.set(RANGES, old[0])
    spark.conf.set("spark.sql.files.openCostInBytes", old[1])


def names(n, seed=1):
    draw = random.Random(seed)
    parts = ["/m/0", ",", '"', "\\", "é", "😀", "[", "]", "{", "}", ":", " ", "\n", ",,", '",', '\\"', "x" * 90 + ","]
    return ["".join(draw.choices(parts, k=draw.randrange(0, 9))) + str(i) for i in range(n)]


def listed(table):
    rows = sorted((r["pos"], r["value"]) for r in table.collect())
    assert [p for p, _ in rows] == list(range(len(rows)))
    return [v for _, v in rows]


@pytest.mark.parametrize(("indent", "ascii_"), [(None, True), (2, False)])
def test_lists(spark, tmp_path, width, indent, ascii_):
    body = {"more": [1, 2.5e3, [True, None, ["a", "b,c"]]], "entities": {"x": {"all": ["no"]}, "all": names(90), "all ": []}, "relations": names(30, 2), "all": ["neither"], "z": {}}
    path = tmp_path / "dictionary.json"
    path.write_text(json.dumps(body, indent=indent, ensure_ascii=ascii_))
    if width:
        assert json_ranges._fragments(spark, str(path)).select("start").distinct().count() > 5
    assert listed(read_list(spark, str(path), "entities", "all")) == body["entities"]["all"]
    assert listed(read_list(spark, str(path), "relations")) == body["relations"]
    assert sorted(map(tuple, documents.read_relation_ids(spark, str(path)).collect())) == list(enumerate(body["relations"]))


def test_maps(spark, tmp_path, width):
    maps = [dict(zip(names(60, seed), names(60, seed + 1))) for seed in (3, 7)]
    maps[1]["twice"], maps[0]["twice"] = None, "old"
    for number, body in enumerate(maps):
        text = json.dumps(body)
        (tmp_path / f"{number}.json").write_text(text[:-1] + ', "again": "1", "again": "2"}')
    found = {(r["document"][-6:-5], r["pos"]): (r["key"], r["value"]) for r in read_map(spark, str(tmp_path)).collect()}
    for number, body in enumerate(maps):
        entries = [*body.items(), ("again", "1"), ("again", "2")]
        assert [found[str(number), i] for i in range(len(entries))] == entries
    labels = dict(map(tuple, documents.read_label_map(spark, str(tmp_path)).collect()))
    assert labels == {**maps[0], **maps[1], "again": "2"}


def test_one_string_over_many_ranges(spark, tmp_path, width):
    body = {"a, b" * 200: "v" + "," * 3000 + '"', "k": "\\" * 50 + ",x" * 400}
    path = tmp_path / "labels.json"
    path.write_text(json.dumps(body))
    assert [(r["key"], r["value"]) for r in read_map(spark, str(path)).orderBy("pos").collect()] == list(body.items())
    path.write_text(json.dumps({"entities": {"all": list(body)}}))
    assert listed(read_list(spark, str(path), "entities", "all")) == list(body)


BROKEN = ["{", '{"a": "b"', '{"a": "b",}', '{"a" "b"}', '{"a": "b" "c": "d"}', '{"a": ["b"}', '{"a": "b"}}', '{"a": "b"} {}', '{"a": "b\\q"}', '{"a": nul}', '{"a", "b"}', '{"a": {"b": "c"}}', '{"a": "b}', '["a", "b"}']


class Fake:
    """Stands for the fragments' table: the three steps over given ranges, without Spark."""

    def __init__(self, ranges):
        self.batches = [pa.RecordBatch.from_pydict({"value": r, "document": ["d"] * len(r), "start": pa.array([i] * len(r), pa.int64())}) for i, r in enumerate(ranges)]
        self.sparkSession = self.sparkContext = self

    def broadcast(self, value):
        return SimpleNamespace(value=value)

    def mapInArrow(self, function, schema):
        rows = [row for batch in function(iter(self.batches)) for row in batch.to_pylist()]
        return SimpleNamespace(collect=lambda: rows)

    def entries(self, keys):
        begin, arrays = json_ranges._ranges(self)
        return self.mapInArrow(json_ranges._entries(self.broadcast(begin), keys), "").collect(), arrays.get("d", set())


@pytest.mark.parametrize("text", BROKEN)
@pytest.mark.parametrize("cut", [0, 1, 3])
def test_malformed_documents_are_an_error(text, cut):
    """The broken part in the first range, and in a later one."""
    if cut and text.startswith("{"):
        text = "{" + "".join(f'"k{i}": "v, w", ' for i in range(4)) + text[1:]
    fragments = text.split(",")
    ranges = [fragments[:cut], fragments[cut:]] if 0 < cut < len(fragments) else [fragments]
    with pytest.raises(ValueError):
        Fake(ranges).entries(None)


def test_lists_that_are_not_there(spark, tmp_path):
    path = tmp_path / "dictionary.json"
    path.write_text('{"entities": {"some": []}, "relations": {}}')
    for keys in (("entities", "all"), ("relations",)):
        with pytest.raises(ValueError, match="no such list"):
            read_list(spark, str(path), *keys)
    path.write_text('{"relations": ["a", ["b"]]}')
    with pytest.raises(Exception, match="not a string"):
        read_list(spark, str(path), "relations").collect()
    (tmp_path / "second.json").write_text('{"relations": []}')
    with pytest.raises(ValueError, match="2 documents"):
        read_list(spark, str(tmp_path), "relations")


def test_a_large_document_is_read_by_several_tasks(spark, tmp_path, width):
    if not width:
        pytest.skip("one size")
    spark.conf.set(RANGES, 1 << 20)
    body = [f"/m/{i:07d}, {'y' * (i % 50)}" for i in range(150_000)]
    path = tmp_path / "dictionary.json"
    path.write_text(json.dumps({"entities": {"all": body}, "relations": []}))
    assert path.stat().st_size > 5 << 20
    table = documents.read_entity_ids(spark, str(path))
    assert table.rdd.getNumPartitions() >= 5
    assert dict(map(tuple, table.collect())) == dict(enumerate(body))


@given(st.lists(st.text(alphabet='ab,"\\[]{}: é\n', max_size=8), max_size=12), st.data())
@settings(max_examples=150, deadline=None)
def test_any_cut_at_commas_gives_the_same_entries(values, data):
    """Without Spark: the three steps over any ranges of commas' fragments."""
    text = json.dumps({"x": {"y": values[:2]}, "l": values, "m": [[], {"n": 1}]})
    fragments = text.split(",")
    cuts = sorted(data.draw(st.sets(st.integers(1, max(1, len(fragments) - 1)), max_size=6)))
    rows, arrays = Fake([fragments[a:b] for a, b in zip([0, *cuts], [*cuts, len(fragments)]) if a < b]).entries(["l"])
    assert [(r["pos"], r["value"]) for r in rows] == list(enumerate(values))
    assert set(map(json.loads, arrays)) >= {"l"}
