"""Replacing and publishing tables."""

from collections import Counter

import pytest
from pyspark.sql import functions as F
from rows import bag

from graphprep import schemas
from graphprep.operators import names
from graphprep.operators.lookup import HOT_LIMIT, SUMMARY_ERROR, hot_keys
from graphprep.plans import catalog, jobs
from graphprep.sources import sinks, tables, versions


def entities_of(spark, n):
    return spark.createDataFrame([(i, f"/{i}", 0) for i in range(n)], schemas.ENTITY)


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "entities")
    sinks.write_entities(entities_of(spark, 5), path)
    broken = entities_of(spark, 900).withColumn("ent", F.when(F.col("index") < 800, F.col("ent")).otherwise(F.raise_error(F.lit("broken"))))
    with pytest.raises(Exception, match="broken"):
        sinks.write_entities(broken, path)
    assert tables.read_entities(spark, path).count() == 5
    assert [p.name for p in tmp_path.iterdir()] == ["entities"]
    sinks.write_entities(entities_of(spark, 7), path)
    assert tables.read_entities(spark, path).count() == 7
    # A table can be made from the one that it replaces.
    sinks.write_entities(tables.read_entities(spark, path).where("index < 3"), path)
    assert tables.read_entities(spark, path).count() == 3
    assert [p.name for p in tmp_path.iterdir()] == ["entities"]


def test_a_layout_changes_at_once_or_not_at_all(spark, tmp_path):
    root = str(tmp_path / "graph")
    with pytest.raises(FileNotFoundError):
        versions.current(spark, root)
    rows = [(f"/s{i % 9}", "/r", f"/o{i % 7}") for i in range(60)]
    triples = spark.createDataFrame(rows, schemas.TRIPLE)
    first = jobs.publish_dataset(triples, 2, root)
    assert jobs.current_dataset(spark, root) == first
    before = bag(tables.read_entities(spark, first.entities))
    old = tables.read_coded(spark, jobs.current_dataset(spark, root).split("train"))
    broken = triples.withColumn("obj", F.when(F.col("subj") != "/s3", F.col("obj")).otherwise(F.raise_error(F.lit("broken"))))
    with pytest.raises(Exception, match="broken"):
        jobs.publish_dataset(broken, 2, root)
    assert jobs.current_dataset(spark, root) == first and bag(tables.read_entities(spark, first.entities)) == before
    second = jobs.publish_dataset(triples.unionByName(triples.withColumn("subj", F.lit("/new"))), 2, root)
    assert jobs.current_dataset(spark, root) == second != first
    assert len(bag(tables.read_entities(spark, second.entities))) == len(before) + 1
    assert old.count() > 0  # who reads the old version can finish
    assert versions.drop_old(spark, root) == 1 and jobs.current_dataset(spark, root) == second


def test_the_last_stored_name_holds(spark, tmp_path):
    rows = [(f"n{i}", f"/e{i % 10}", (i * 7) % 50, i, 0) for i in range(200)]
    for part in range(2):
        table = spark.createDataFrame(rows[100 * part : 100 * part + 100], schemas.NAMES).coalesce(1)
        table.sortWithinPartitions("index").write.mode("append").parquet(str(tmp_path / f"p{part}"))
        file = next((tmp_path / f"p{part}").glob("part-*.parquet"))
        (tmp_path / "names").mkdir(exist_ok=True)
        (tmp_path / "names" / f"part-{part}.parquet").write_bytes(file.read_bytes())
    stored = tables.read_names(spark, str(tmp_path / "names"), placed=True).repartition(7)
    wanted = sorted((r[1], r[0]) for r in {row[1]: row for row in rows}.values())
    assert bag(names.unique_names(stored, order="last"), "ent", "name") == wanted
    assert bag(names.unique_names(tables.read_names(spark, str(tmp_path / "names"))), "ent", "name") != wanted
    table, _ = jobs.load_names(spark, str(tmp_path / "names"), order="last")
    assert bag(table, "ent", "name") == wanted
    with pytest.raises(ValueError, match="unknown order"):
        names.unique_names(stored, order="first")


def test_all_frequent_keys_are_found_wherever_their_rows_lie(spark):
    """A hundred keys of a five-hundredth each, whose rows lie in a few tasks only, among as many that occur once."""
    n = 400_000
    key = F.when(F.col("id") % 10 < 2, F.concat(F.lit("hub"), (F.col("id") / 4000).cast("int"))).otherwise(F.concat(F.lit("x"), "id"))
    table = spark.range(0, n, 1, 23).select(key.alias("k"), F.lit(None).cast("string").alias("none"))
    found = hot_keys(table, "k", min_hits=700)
    assert set(found) == {f"hub{i}" for i in range(100)}
    assert SUMMARY_ERROR * n < 700 and len(found) <= HOT_LIMIT
    assert hot_keys(table, "none") == hot_keys(table.limit(0), "k") == []
    assert set(hot_keys(table.select(F.col("k").alias("a"), F.col("k").alias("b")), "a", "b", min_hits=1500)) == set(found)


def test_names_in_order_are_stored_by_several_tasks(spark, tmp_path, monkeypatch):
    """No one task reads all names; the files' order is that of the ranges."""
    monkeypatch.setattr(catalog, "scratch_path", lambda _, name: str(tmp_path / name))
    path = str(tmp_path / "sf")
    spark.range(3000).selectExpr("id as p_partkey", "concat('name ', id) as p_name").write.parquet(f"{path}/part.parquet")
    spark.range(9000).selectExpr("id * id % 2900 as l_partkey").write.parquet(f"{path}/lineitem.parquet")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = catalog.last_names(spark, path).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert len(list((tmp_path / "ordered-names").glob("part-*.parquet"))) > 1
    sold = Counter(i * i % 2900 for i in range(9000))
    wanted = {}
    for _, index in sorted((sold[index], index) for index in range(3000)):
        wanted[f"/group/{index % 97}"] = wanted[f"/part/{index}"] = index
    assert {r["ent"]: r["index"] for r in found} == wanted
