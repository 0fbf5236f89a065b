"""Writers of the dataset layout. Every one of them replaces its target when the new table is whole (see ``versions.replacing``)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graphprep import schemas
from graphprep.functions.vectors import inner_product
from graphprep.operators import buckets
from graphprep.sources import versions
from graphprep.sources.versions import replacing
from graphprep.workspace import OPEN_WRITERS, open_writers


def write_entities(entities: DataFrame, path: str) -> None:
    """``partition=<p>/`` directories, sorted by index inside each file."""
    table = schemas.conform(entities, schemas.ENTITY)
    # Rebalancing gives few files per directory and splits a directory that is too large for one task.
    spread = table.hint("rebalance", "partition").sortWithinPartitions("partition", "index")
    with replacing(table.sparkSession, path) as fresh:
        spread.write.partitionBy("partition").parquet(fresh)


def write_relations(relations: DataFrame, path: str, files: int = 1) -> None:
    table = schemas.conform(relations, schemas.RELATION)
    spread = table.repartitionByRange(files, "index").sortWithinPartitions("index")
    with replacing(table.sparkSession, path) as fresh:
        spread.write.parquet(fresh)


def write_coded(coded: DataFrame, path: str, tasks: int | None = None) -> None:
    """``part_left=<a>/part_right=<b>/`` directories.

    By default the shuffle on the bucket columns is rebalanced at run time: buckets above the advisory partition size
    are split over several tasks and files, so a bucket holding a third of all edges does not end in one task. A fixed
    number of ``tasks`` gives one file per bucket.
    """
    table = schemas.conform(coded, schemas.CODED)
    if tasks is None:
        spread = table.hint("rebalance", "part_left", "part_right")
    else:
        spread = table.repartition(tasks, "part_left", "part_right")
    with replacing(table.sparkSession, path) as fresh:
        spread.write.partitionBy("part_left", "part_right").parquet(fresh)


def write_coded_splits(coded: DataFrame, paths: dict[str, str]) -> None:
    """``write_coded`` for several splits in one job; the column ``split`` is the place, from 1, of each triple's split in ``paths``.

    All are written to one folder beside the first of ``paths``, whose subfolders then take the places of the splits.
    """
    spark = coded.sparkSession
    table = coded.select("split", *[F.col(f.name).cast(f.dataType) for f in schemas.CODED.fields])
    spread = table.hint("rebalance", "split", "part_left", "part_right")
    together = f"{next(iter(paths.values())).rstrip('/')}.splits-{uuid.uuid4().hex[:12]}"
    files, folder = versions.files_of(spark, together)
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    try:
        spread.write.partitionBy("split", "part_left", "part_right").parquet(together)
        for number, path in enumerate(paths.values(), 1):
            with replacing(spark, path) as fresh:
                written = place(f"{together}/split={number}")
                # A split without triples has no folder.
                if not (files.rename(written, place(fresh)) if files.exists(written) else files.mkdirs(place(fresh))):
                    raise OSError(f"could not put {written} at {fresh}")
                files.create(place(f"{fresh}/_SUCCESS"), True).close()
    finally:
        files.delete(folder, True)


def write_names(names: DataFrame, path: str, files: int | None = None) -> None:
    """The names table, in ``files`` files if given (one suits relations, not the entities of a large graph)."""
    table = schemas.conform(names, schemas.NAMES)
    spread = table if files is None else table.repartition(files)
    with replacing(table.sparkSession, path) as fresh:
        spread.write.parquet(fresh)


def write_by_norm(embeddings: DataFrame, path: str, head_rows: int = 4096, block_bytes: int = 8 << 20) -> None:
    """Embeddings by falling norm: the ``head_rows`` longest of each partition under ``head/``, all others under ``rest/``.

    The rest is dealt out by ranges of (partition, norm), so each row group (of about ``block_bytes``) is a block of similar
    norms whose greatest and least are in the file's statistics, and a condition on the norm passes over whole blocks.
    """
    table = schemas.conform(embeddings, schemas.EMBEDDING)
    table = table.withColumn("norm", F.sqrt(inner_product(F.col("embedding"), F.col("embedding"))))
    order = [F.desc("norm"), F.asc("index")]
    place = F.row_number().over(Window.partitionBy("partition").orderBy(*order))
    table.withColumn("_place", place).where(F.col("_place") <= head_rows).drop("_place").write.mode("overwrite").parquet(f"{path}/head")
    spark = embeddings.sparkSession
    # One row for each partition: its last one in the head.
    last = spark.read.parquet(f"{path}/head").groupBy("partition").agg(F.max(F.struct(-F.col("norm"), "index")).alias("_last"))
    rest = table.join(F.broadcast(last), "partition").where(F.struct(-F.col("norm"), "index") > F.col("_last")).drop("_last")
    spread = rest.repartitionByRange("partition", F.desc("norm")).sortWithinPartitions("partition", *order)
    spread.write.mode("overwrite").option("parquet.block.size", block_bytes).parquet(f"{path}/rest")


def write_buckets(coded: DataFrame, partitions: int, path: str, by_bucket: bool = False) -> None:
    """The trainer's edge columns per bucket under ``edges/`` and one manifest row per grid cell under ``manifest/``.

    ``by_bucket`` says that ``coded`` was read from a table stored by bucket: a task then has few buckets, and its rows stay with it.
    """
    edges = buckets.bucket_export(coded)
    spread = edges if by_bucket else edges.hint("rebalance", "part_left", "part_right")
    with open_writers(coded.sparkSession, OPEN_WRITERS if by_bucket else 0):
        spread.write.mode("overwrite").partitionBy("part_left", "part_right").parquet(f"{path}/edges")
    buckets.manifest(coded, partitions).coalesce(1).write.mode("overwrite").json(f"{path}/manifest")


def write_entity_lists(entities: DataFrame, path: str, chunk_rows: int = buckets.CHUNK_ROWS) -> None:
    """JSON name arrays under ``entity_names_all/partition=<p>/`` and counts under ``entity_count_all/``."""
    lists = buckets.name_list(entities, "ent", chunk_rows)
    # A row is a whole array: grouping them has dealt them out already.
    spread = lists.sortWithinPartitions("partition", "first")
    spread.write.mode("overwrite").partitionBy("partition").json(f"{path}/entity_names_all")
    counts = buckets.entity_counts(entities).select("partition", F.col("count").cast("string").alias("value"))
    counts.repartition(1).write.mode("overwrite").partitionBy("partition").text(f"{path}/entity_count_all")


def write_relation_lists(relations: DataFrame, path: str, chunk_rows: int = buckets.CHUNK_ROWS) -> None:
    """JSON name arrays under ``dynamic_rel_names/`` and the count under ``dynamic_rel_count/``."""
    lists = buckets.name_list(relations, "relation", chunk_rows).drop("partition")
    lists.repartitionByRange("first").sortWithinPartitions("first").write.mode("overwrite").json(
        f"{path}/dynamic_rel_names"
    )
    count = buckets.relation_count(relations).select(F.col("count").cast("string").alias("value"))
    count.coalesce(1).write.mode("overwrite").text(f"{path}/dynamic_rel_count")
