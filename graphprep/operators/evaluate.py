"""Scores of coded triples, uniform negative candidates and held-out ranks."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphprep.functions.hashing import digest, number
from graphprep.functions.vectors import inner_product, project
from graphprep.operators import slices
from graphprep.operators.lookup import hot_keys, lookup_join, unique_join
from graphprep.workspace import stage

EDGE = ["subj", "obj", "rel", "part_left", "part_right"]
SEED = 11
#: Bytes of projected vectors, and of the draws with all that is worked out of them, that one task deals out to slices at once.
DEAL_BYTES = 32 << 20
#: Numbers that are held for a draw while it is dealt: itself, its edge, slice and place, the order, and copies in that order.
DEALT_NUMBERS = 12
#: Candidates scored at once in a cell.
PAIRS = 8192


def _position(partition: str, index: str) -> Column:
    """One key for ``(partition, index)``, so that hot entities can be salted by value."""
    return F.shiftleft(F.col(partition).cast("long"), 32) + F.col(index)


def _attach(df: DataFrame, embeddings: DataFrame, partition: str, index: str, name: str, hot=(), on_missing: str = "error") -> DataFrame:
    """Adds an entity's vector. One that has none is an error, or (``drop``) its row is left out."""
    vectors = embeddings.select(_position("partition", "index").alias("_key"), F.col("embedding").alias(name))
    keyed = df.withColumn("_position", _position(partition, index))
    if on_missing == "drop":
        return unique_join(keyed, vectors, "_position", "_key", "inner", hot).drop("_position")
    if on_missing != "error":
        raise ValueError(f"unknown on_missing {on_missing!r}")
    found = unique_join(keyed, vectors, "_position", "_key", "left", hot).drop("_position")
    error = F.raise_error(F.concat(F.lit("no embedding for partition "), F.col(partition), F.lit(", index "), F.col(index)))
    return found.withColumn(name, F.when(F.col(name).isNull(), error).otherwise(F.col(name)))


def missing_vectors(edges: DataFrame, embeddings: DataFrame, hot=()) -> DataFrame:
    """One row ``edges, left, right, either``: edges in all and those whose left, right or any end has no embedding."""
    known = embeddings.select(_position("partition", "index").alias("_key"), F.lit(1).alias("_known"))
    rows = edges.select(_position("part_left", "subj").alias("_left"), _position("part_right", "obj").alias("_right"))
    rows = unique_join(rows, known, "_left", "_key", "left", hot).withColumnRenamed("_known", "_has_left")
    rows = unique_join(rows, known, "_right", "_key", "left", hot)
    left, right = F.col("_has_left").isNull(), F.col("_known").isNull()
    return rows.agg(
        F.count(F.lit(1)).alias("edges"), F.count_if(left).alias("left"), F.count_if(right).alias("right"), F.count_if(left | right).alias("either")
    )


def hot_positions(edges: DataFrame, **options) -> list[int]:
    """Frequent entities of ``edges`` as values of the position key."""
    keyed = edges.select(
        _position("part_left", "subj").alias("left"), _position("part_right", "obj").alias("right")
    )
    return hot_keys(keyed, "left", "right", **options)


def projected_edges(
    edges: DataFrame, embeddings: DataFrame, operators: DataFrame, side: str, hot=(), on_missing: str = "error"
) -> DataFrame:
    """Edges with ``vector``: the left end through the left operator, or the right end through the right one."""
    partition, index = ("part_left", "subj") if side == "lhs" else ("part_right", "obj")
    chosen = operators.where(F.col("side") == side).withColumnRenamed("rel", "_op_rel").drop("side")
    fetched = lookup_join(_attach(edges, embeddings, partition, index, "_source", hot, on_missing), chosen, "rel", "_op_rel")
    vector = project(F.col("_source"), F.col("kind"), F.col("real"), F.col("imag"), F.col("translation"))
    return fetched.withColumn("vector", vector).drop("_source", "kind", "real", "imag", "translation")


def score_triples(
    edges: DataFrame, embeddings: DataFrame, operators: DataFrame, side: str = "lhs", hot=(), on_missing: str = "error"
) -> DataFrame:
    """Edges with ``score``: the projected end times the other end.

    An edge with an end that has no embedding is an error; with ``on_missing="drop"`` it is left out (and counted by
    ``missing_vectors``).
    """
    partition, index = ("part_right", "obj") if side == "lhs" else ("part_left", "subj")
    projected = projected_edges(edges, embeddings, operators, side, hot, on_missing)
    scored = _attach(projected, embeddings, partition, index, "_target", hot, on_missing)
    return scored.withColumn("score", inner_product(F.col("vector"), F.col("_target"))).drop("vector", "_target")


def _draw(side: str, seed: int, total: Column, number_: Column) -> Column:
    """A draw from ``total`` entities, as a hash of the edge, the draw's number and the seed."""
    return _drawn(_draw_key(side, seed), total, number_)


def _draw_key(side: str, seed: int) -> Column:
    """What all draws of an edge have in common."""
    return F.concat_ws("\t", F.lit(str(seed)), F.lit(side), *[F.col(c).cast("string") for c in EDGE])


def _drawn(key: Column, total: Column, number_: Column) -> Column:
    return F.pmod(number(digest(key, number_.cast("string")), 15), total)


def negative_samples(
    edges: DataFrame, entities: DataFrame, n: int = 500, side: str = "rhs", seed: int = SEED, on_missing: str = "error"
) -> DataFrame:
    """``n`` uniform draws from all ``entities(partition, index)`` per edge, as ``draw, cand_part, cand_index``.

    ``side`` is the end that is replaced. A draw is a hash read as an ordinal over the entities, by partition and index.
    Indexes must be dense, as those of a dictionary are, then an ordinal is split into partition and index by the partitions'
    sizes (one row per partition). Gaps are an error; with ``on_missing="drop"`` ordinals count only the entities that exist,
    and are looked up in bitmaps of the slices (see ``slices``).
    """
    # Edges are few bytes for the rows they become: they are dealt out by number. The key is made once an edge, below the draws.
    spark = edges.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    drawn = edges.repartition(tasks).withColumn("_key", _draw_key(side, seed)).withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(n))))
    if on_missing == "drop":
        found = slices.slice_map(entities, slices.BITMAP_ROWS)
        if not found.total:
            raise ValueError("there are no entities to draw from")
        ordinals = drawn.withColumn("_ordinal", _drawn(F.col("_key"), F.lit(found.total), F.col("draw"))).drop("_key")
        return slices.existing(ordinals, entities, "_ordinal", slices=found)
    if on_missing != "error":
        raise ValueError(f"unknown on_missing {on_missing!r}")
    counted = entities.groupBy("partition").agg(F.count(F.lit(1)).alias("count"), F.max("index").alias("last"))
    gap = F.raise_error(F.concat(F.lit("the indexes of partition "), F.col("partition"), F.lit(" have gaps")))
    dense = F.when(F.col("last") == F.col("count") - 1, F.col("count")).otherwise(gap.cast("bigint"))
    sizes = counted.select("partition", dense.alias("count")).agg(
        F.array_sort(F.collect_list(F.struct("partition", "count"))).alias("sizes"), F.sum("count").alias("total")
    )
    starts = F.aggregate(
        "sizes",
        F.array(F.lit(0).cast("long")),
        lambda done, s: F.concat(done, F.array(F.element_at(done, -1) + s["count"])),
    )
    layout = sizes.select(F.struct("sizes", starts.alias("starts"), "total").alias("layout"))
    drawn = drawn.withColumn("_layout", layout.scalar())
    placed = drawn.withColumn("_global", _drawn(F.col("_key"), F.col("_layout.total"), F.col("draw")))
    slot = F.size(F.filter(F.col("_layout.starts"), lambda start: start <= F.col("_global")))
    placed = placed.withColumn("_slot", slot)
    return placed.select(
        *edges.columns,
        "draw",
        F.element_at(F.col("_layout.sizes"), F.col("_slot"))["partition"].alias("cand_part"),
        (F.col("_global") - F.element_at(F.col("_layout.starts"), F.col("_slot"))).cast("int").alias("cand_index"),
    )


def deal_rows(dimension: int, n_slices: int, per_edge: int) -> int:
    """Edges that are dealt out at once."""
    copies = 8 * max(1, dimension) * max(1, min(n_slices, per_edge))
    return max(1, DEAL_BYTES // max(copies, 8 * DEALT_NUMBERS * per_edge))


def dealt_to_slices(edges: DataFrame, found: slices.SliceMap, dimension: int) -> DataFrame:
    """``edges(.., vector, draws)`` to ``slice, .., vector, places``: a row for each slice that an edge has draws in.

    However many candidates an edge draws from a slice, its vector goes there once; with it go their places in the slice.
    """
    kept = [c for c in edges.columns if c != "draws"]
    schema = T.StructType([T.StructField("slice", T.IntegerType()), *[edges.schema[c] for c in kept], T.StructField("places", T.ArrayType(T.IntegerType()))])
    names = schema.names
    shared = edges.sparkSession.sparkContext.broadcast(found)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices_ = shared.value
        n_slices = len(slices_.numbers)
        for batch in batches:
            draws = batch.column(batch.schema.get_field_index("draws"))
            per_edge = len(draws.flatten()) // max(1, batch.num_rows)
            step = deal_rows(dimension, n_slices, per_edge)
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                drawn = part.column(part.schema.get_field_index("draws"))
                rows = np.repeat(np.arange(part.num_rows), np.diff(drawn.offsets.to_numpy()))
                slice_, place = slices_.find(drawn.flatten().to_numpy())
                order = np.argsort(rows * n_slices + slice_, kind="stable")
                key = (rows * n_slices + slice_)[order]
                first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
                takes = pa.array(key[first] // n_slices)
                columns = [part.column(part.schema.get_field_index(c)).take(takes) for c in kept]
                lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(key)), pa.int32()), pa.array(place[order], pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array(key[first] % n_slices, pa.int32()), *columns, lists], names=names)

    return edges.mapInArrow(deal, schema)


def _better(vectors: np.ndarray, asked: np.ndarray, scores: np.ndarray, sizes: np.ndarray, places: np.ndarray) -> np.ndarray:
    """For each edge, how many of its candidates score higher than its true end.

    Coordinates are added up one after the other, in the order ``functions.vectors.inner_product`` adds them, so an edge's true
    end, drawn as a candidate, has exactly its own score.
    """
    rows = np.repeat(np.arange(len(sizes)), sizes)
    found = np.zeros(len(sizes), np.int64)
    for at in range(0, len(rows), PAIRS):
        row = rows[at : at + PAIRS]
        left = np.ascontiguousarray(vectors[places[at : at + PAIRS]].T, np.float64)
        right = np.ascontiguousarray(asked[row].T)
        total = np.zeros(len(row))
        for a, b in zip(right, left):
            total += a * b
        found += np.bincount(row, total > scores[row], len(sizes)).astype(np.int64)
    return found


def _floats(column: pa.Array) -> np.ndarray:
    """A list column of equally long vectors as a matrix, in their own precision."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if column.null_count or len(set(np.diff(column.offsets.to_numpy()))) > 1:
        raise ValueError("all vectors must have the same dimension")
    return flat.reshape(len(column), -1)


def _score_cells(names: list[str]):
    """Cells one after the other: first the vectors of a slice in the order of their indexes, then its edges, as a stream."""
    kept = names[:-1]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, parts, vectors = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            at = batch.schema.get_field_index
            keys = np.stack([batch.column(at(c)).to_numpy() for c in ("slice", "block", "kind")])
            cuts = np.flatnonzero(np.append(True, (keys[:, 1:] != keys[:, :-1]).any(axis=0))).tolist() + [batch.num_rows]
            for start, stop in zip(cuts[:-1], cuts[1:]):
                run = batch.slice(start, stop - start)
                if cell != (key := tuple(keys[:2, start])):
                    cell, parts, vectors = key, [], None
                if keys[2, start] == 0:
                    parts.append(_floats(run.column(at("embedding"))))
                    continue
                if vectors is None:
                    vectors, parts = np.concatenate(parts), []
                lists = run.column(at("places"))
                sizes = np.diff(lists.offsets.to_numpy())
                found = _better(vectors, _floats(run.column(at("vector"))), run.column(at("score")).to_numpy(), sizes, lists.flatten().to_numpy())
                yield pa.RecordBatch.from_arrays([*[run.column(at(c)) for c in kept], pa.array(found)], names=names)

    return score


def rank_edges(
    edges: DataFrame,
    embeddings: DataFrame,
    operators: DataFrame,
    n: int = 500,
    side: str = "lhs",
    seed: int = SEED,
    hot=(),
    on_missing: str = "error",
    slice_bytes: int = slices.SLICE_BYTES,
) -> DataFrame:
    """Distinct edges with ``copies``, ``score`` and ``rank``: 1 + the candidates that score higher than the true end.

    All ``n`` candidates have an embedding. With ``on_missing="drop"`` the embeddings may have gaps: candidates are drawn
    from those that exist, and edges without one are left out (and counted by ``missing_vectors``).

    Candidates are not joined one by one. The entities are cut into slices of at most ``slice_bytes`` of vectors; an edge's
    vector is sent to each slice it has draws in, with their places, and scored there against the slice held as one matrix.
    Vectors of entities are moved once (or a few times, when there are fewer slices than tasks), never per candidate.
    """
    distinct = edges.groupBy(*EDGE).agg(F.count(F.lit(1)).alias("copies"))
    replaced = "rhs" if side == "lhs" else "lhs"
    partition, index = ("part_right", "obj") if side == "lhs" else ("part_left", "subj")
    projected = projected_edges(distinct, embeddings, operators, side, hot, on_missing)
    true = _attach(projected, embeddings, partition, index, "_target", hot, on_missing)
    true = true.withColumn("score", inner_product(F.col("vector"), F.col("_target"))).drop("_target")
    true = stage(true.select(*EDGE, "copies", "score", "vector"), "ranked-edges")
    some = embeddings.select(F.size("embedding")).first()
    dimension = some[0] if some else 0
    found = slices.slice_map(embeddings, slices.slice_rows(dimension, slice_bytes), dense=on_missing == "error")
    n_edges = true.count()
    if not n_edges:
        return true.select(*EDGE, "copies", "score", F.lit(1).cast("bigint").alias("rank"))
    draws = F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: _draw(replaced, seed, F.lit(found.total), i))
    dealt = dealt_to_slices(true.withColumn("draws", draws), found, dimension)

    spark = embeddings.sparkSession
    n_slices = len(found.numbers)
    # Fewer slices than tasks: an edge's rows go to one of several copies of a slice.
    blocks = max(1, min(math.ceil(spark.sparkContext.defaultParallelism / n_slices), math.ceil(n_edges / 1000)))
    block = F.pmod(F.xxhash64(*EDGE), F.lit(blocks)).cast("int")
    asked = dealt.select("slice", block.alias("block"), F.lit(1).alias("kind"), F.lit(None).cast("int").alias("index"), F.lit(None).cast("array<float>").alias("embedding"), *EDGE, "copies", "score", "vector", "places")
    numbered = embeddings.select("partition", "index", "embedding", slices.number_of(found.rows).alias("number"))
    placed = numbered.join(F.broadcast(found.table(spark)), ["partition", "number"])
    nothing = [F.lit(None).cast(asked.schema[c].dataType).alias(c) for c in (*EDGE, "copies", "score", "vector", "places")]
    copies = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    held = placed.select("slice", copies.alias("block"), F.lit(0).alias("kind"), "index", F.col("embedding").cast("array<float>").alias("embedding"), *nothing)
    cells = held.unionByName(asked).repartition("slice", "block").sortWithinPartitions("slice", "block", "kind", "index")
    schema = T.StructType([*[asked.schema[c] for c in (*EDGE, "copies", "score")], T.StructField("better", T.LongType())])
    compared = cells.mapInArrow(_score_cells(schema.names), schema)
    return compared.groupBy(*EDGE, "copies", "score").agg((F.sum("better") + 1).alias("rank"))


def rank_summary(ranks: DataFrame, *hits_at: int) -> DataFrame:
    """Mean reciprocal rank and hits@k over all edges, copies counted."""
    total = F.sum("copies")
    share = [
        (F.sum(F.when(F.col("rank") <= k, F.col("copies")).otherwise(0)) / total).alias(f"hits_at_{k}") for k in hits_at
    ]
    return ranks.agg(total.alias("edges"), (F.sum(F.col("copies") / F.col("rank")) / total).alias("mrr"), *share)
