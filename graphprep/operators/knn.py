"""Nearest entities by inner product for a table of requests ``(query_id, entity, relation, k, direction)``.

``query_id`` must be unique.

A request's entity vector goes through the operator of its relation; the answer is the k entities whose vectors have
the largest inner product with the result. Every entity is scored, so answers are exact. Equal requests are answered
once, and a request's vector is projected once.

Two ways to bring questions and embeddings together, chosen by a check of the number of questions and of their k:

* up to ``BROADCAST_ROWS`` of them (and ``BROADCAST_BYTES`` of vectors) are broadcast as one matrix and the embeddings are
  scanned where they lie;
* beyond that both sides are spread over a grid of cells of at most ``CELL_BYTES`` and ``CELL_PAIRS``, each cell scoring its share
  of the questions against its share of the embeddings. Each side is sent to as many cells as the other has shares, so half of a
  cell is given to either, or what the questions leave if they need less. There are as many tasks as cells, up to ``CELL_TASKS``.

Either way a task hands on only its best k per question and partition, never the scores. A product is at most the product of
the norms, so a task passes over what is too short to be among the best (see ``blocks.Scorer``). For embeddings stored by norm
(``sinks.write_by_norm``) the longest ones are scored first, and of the others only those long enough for some question are
read: the condition on the norm reaches the scan, and whole row groups are passed over.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphprep.functions.blocks import HITS, HITS_ARROW, ROUNDING, Scorer, matrix, norms
from graphprep.functions.vectors import operator_side, project
from graphprep.operators.lookup import hot_keys, salted_join, small_copy, unique_join
from graphprep.sources.tables import ByNorm
from graphprep.workspace import stage

QUESTION = ["entity", "relation", "side", "k"]
# Questions, bytes of their vectors and wanted hits (the sum of k) that one task may hold; and the hits after which a task
# hands on early.
BROADCAST_ROWS = 10_000
BROADCAST_BYTES = 64 << 20
BROADCAST_HITS = CELL_HITS = 1_000_000
TASK_HITS = 5_000_000
CELL_BYTES = 256 << 20
#: Scores of a cell, some seconds of work, so that more questions and embeddings make more tasks and not longer ones.
CELL_PAIRS = 1 << 31
CELL_TASKS = 10_000
#: Known scores, of questions times partitions, that the driver takes to pass over short embeddings.
FLOORS = 1_000_000



def questions_of(requests: DataFrame) -> DataFrame:
    """The distinct questions, each named by the least ``query_id`` that asks it."""
    positive = F.when(F.col("k") > 0, F.col("k")).otherwise(F.raise_error(F.lit("k must be positive")))
    sided = requests.withColumn("k", positive).withColumn("side", operator_side(F.col("direction")))
    return sided.groupBy(*QUESTION).agg(F.min("query_id").alias("question_id"))


def _question_key() -> Column:
    return F.to_json(F.struct(*QUESTION))


def _broadcast_if_small(df: DataFrame) -> DataFrame:
    copy = small_copy(df)
    return df if copy is None else F.broadcast(copy)


def locate(
    questions: DataFrame, entity_names: DataFrame, relation_names: DataFrame, few: bool = False
) -> DataFrame:
    """Add ``partition, index`` of the entity and ``rel`` of the relation; questions about unknown keys drop out.

    ``few`` questions, their number being checked, are taken to the names; the names are not shuffled then.
    """
    entities = entity_names.select(F.col("ent").alias("entity"), "partition", "index")
    relations = relation_names.select(F.col("ent").alias("relation"), F.col("index").alias("rel"))
    asked = questions.join(relations, "relation")
    return entities.join(F.broadcast(asked) if few else asked, "entity")


def unknown_requests(requests: DataFrame, entity_names: DataFrame, relation_names: DataFrame) -> DataFrame:
    """The requests that name an unknown entity or relation."""
    entities = entity_names.select(F.col("ent").alias("entity"), F.lit(True).alias("_entity"))
    relations = relation_names.select(F.col("ent").alias("relation"), F.lit(True).alias("_relation"))
    # Only the names asked about take part in the outer join.
    entities = entities.join(requests.select("entity").distinct(), "entity", "left_semi")
    marked = requests.join(relations, "relation", "left").join(entities, "entity", "left")
    return marked.where(F.col("_entity").isNull() | F.col("_relation").isNull()).select(requests.columns)


def projected_questions(
    located: DataFrame, embeddings: DataFrame, operators: DataFrame, few: bool = False
) -> DataFrame:
    """``(question_id, k, vector)`` with the entity's vector after the relation operator.

    The vectors are fetched once per entity asked about, then handed to its questions. For ``few`` questions the
    embeddings are scanned and not shuffled.
    """
    asked = located.select("partition", "index").distinct()
    vectors = embeddings.join(F.broadcast(asked) if few else asked, ["partition", "index"])
    fetched = vectors.join(F.broadcast(located) if few else located, ["partition", "index"])
    fetched = fetched.join(_broadcast_if_small(operators), ["rel", "side"])
    vector = project(F.col("embedding"), F.col("kind"), F.col("real"), F.col("imag"), F.col("translation"))
    return fetched.select("question_id", "k", vector.alias("vector"))


class _Asked(NamedTuple):
    """Few questions, as the tasks get them."""

    ids: np.ndarray
    vectors: np.ndarray
    ks: np.ndarray


def _asked(projected: DataFrame) -> _Asked:
    block = projected.select("question_id", "vector", "k").toArrow()
    return _Asked(block["question_id"].to_numpy(), matrix(block["vector"]), block["k"].to_numpy())


def _scan(embeddings: DataFrame, asked: _Asked, floors: dict[int, np.ndarray] | None = None) -> DataFrame:
    if not len(asked.ids):
        return embeddings.sparkSession.createDataFrame([], HITS)
    shared = embeddings.sparkSession.sparkContext.broadcast((*asked, floors))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*shared.value)
        for batch in batches:
            if batch.num_rows:
                scorer.add(batch["partition"].to_numpy(), batch["index"].to_numpy(), matrix(batch["embedding"]))
            if scorer.size > TASK_HITS:
                yield from scorer.drain()
        yield from scorer.drain()

    return embeddings.select("partition", "index", "embedding").mapInArrow(score, HITS)


def long_enough(asked: _Asked, floors: dict[int, np.ndarray]) -> Column:
    """Whether an embedding's ``norm`` might place it among the best of any question, given the scores already reached."""
    lengths = norms(asked.vectors)
    condition = ~F.col("partition").isin(list(floors))
    for partition, known in floors.items():
        with np.errstate(divide="ignore", invalid="ignore"):
            least = np.where((lengths > 0) & (known > 0), known / lengths * (1 - ROUNDING), 0.0).min(initial=np.inf)
        condition = condition | ((F.col("partition") == partition) & (F.col("norm") >= float(least)))
    return condition


def _scan_by_norm(embeddings: ByNorm, asked: _Asked, max_k: int) -> DataFrame:
    """The longest embeddings first; then those of the rest that are long enough for what has been reached."""
    first = stage(_top(_scan(embeddings.head, asked), ["question_id", "partition"], "_place", max_k).drop("_place"), "long-hits")
    reached = first.groupBy("question_id", "partition").agg(F.count(F.lit(1)).alias("n"), F.min("dist").alias("dist"), F.first("k").alias("k"))
    reached = reached.where("n >= k").select("question_id", "partition", "dist")
    # With too many questions and partitions nothing is passed over; the answers are the same.
    rows = reached.limit(FLOORS + 1).toArrow()
    floors: dict[int, np.ndarray] = {}
    if 0 < rows.num_rows <= FLOORS:
        order = np.argsort(asked.ids)
        place = order[np.searchsorted(asked.ids, rows["question_id"].to_numpy(), sorter=order)]
        partitions, dist = rows["partition"].to_numpy(), rows["dist"].to_numpy()
        for partition in np.unique(partitions):
            own = partitions == partition
            floors[int(partition)] = np.full(len(asked.ids), -np.inf)
            floors[int(partition)][place[own]] = dist[own]
    rest = embeddings.rest.where(long_enough(asked, floors)) if len(floors) <= 256 else embeddings.rest
    return first.unionByName(_scan(rest, asked, floors))


def _numbers(n: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


def cell_shares(questions: int, hits: int, dimension: int, cell_bytes: int) -> tuple[int, int]:
    """``(shares of the questions, entities of a cell)`` so that both sides of a cell take at most ``cell_bytes`` as doubles,
    and have at most ``CELL_PAIRS`` pairs.

    With V entities, Q questions and cells for a and b of them, V * Q / b + Q * V / a rows are sent: least for a = b, unless
    all questions need less than that.
    """
    row = 8 * max(1, dimension)
    half = max(1, min(cell_bytes // 2 // row, math.isqrt(CELL_PAIRS)))
    shares = max(1, math.ceil(questions / half), math.ceil(hits / CELL_HITS))
    each = max(1, math.ceil(questions / shares))
    return shares, max(1, min(cell_bytes // row - each, CELL_PAIRS // each))


def _grid(embeddings: DataFrame, projected: DataFrame, columns: int, cell_entities: int) -> DataFrame:
    """Cells of one slice of one partition by one share of the questions.

    A partition has as many slices as its size asks for, so a partition holding a third of all entities has a third of
    the cells. The sizes are one row per partition.
    """
    layout, cells = [], 0
    for row in embeddings.groupBy("partition").count().collect():
        slices = math.ceil(row["count"] / cell_entities)
        layout.append((row["partition"], slices, cells))
        cells += slices
    spark = embeddings.sparkSession
    if not cells:
        return spark.createDataFrame([], HITS)
    slices = spark.createDataFrame(layout, "partition int, slices int, first_cell long")
    placed = embeddings.join(F.broadcast(slices), "partition").select(
        "partition",
        "index",
        "embedding",
        (F.col("first_cell") + F.pmod(F.col("index"), F.col("slices"))).alias("cell_row"),
        F.explode(_numbers(columns)).alias("cell_column"),
    )
    asked = projected.select(
        "question_id",
        "vector",
        "k",
        F.explode(_numbers(cells)).alias("cell_row"),
        F.pmod(F.xxhash64("question_id"), F.lit(columns)).alias("cell_column"),
    )

    def score(entities: pa.Table, questions: pa.Table) -> pa.Table:
        if not questions.num_rows or not entities.num_rows:
            return HITS_ARROW.empty_table()
        scorer = Scorer(questions["question_id"].to_numpy(), matrix(questions["vector"]), questions["k"].to_numpy())
        scorer.add(entities["partition"].to_numpy(), entities["index"].to_numpy(), matrix(entities["embedding"]))
        return pa.Table.from_batches(scorer.drain(), schema=HITS_ARROW)

    cell = ["cell_row", "cell_column"]
    # By number: cells are few rows and much work, so they must not be put together by their bytes.
    tasks = min(cells * columns, CELL_TASKS)
    placed, asked = placed.repartition(tasks, *cell), asked.repartition(tasks, *cell)
    return placed.groupBy(*cell).cogroup(asked.groupBy(*cell)).applyInArrow(score, HITS)


def _top(hits: DataFrame, groups: list[str], rank: str, max_k: int) -> DataFrame:
    """Rank within ``groups`` and keep ranks up to each question's k.

    The literal bound lets every task cut its rows before the shuffle.
    """
    window = Window.partitionBy(*groups).orderBy(F.desc("dist"), "partition", "index")
    ranked = hits.withColumn(rank, F.row_number().over(window))
    return ranked.where((F.col(rank) <= F.lit(max_k)) & (F.col(rank) <= F.col("k")))


def nearest(
    questions: DataFrame,
    projected: DataFrame,
    embeddings: DataFrame | ByNorm,
    broadcast_rows: int = BROADCAST_ROWS,
) -> tuple[DataFrame, int, int]:
    """``(question_id, k, partition, index, dist)``, the k best of each partition; the largest k; and the sum of all."""
    facts = questions.agg(F.count(F.lit(1)).alias("n"), F.max("k").alias("k"), F.sum("k").alias("hits")).first()
    max_k, wanted = facts["k"] or 1, facts["hits"] or 0
    one = (embeddings.head if isinstance(embeddings, ByNorm) else embeddings).select(F.size("embedding")).first()
    dimension = one[0] if one else 0
    if facts["n"] <= broadcast_rows and wanted <= BROADCAST_HITS and 8 * dimension * facts["n"] <= BROADCAST_BYTES:
        asked = _asked(projected)
        hits = _scan_by_norm(embeddings, asked, max_k) if isinstance(embeddings, ByNorm) else _scan(embeddings, asked)
    else:
        table = embeddings.all if isinstance(embeddings, ByNorm) else embeddings
        hits = _grid(table, projected, *cell_shares(facts["n"], wanted, dimension, CELL_BYTES))
    best = _top(hits, ["question_id", "partition"], "_place", max_k)
    return best.select("question_id", "k", "partition", "index", "dist"), max_k, wanted


def knn(
    requests: DataFrame,
    embeddings: DataFrame | ByNorm,
    operators: DataFrame,
    entity_names: DataFrame,
    relation_names: DataFrame,
    partitioned: bool = True,
    named_only: str = "after",
    on_missing: str = "empty",
    broadcast_rows: int = BROADCAST_ROWS,
    entity_lookup: DataFrame | None = None,
) -> DataFrame:
    """``(query_id, rank, uri, dist, name)``; a larger ``dist`` is nearer.

    ``partitioned``: the k best of each partition are taken first, those without a row in ``entity_names`` are dropped,
    and the k best of the rest are the answer, so fewer than k rows can come back. ``named_only="before"`` leaves
    unnamed entities out from the start and fills up to k.

    With ``partitioned=False`` there is one index over all embeddings and no name test: ``entity_names`` must name every
    entity, and a null name comes back as an empty string.

    Requests about unknown keys have no rows; ``on_missing="error"`` raises ``KeyError`` instead. ``entity_names`` and
    ``relation_names`` must have unique ``ent`` (see ``names.unique_names``); where a uri has several ids,
    ``entity_lookup`` gives the one that requests mean.
    """
    lookup = entity_names if entity_lookup is None else entity_lookup
    if named_only not in ("after", "before"):
        raise ValueError(f"named_only must be 'after' or 'before', not {named_only!r}")
    if on_missing not in ("empty", "error"):
        raise ValueError(f"on_missing must be 'empty' or 'error', not {on_missing!r}")
    relation_names = _broadcast_if_small(relation_names)
    if on_missing == "error":
        unknown = unknown_requests(requests, lookup, relation_names).first()
        if unknown is not None:
            raise KeyError(f"unknown entity or relation: {unknown['entity']!r}, {unknown['relation']!r}")
    copy = small_copy(requests)
    few = copy is not None
    requests = copy if few else requests
    questions = questions_of(requests)
    located = locate(questions, lookup, relation_names, few)
    if few:
        # Not more rows than requests, as the keys are unique; read twice below.
        fetched = small_copy(located)
        located = located if fetched is None else fetched
        few = fetched is not None
    table = embeddings.all if isinstance(embeddings, ByNorm) else embeddings
    projected = projected_questions(located, table, operators, few)
    scanned = embeddings
    if partitioned and named_only == "before":
        named = entity_names.select("partition", "index")
        parts = embeddings if isinstance(embeddings, ByNorm) else [embeddings]
        parts = [part.join(named, ["partition", "index"], "left_semi") for part in parts]
        scanned = ByNorm(*parts) if isinstance(embeddings, ByNorm) else parts[0]
    best, max_k, wanted = nearest(questions, projected, scanned, broadcast_rows)
    labels = entity_names.select("partition", "index", F.col("ent").alias("uri"), F.coalesce("name", F.lit("")).alias("name"))
    hits = best if partitioned else _top(best, ["question_id"], "rank", max_k)
    # At most the sum of all k for each partition: few enough hits are taken to the names.
    partitions = table.select("partition").distinct().count() if partitioned and few else 1
    if few and partitions * wanted <= BROADCAST_HITS:
        answer = labels.join(F.broadcast(hits), ["partition", "index"])
    else:
        # A hub is a hit of very many questions; stored, since finding hits is the expensive part.
        place = F.shiftleft(F.col("partition").cast("long"), 32) + F.col("index")
        hits = stage(hits.withColumn("_place", place), "hits")
        named = labels.select(place.alias("_named"), "uri", "name")
        answer = unique_join(hits, named, "_place", "_named", hot=hot_keys(hits, "_place")).drop("_place")
    if partitioned:
        # Named hits first, then the cut to k over all partitions.
        answer = _top(answer, ["question_id"], "rank", max_k)
    answer = answer.join(questions.select("question_id", _question_key().alias("_answered")), "question_id")
    asked = requests.withColumn("side", operator_side(F.col("direction")))
    asked = asked.select("query_id", _question_key().alias("_asked"))
    hot = [] if few else hot_keys(asked, "_asked")
    answered = salted_join(asked, answer, "_asked", "_answered", hot)
    return answered.select("query_id", "rank", "uri", F.col("dist").cast("double").alias("dist"), "name")
