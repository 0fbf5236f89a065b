"""Mixing sources to target weights by systematic sampling.

Every document of a source has the same expected number of copies, the source's target over its size. The documents of a
source are put in order of size; the expected copies before a document, plus one random offset per source, are rounded
down, and a document is emitted once for each whole number crossed between its own place and the next. Neighbours in
that order are about equally long, so the words taken differ from the target by about one document at most.

Defined results: a null source is a source of its own (the last one), a null text has size 0, a source without any word
is not taken, repeated rows are placed and taken row by row, an empty table gives an empty one.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphprep.functions.hashing import digest, number
from graphprep.llm.common import cumulate, word_count, wrapped
from graphprep.workspace import stage

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
LIMIT = 2.0
SEED = "mix"


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, limit: float = LIMIT) -> DataFrame:
    """``source, source_size, target`` from one row per source.

    Weights go round over the sources in order of code points, null last. All targets together are ``share`` of all
    sizes; none is above ``limit`` times its source, and what is cut off goes to the others by weight. The common level
    (target per weight) is found by a few passes that fetch two sums each; the sources stay where they are.
    """
    ranked = cumulate(
        stage(sizes.withColumn("_last", F.col("source").isNull()), "mix-sources"), [], ["_last", "source"], {"_rank": F.lit(1)}, "mix-ranks"
    )
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    ceiling = F.lit(float(limit)) * F.col("source_size")
    table = stage(ranked.select("source", "source_size", weight.alias("_weight"), ceiling.alias("_ceiling")), "mix-weights")
    total = float(share) * (table.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0
    while True:
        full = F.col("_ceiling") <= F.col("_weight") * level
        taken, free = table.agg(F.sum(F.when(full, F.col("_ceiling"))), F.sum(F.when(~full, F.col("_weight")))).first()
        if not free:
            level = math.inf if level else 0.0
            break
        raised = (total - (taken or 0.0)) / free
        if raised <= level:
            break
        level = raised
    target = F.least("_ceiling", F.col("_weight") * level) if math.isfinite(level) else F.col("_ceiling")
    return table.select("source", "source_size", target.alias("target"))


def offset(source: Column, seed: str) -> Column:
    """The random offset of a source, in [0, 1)."""
    return number(digest(F.concat(F.lit(seed), F.coalesce(F.concat(F.lit("/"), source), F.lit("")))), 12) / float(16**12)


def copies(rows: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, limit: float = LIMIT, seed: str = SEED) -> DataFrame:
    """``id, doc_id, source, size, source_size, target, copies`` for a stored table ``id, doc_id, source, size, tie``.

    The order within a source is size, a hash of doc_id, ``tie`` (a hash of the text), id: rows that only differ in
    ``id`` are the same document, so reruns agree on every document whatever the input's files are.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = stage(source_targets(sizes, weights, share, limit), "mix-targets")
    drawn = digest(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    keyed = stage(rows.withColumn("draw", drawn), "mix-rows")
    placed = cumulate(keyed, ["source"], ["size", "draw", "tie", "id"], {"place": F.lit(1)}, "mix-places").drop("draw", "tie")
    theirs = targets.withColumnRenamed("source", "_source")
    joined = placed.join(theirs, placed["source"].eqNullSafe(theirs["_source"])).drop("_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    shift = offset(F.col("source"), seed)
    crossed = F.floor((F.col("place") + 1) * rate + shift) - F.floor(F.col("place") * rate + shift)
    return joined.select("id", "doc_id", "source", "size", "source_size", "target", crossed.alias("copies"))


def _narrow(rows: DataFrame, text: Column, doc_id: Column, source: Column) -> DataFrame:
    return rows.select("id", doc_id.alias("doc_id"), source.alias("source"), word_count(text).alias("size"), F.xxhash64(text).alias("tie"))


def mix_plan(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, limit: float = LIMIT, seed: str = SEED) -> DataFrame:
    """The copies each row of ``doc_id, source, text`` gets; no text is moved."""
    rows = docs.select(F.monotonically_increasing_id().alias("id"), "doc_id", "source", "text")
    narrow = stage(_narrow(rows, F.col("text"), F.col("doc_id"), F.col("source")), "mix-narrow")
    return copies(narrow, weights, share, limit, seed)


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, limit: float = LIMIT, seed: str = SEED) -> DataFrame:
    """The mixed documents, with the columns of ``docs``: each row as often as it is taken."""
    rows = stage(wrapped(docs), "mix-docs")
    doc = F.col("doc")
    narrow = stage(_narrow(rows, doc["text"], doc["doc_id"], doc["source"]), "mix-narrow")
    plan = copies(narrow, weights, share, limit, seed).where("copies > 0").select(F.col("id").alias("_id"), "copies")
    taken = rows.join(plan, rows["id"] == plan["_id"])
    # One row more for each copy; the number of copies is at most ``limit`` rounded up.
    again = taken.select("doc", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("_copy"))
    return again.select("doc.*")
