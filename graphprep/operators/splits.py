"""Train / valid / test split."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphprep.functions.hashing import digest, modulo

WEIGHTS = {"train": 0.8, "valid": 0.1, "test": 0.1}
SEED = 11


def _label(draw: Column, cuts: list[float], names: list[str]) -> Column:
    label = F.lit(names[-1])
    for name, cut in reversed(list(zip(names[:-1], cuts[:-1]))):
        label = F.when(draw < F.lit(cut), F.lit(name)).otherwise(label)
    return label


def split_triples(
    triples: DataFrame, method: str = "hash", weights: dict[str, float] = WEIGHTS, seed: int = SEED
) -> DataFrame:
    """Add a ``split`` column.

    ``hash`` draws from the triple itself: re-runs agree and all copies of a triple land in one split. ``random`` draws
    for each row, as ``DataFrame.randomSplit`` does (rows are sorted in each task first so that a retried task draws
    the same), but in one pass for all splits.
    """
    names = list(weights)
    total = sum(weights.values())
    cuts = [round(c / total, 12) for c in accumulate(weights.values())]
    if method == "hash":
        draw = modulo(digest(F.col("subj"), F.col("rel"), F.col("obj")), 10_000)
        return triples.withColumn("split", _label(draw, [round(c * 10_000) for c in cuts], names))
    if method == "random":
        ordered = triples.sortWithinPartitions("subj", "rel", "obj")
        drawn = ordered.withColumn("_draw", F.rand(seed))
        return drawn.withColumn("split", _label(F.col("_draw"), cuts, names)).drop("_draw")
    raise ValueError(f"unknown split method {method!r}")
