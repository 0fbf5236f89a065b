"""Resharding by minimum-cost flow.

Old shards supply their bytes, new shards have capacities, and a byte costs nothing where it lies and one unit (or what
a table of costs says) elsewhere. The cheapest flow is solved on the driver over shards only, never over documents. It
says how many bytes go from shard to shard; within an old shard the documents lie in a fixed order, each flow is a
block, a run of that order, and a document goes with the block its middle byte is in. Only shards that gain or lose a
block are rewritten.

Defined results: a null text has no bytes (its row still takes ``ROW_BYTES``), a null doc_id is placed like any other,
repeated rows are placed row by row, an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphprep.llm.common import cumulate
from graphprep.workspace import stage

ROW_BYTES = 8


def even_capacities(total: int, shards: int) -> list[int]:
    return [(j + 1) * total // shards - j * total // shards for j in range(shards)]


def cheapest_flow(supply: Mapping[int, int], capacity: Sequence[int], cost: Mapping[tuple[int, int], int] | None = None) -> dict[tuple[int, int], int]:
    """Bytes from old to new shard, all supplies placed within all capacities at the least total cost.

    Successive cheapest augmenting paths; old shard ``i`` and new shard ``i`` are the same place. Works on shards only,
    so its size is their number, not the data's.
    """
    if sum(supply.values()) > sum(capacity):
        raise ValueError("the new shards cannot hold the old ones")
    olds, news = sorted(supply), range(len(capacity))
    price = {(i, j): 0 if i == j else 1 for i in olds for j in news}
    price.update(cost or {})
    left, room = dict(supply), list(capacity)
    flow: dict[tuple[int, int], int] = {}
    while any(left.values()):
        # Distances from the old shards with bytes left, over unused arcs forward and used arcs backward.
        far = {("old", i): 0 for i in olds if left[i]}
        came: dict = {}
        changed = True
        while changed:
            changed = False
            for (i, j), c in price.items():
                if ("old", i) in far and far["old", i] + c < far.get(("new", j), far["old", i] + c + 1):
                    far["new", j], came["new", j], changed = far["old", i] + c, ("old", i), True
                if flow.get((i, j)) and ("new", j) in far and far["new", j] - c < far.get(("old", i), far["new", j] - c + 1):
                    far["old", i], came["old", i], changed = far["new", j] - c, ("new", j), True
        end = min((far["new", j], j) for j in news if room[j] and ("new", j) in far)[1]
        path, node, amount = [], ("new", end), room[end]
        while node in came:
            before = came[node]
            if node[0] == "new":
                path.append((before[1], node[1], 1))
            else:
                path.append((node[1], before[1], -1))
                amount = min(amount, flow[node[1], before[1]])
            node = before
        amount = min(amount, left[node[1]])
        for i, j, sign in path:
            flow[i, j] = flow.get((i, j), 0) + sign * amount
        left[node[1]] -= amount
        room[end] -= amount
    return {arc: n for arc, n in sorted(flow.items()) if n}


def blocks(flow: Mapping[tuple[int, int], int]) -> list[tuple[int, list[int], list[int]]]:
    """For each old shard: where its blocks begin and the new shard of each. What stays comes first."""
    result: dict[int, tuple[list[int], list[int]]] = {}
    for (i, j), n in sorted(flow.items(), key=lambda x: (x[0][0], x[0][1] != x[0][0], x[0][1])):
        starts, targets = result.setdefault(i, ([], []))
        starts.append(0 if not starts else result[i][0][-1] + last)
        targets.append(j)
        last = n
    return [(i, starts, targets) for i, (starts, targets) in result.items()]


def text_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("bigint")


def assign(rows: DataFrame, shards: int, order: Sequence[str], cost: Mapping[tuple[int, int], int] | None = None) -> DataFrame:
    """Adds ``shard`` and ``slot`` to a stored table with ``old`` (int), ``size`` and ``id``.

    ``order`` and then ``id`` give the layout of an old shard. ``slot`` counts from 0 in each new shard, what stays
    first.
    """
    spark = rows.sparkSession
    supply = {r["old"]: r["size"] for r in rows.groupBy("old").agg(F.sum("size").alias("size")).collect()}
    flow = cheapest_flow(supply, even_capacities(sum(supply.values()), shards), cost)
    layout = F.broadcast(spark.createDataFrame(blocks(flow), "_old int, _starts array<bigint>, _targets array<int>"))
    laid = cumulate(rows, ["old"], [*order, "id"], {"_before": F.col("size")}, "shards-old")
    middle = F.col("_before") + F.floor(F.col("size") / 2)
    block = F.size(F.filter("_starts", lambda start: start <= middle))
    placed = laid.join(layout, laid["old"] == layout["_old"]).withColumn("shard", F.element_at("_targets", block))
    placed = placed.withColumn("_moved", F.col("shard") != F.col("old"))
    kept = stage(placed.select(*rows.columns, "shard", "_moved", "_before"), "shards-new")
    numbered = cumulate(kept, ["shard"], ["_moved", "old", "_before", "id"], {"slot": F.lit(1)}, "shards-slots")
    return numbered.select(*rows.columns, "shard", "slot")


def moved_bytes(placed: DataFrame) -> DataFrame:
    """``old, shard, bytes, documents``: what goes where."""
    return placed.groupBy("old", "shard").agg(F.sum("size").alias("bytes"), F.count("*").alias("documents"))


def affected_shards(placed: DataFrame) -> list[int]:
    """Shards that gain or lose documents; bounded by the number of shards."""
    moved = placed.where(F.col("old") != F.col("shard"))
    return sorted(r[0] for r in moved.select(F.explode(F.array("old", "shard"))).distinct().collect())


def rewrite(docs: DataFrame, placed: DataFrame, path: str) -> tuple[list[int], list[int]]:
    """Write the affected shards of ``docs`` (with ``id``) under ``path/shard=<n>``; the files of all others stay.

    Returns the shards written and those left without documents, whose folders the caller may delete. ``docs`` must not
    be read from ``path`` itself.
    """
    shards = affected_shards(placed)
    places = stage(placed.where(F.col("shard").isin(shards)).select(F.col("id").alias("_id"), "shard"), "shards-affected")
    filled = sorted(r[0] for r in places.select("shard").distinct().collect())
    rows = docs.join(places, docs["id"] == places["_id"]).drop("_id")
    # A shard is written by several tasks, however large it is.
    dealt = rows.repartition(F.col("shard"), F.pmod("id", F.lit(16))).drop("id")
    dealt.write.partitionBy("shard").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    return filled, sorted(set(shards) - set(filled))
