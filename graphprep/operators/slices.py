"""Slices of the entity space, with rank and select.

A slice is a run of ``rows`` neighbouring indexes of one partition. What is known of all slices together is one small row
each (partition, number, entities, greatest index), which the driver holds; the entities themselves stay in the tables.
Counted over all slices, the entities that exist have ordinals, by partition and index. ``SliceMap`` says which slice an
ordinal is in, and which it is there; ``bitmaps`` holds, for each slice, a bit for each index that exists, so that an ordinal
leads to its index without numbering the entities anew.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLICE_BYTES = 256 << 20
BITMAP_ROWS = 1 << 20
#: Bytes of bitmaps that every task may hold.
BROADCAST_BITMAPS = 4 << 20
BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(axis=1, dtype=np.int64)
#: The places of a byte's set bits, in order and then the others.
SET = np.argsort(1 - np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little"), axis=1, kind="stable")


class SliceMap(NamedTuple):
    """Slices in the order of partition and number: ``starts`` counts the entities before each, and all of them last."""

    rows: int
    partitions: np.ndarray
    numbers: np.ndarray
    starts: np.ndarray

    @property
    def total(self) -> int:
        return int(self.starts[-1])

    def find(self, ordinals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The slice of each ordinal, and its place there."""
        slices = np.searchsorted(self.starts, ordinals, side="right") - 1
        return slices, ordinals - self.starts[slices]

    def table(self, spark) -> DataFrame:
        """``partition, number, slice``."""
        rows = [(int(p), int(n), i) for i, (p, n) in enumerate(zip(self.partitions, self.numbers))]
        return spark.createDataFrame(rows, "partition int, number int, slice int")


def slice_rows(dimension: int, slice_bytes: int = SLICE_BYTES) -> int:
    """Rows of a slice whose vectors (of floats) take at most ``slice_bytes``."""
    return max(1, slice_bytes // (4 * max(1, dimension)))


def number_of(rows: int):
    return F.floor(F.col("index") / rows).cast("int")


def slice_map(entities: DataFrame, rows: int, dense: bool = False) -> SliceMap:
    """``dense`` wants the indexes of each partition to be 0, 1, 2 and so on, as those of a dictionary are."""
    counted = entities.groupBy("partition", number_of(rows).alias("number")).agg(F.count(F.lit(1)).alias("n"), F.max("index").alias("last"))
    table = counted.orderBy("partition", "number").toArrow()
    partitions, numbers, n, last = (table[c].to_numpy() for c in ("partition", "number", "n", "last"))
    if dense:
        # Full slices up to the last one of a partition, and that one up to its last index.
        closing = np.append(partitions[1:] != partitions[:-1], True) if len(n) else np.zeros(0, bool)
        expected = np.where(closing, last - numbers.astype(np.int64) * rows + 1, rows)
        first = np.append(True, closing[:-1])[: len(n)]
        whole = (n == expected) & (numbers == np.where(first, 0, np.append(0, numbers[:-1] + 1)[: len(n)]))
        if not whole.all():
            raise ValueError(f"the indexes of partition {partitions[~whole][0]} have gaps")
    return SliceMap(rows, partitions, numbers, np.append(0, np.cumsum(n)).astype(np.int64))


def bitmaps(entities: DataFrame, slices: SliceMap) -> DataFrame:
    """``slice, first, bits``: bit ``i`` of a slice says whether index ``first + i`` exists."""
    numbered = entities.select("partition", "index", number_of(slices.rows).alias("number"))
    placed = numbered.join(F.broadcast(slices.table(entities.sparkSession)), ["partition", "number"])
    dealt = placed.select("slice", F.col("index").cast("long").alias("index")).repartition("slice").sortWithinPartitions("slice")
    rows = slices.rows

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, bits = None, None

        def done() -> pa.RecordBatch:
            set_ = np.packbits(bits[: np.flatnonzero(bits)[-1] + 1], bitorder="little").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([open_], pa.int32()), pa.array([first], pa.int64()), pa.array([set_], pa.binary())], names=["slice", "first", "bits"])

        for batch in batches:
            numbers, indexes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for number in np.unique(numbers):
                own = indexes[numbers == number]
                if number != open_:
                    if bits is not None:
                        yield done()
                    open_, bits, first = int(number), np.zeros(rows, bool), int(own[0]) // rows * rows
                bits[own - first] = True
        if bits is not None:
            yield done()

    return dealt.mapInArrow(build, "slice int, first long, bits binary")


def select(bits: bytes, places: np.ndarray) -> np.ndarray:
    """The bits set at the given ranks: a look-up by the number of bits before each byte, then within it."""
    data = np.frombuffer(bits, np.uint8)
    return _select(data, np.append(0, np.cumsum(BITS[data])), places)


def _select(data: np.ndarray, before: np.ndarray, places: np.ndarray) -> np.ndarray:
    byte = np.searchsorted(before, places, side="right") - 1
    return byte * 8 + SET[data[byte], places - before[byte]]


def existing(draws: DataFrame, entities: DataFrame, ordinal: str = "ordinal", rows: int = BITMAP_ROWS, slices: SliceMap | None = None, bitmap_bytes: int = BROADCAST_BITMAPS) -> DataFrame:
    """``draws`` with ``cand_part, cand_index`` in place of an ordinal among the entities that exist.

    Bitmaps that take at most ``bitmap_bytes`` are sent to all tasks, and draws stay where they are. Beyond, draws meet their
    slice's bitmap: a 32nd part of what the indexes themselves would take, and no vectors. The draws of a slice are dealt to
    several tasks then, each with a copy of the bitmap, so that few slices do not make few tasks.
    """
    slices = slices or slice_map(entities, rows)
    if len(slices.numbers) * math.ceil(slices.rows / 8) <= bitmap_bytes:
        return _existing_by_broadcast(draws, entities, ordinal, slices)
    return _existing_by_slice(draws, entities, ordinal, slices)


def _drawn_fields(draws: DataFrame, ordinal: str) -> tuple[list[str], str]:
    kept = [c for c in draws.columns if c != ordinal]
    return kept, ", ".join(f"`{c}` {draws.schema[c].dataType.simpleString()}" for c in kept)


def _existing_by_broadcast(draws: DataFrame, entities: DataFrame, ordinal: str, slices: SliceMap) -> DataFrame:
    kept, fields = _drawn_fields(draws, ordinal)
    held = bitmaps(entities, slices).toArrow().sort_by("slice")
    sizes = [len(b) for b in held["bits"].to_pylist()]
    starts = np.append(0, np.cumsum(sizes)).astype(np.int64)
    bits = b"".join(held["bits"].to_pylist())
    shared = entities.sparkSession.sparkContext.broadcast((bits, starts, held["first"].to_numpy(), slices.partitions))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, starts, firsts, partitions = shared.value
        data = np.frombuffer(bits, np.uint8)
        # All bitmaps as one: an ordinal counts over all slices.
        before = np.append(0, np.cumsum(BITS[data]))
        for batch in batches:
            found = _select(data, before, batch.column(batch.schema.get_field_index(ordinal)).to_numpy())
            slice_ = np.searchsorted(starts, found // 8, side="right") - 1
            index = firsts[slice_] + found - starts[slice_] * 8
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(partitions[slice_].astype(np.int32)), pa.array(index.astype(np.int32))], names=[*kept, "cand_part", "cand_index"])

    return draws.select(*kept, ordinal).mapInArrow(look_up, f"{fields}, cand_part int, cand_index int")


def _existing_by_slice(draws: DataFrame, entities: DataFrame, ordinal: str, slices: SliceMap) -> DataFrame:
    kept, fields = _drawn_fields(draws, ordinal)
    spark = entities.sparkSession
    starts = spark.sparkContext.broadcast((slices.starts, slices.partitions))
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    blocks = math.ceil(2 * tasks / max(1, len(slices.numbers)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, partitions = starts.value
        for batch in batches:
            found = np.searchsorted(before, batch.column(batch.schema.get_field_index(ordinal)).to_numpy(), side="right") - 1
            inner = batch.column(batch.schema.get_field_index(ordinal)).to_numpy() - before[found]
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            parts = pa.array(partitions[found].astype(np.int32)) if len(found) else pa.array([], pa.int32())
            yield pa.RecordBatch.from_arrays([*columns, parts, pa.array(found.astype(np.int32)), pa.array(inner.astype(np.int64))], names=[*kept, "cand_part", "_slice", "_place"])

    placed = draws.select(*kept, ordinal).mapInArrow(place, f"{fields}, cand_part int, _slice int, _place long")
    block = F.pmod(F.xxhash64("_place", *kept), F.lit(blocks)).cast("int")
    maps = bitmaps(entities, slices).withColumnRenamed("slice", "_of")
    # Only the first row of a slice's block carries the bitmap: it goes once to each task that asks for it.
    empty = [F.lit(None).cast(draws.schema[c].dataType).alias(c) for c in kept]
    both = placed.select(*kept, "cand_part", "_slice", block.alias("_block"), "_place", F.lit(None).cast("long").alias("_first"), F.lit(None).cast("binary").alias("_bits"))
    copies = maps.select(*empty, F.lit(None).cast("int").alias("cand_part"), F.col("_of").alias("_slice"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("_block"), F.lit(-1).cast("long").alias("_place"), F.col("first").alias("_first"), F.col("bits").alias("_bits"))
    dealt = both.unionByName(copies).repartition("_slice", "_block").sortWithinPartitions("_slice", "_block", "_place")

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, bits = 0, b""
        for batch in batches:
            where = {n: batch.schema.get_field_index(n) for n in ("_slice", "_block", "_place", "_first", "_bits")}
            if not batch.num_rows:
                continue
            numbers, dealt_to, places = (batch.column(where[n]).to_numpy() for n in ("_slice", "_block", "_place"))
            index = np.zeros(len(places), np.int64)
            cuts = np.flatnonzero(np.append(True, (numbers[1:] != numbers[:-1]) | (dealt_to[1:] != dealt_to[:-1]))).tolist() + [len(numbers)]
            for start, stop in zip(cuts[:-1], cuts[1:]):
                if places[start] == -1:
                    first, bits = batch.column(where["_first"])[start].as_py(), batch.column(where["_bits"])[start].as_py()
                    start += 1
                if start < stop:
                    index[start:stop] = first + select(bits, places[start:stop])
            real = pa.array(places >= 0)
            columns = [batch.column(batch.schema.get_field_index(c)) for c in (*kept, "cand_part")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(index.astype(np.int32))], names=[*kept, "cand_part", "cand_index"]).filter(real)

    return dealt.mapInArrow(look_up, f"{fields}, cand_part int, cand_index int")
