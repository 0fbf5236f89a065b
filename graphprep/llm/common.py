"""What several operators share: words, rows that keep their columns, and distributed running sums.

A word is a maximal run of characters other than ASCII white space (``[^\\x20\\x09-\\x0D]+``) in every operator.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphprep.workspace import stage

SPACES = "[ \\t\\n\\x0B\\f\\r]+"
SHINGLE = 5


def words_of(text: str) -> list[bytes]:
    """The words of a text; ``bytes.split`` cuts at ASCII white space only, as the definition asks."""
    return text.encode().split()


def word_count(text: Column) -> Column:
    """Number of words as a bigint; 0 for null. Cutting at runs leaves empty pieces at the two ends only."""
    pieces = F.split(F.coalesce(text, F.lit("")), SPACES, -1)
    ends = (F.get(pieces, F.lit(0)) == "").cast("int") + (F.get(pieces, F.size(pieces) - 1) == "").cast("int")
    return F.when(F.size(pieces) == 1, 1 - F.when(F.get(pieces, F.lit(0)) == "", 1).otherwise(0)).otherwise(F.size(pieces) - ends).cast("bigint")


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingles:
    """64-bit hashes of the runs of ``size`` words of a text, one for each place.

    Words are joined by one space, and a run's hash is a polynomial of its bytes, taken from running sums over a
    segment of the text: the powers grow with the longest segment, not with the text.
    """

    base = 0x9E3779B97F4A7C15
    segment = 65_536

    def __init__(self, size: int = SHINGLE) -> None:
        self.size = size
        self._grow(1 << 16)

    def _grow(self, n: int) -> None:
        inverse = pow(self.base, -1, 2**64)
        self.powers = np.multiply.accumulate(np.full(n, self.base, np.uint64))
        self.inverses = np.multiply.accumulate(np.full(n, inverse, np.uint64))

    def __call__(self, text: str) -> np.ndarray:
        joined = b" ".join(text.encode().split())
        if not joined:
            return np.empty(0, np.uint64)
        data = np.frombuffer(joined, np.uint8)
        spaces = np.flatnonzero(data == 32)
        starts, ends = np.append(0, spaces + 1), np.append(spaces, len(data))
        n = max(1, len(starts) - self.size + 1)
        starts, ends = starts[:n], ends[-n:]
        found = np.empty(n, np.uint64)
        for at in range(0, n, self.segment):
            start, end = starts[at : at + self.segment], ends[at : at + self.segment]
            part = data[start[0] : end[-1]]
            if len(part) > len(self.powers):
                self._grow(2 * len(part))
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum((part.astype(np.uint64) + np.uint64(1)) * self.powers[: len(part)], out=sums[1:])
            found[at : at + self.segment] = (sums[end - start[0]] - sums[start - start[0]]) * self.inverses[start - start[0]]
        return mixed(found)


def shingle_set(text: str, size: int = SHINGLE) -> set[tuple[bytes, ...]]:
    """The shingles themselves, for exact comparisons."""
    words = words_of(text)
    if not words:
        return set()
    if len(words) < size:
        return {tuple(words)}
    return set(zip(*(words[i:] for i in range(size))))


def wrapped(docs: DataFrame, *derived: Column) -> DataFrame:
    """``doc`` (a struct of all columns, so none can clash with an operator's own), ``id`` and the derived columns.

    ``id`` numbers the rows. It is only the same in two reads if the result is stored in between.
    """
    return docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), F.monotonically_increasing_id().alias("id"), *derived)


def cumulate(table: DataFrame, group: Sequence[str], order: Sequence[str], sums: dict[str, Column], name: str) -> DataFrame:
    """Adds, for each of ``sums``, the sum over the rows before a row in its group, in the given order.

    The rows are dealt out by ranges of (group, order) and stored, so a group of any size is spread over many tasks as
    long as ``order`` tells its rows apart; each range sums its own rows, and the sums of whole ranges, one row per range
    and group, are added. Pass a stored table: it is read twice to find the ranges.
    """
    values = {f"_value_{k}": v for k, v in sums.items()}
    keys = [*group, *order]
    dealt = table.withColumns(values).repartitionByRange(*[F.col(c) for c in keys]).withColumn("_range", F.spark_partition_id())
    placed = stage(dealt, name)
    inner = Window.partitionBy("_range", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("_range", *group).agg(*[F.sum(v).alias(v) for v in values])
    starts = totals.select(
        F.col("_range").alias("_start_range"),
        *[F.col(c).alias(f"_start_{c}") for c in group],
        *[F.coalesce(F.sum(v).over(outer), F.lit(0)).alias(f"_start{v}") for v in values],
    )
    running = placed.withColumns({k: F.coalesce(F.sum(f"_value_{k}").over(inner), F.lit(0)) for k in sums})
    meets = running["_range"] == starts["_start_range"]
    for c in group:
        meets = meets & running[c].eqNullSafe(starts[f"_start_{c}"])
    joined = running.join(starts, meets)
    kept = [F.col(c) for c in table.columns]
    return joined.select(*kept, *[(F.col(k) + F.col(f"_start_value_{k}")).alias(k) for k in sums])


def columns_of(batch: pa.RecordBatch, *names: str) -> Iterator[list]:
    """Columns of a batch as Python lists."""
    for name in names:
        yield batch.column(batch.schema.get_field_index(name)).to_pylist()


def extended(table: DataFrame, ddl: str) -> T.StructType:
    """The schema of a table with further columns."""
    return T.StructType([*table.schema.fields, *T.StructType.fromDDL(ddl).fields])
