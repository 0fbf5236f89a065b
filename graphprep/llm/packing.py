"""Mixture-controlled packing of token sequences by deficit round-robin.

Each source is a queue of its documents' tokens. In every round, which is one window long, a queue's deficit grows by
its share of the window and the queue hands out what its deficit covers, in pieces of ``QUANTUM`` tokens; the rest is
carried to the next round. The rounds' output, one after the other, is cut into windows. What a queue has handed out
after ``r`` rounds is ``QUANTUM * floor(r * share * window / QUANTUM)``, at most all it has, so the deficits carried into
any round are known from the queues' sizes alone: each task finds the windows of its own documents, partitions carry
deficits to each other without waiting for each other, and no text moves. An empty queue is passed over, so the others'
shares of a window grow.

The last window is cut into sequences of powers of two, so nothing is padded.

There are many queues if there are many sources: the ``OWN_QUEUES`` largest have one each, the others share ``GROUPS``.

Defined results: a null text has one token, the end of document; a null source is a queue of its own; repeated rows are
packed row by row; an empty table gives an empty one.
"""

from __future__ import annotations

import array
import base64
import re
import sys
import zlib
from collections.abc import Iterator, Mapping
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graphprep.llm.common import columns_of, extended
from graphprep.workspace import stage

LENGTH = 1024
QUANTUM = 32
END = 0
#: Sources with a queue of their own, the largest ones. Those beyond share ``GROUPS`` queues by a hash of their names, each with
#: the sum of its sources' proportions: what tasks are told is bounded, and all sources are packed.
OWN_QUEUES = 10_000
GROUPS = 256
#: Tokens whose pieces are worked out at once.
BATCH = 1 << 18
VOCABULARY = "byte_bpe_50k.tiktoken"
#: Between two words parted by one space, the tokenizer's own pattern always cuts before the space.
CUTS = re.compile(r"(?<=\S) (?=\S)")


class Encoder:
    """Ids of a text as little-endian 16-bit numbers.

    Texts of more than ``part`` characters are encoded in parts, cut where the tokenizer cuts in any case, which bounds what one
    call gives back. The ids equal those of the tokenizer's JSON file, which a test holds them against.
    """

    part = 1 << 20

    def __init__(self, ranks_path: str, pattern: str) -> None:
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.encode = tiktoken.Encoding("bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def ids(self, text: str) -> bytes:
        found = array.array("H", self.encode(text))
        if sys.byteorder == "big":
            found.byteswap()
        return found.tobytes()

    def __call__(self, text: str) -> bytes:
        out, at = [], 0
        while len(text) - at > self.part and (cut := CUTS.search(text, at + self.part)):
            out.append(self.ids(text[at : cut.start()]))
            at = cut.start()
        return b"".join([*out, self.ids(text[at:] if at else text)])


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder_of(tokenizer: tuple[str, str]) -> Encoder:
    """The encoder of this worker process; it outlives tasks."""
    if tokenizer not in _encoders:
        _encoders[tokenizer] = Encoder(*tokenizer)
    return _encoders[tokenizer]


def default_tokenizer() -> tuple[str, str]:
    """Path of the ranks and the pattern, of the same vocabulary as ``byte_bpe_50k.json``."""
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN


def tokenized(docs: DataFrame, tokenizer: tuple[str, str] | None = None) -> DataFrame:
    """``doc_id, source, block, before, tokens, ids``, stored.

    ``block`` is the task that made a row and ``before`` counts the tokens of its source that came before in that block.
    Both are stored with the row, so a task that runs again changes nothing.
    """
    rows = docs.select("doc_id", F.col("source").cast("string").alias("source"), F.coalesce("text", F.lit("")).alias("text"))
    schema = extended(rows.drop("text"), "block int, before bigint, tokens bigint, ids binary")
    names = schema.names
    given = tokenizer

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tuple(given or default_tokenizer()))
        block = TaskContext.get().partitionId()
        sums: dict[str | None, int] = {}
        end = np.array([END], "<u2").tobytes()
        for batch in batches:
            sources, texts = columns_of(batch, "source", "text")
            before, tokens, ids = [], [], []
            for source, text in zip(sources, texts):
                own = encoder(text) + end
                before.append(sums.get(source, 0))
                tokens.append(len(own) // 2)
                sums[source] = before[-1] + tokens[-1]
                ids.append(own)
            n = len(ids)
            columns = [pa.array([block] * n, pa.int32()), pa.array(before, pa.int64()), pa.array(tokens, pa.int64()), pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=names)

    return stage(rows.mapInArrow(encode, schema), "pack-tokens")


class Schedule(NamedTuple):
    """What every task knows: the queues' sizes and their credit per round, in visiting order."""

    sizes: np.ndarray
    credits: np.ndarray
    quantum: int
    length: int

    def served(self, rounds: np.ndarray) -> np.ndarray:
        """Tokens each queue (columns) has handed out after each number of rounds (rows)."""
        whole = np.floor(rounds[:, None] * self.credits / self.quantum).astype(np.int64) * self.quantum
        return np.minimum(whole, self.sizes)

    def rounds_of(self, queue: int, start: int, stop: int) -> np.ndarray:
        """The rounds that hand out a run of a queue's tokens: for each of its quanta the first after which it is handed out."""
        credit = self.credits[queue]
        tokens = np.arange(start // self.quantum, (stop - 1) // self.quantum + 1, dtype=np.int64) * self.quantum
        r = np.maximum(1.0, np.floor((tokens + self.quantum) / credit) - 1)
        while len(late := np.flatnonzero(np.floor(r * credit / self.quantum) * self.quantum <= tokens)):
            r[late] += 1
        return np.unique(r)

    def spans(self, queue: int, start: int, stop: int) -> Iterator[tuple[int, int, int]]:
        """``(first token, tokens, place in the output)`` of the pieces of a run of a queue's tokens."""
        return zip(*(x.tolist() for x in self.span_arrays(queue, start, stop)))

    def span_arrays(self, queue: int, start: int, stop: int) -> list[np.ndarray]:
        """The same as arrays.

        Only the rounds that hand out some of the run are looked at: at most one for each of its quanta, however rarely the
        queue has its turn.
        """
        rounds = self.rounds_of(queue, start, stop)
        step = max(1, 2_000_000 // len(self.sizes))
        found = []
        for at in range(0, len(rounds), step):
            some = rounds[at : at + step]
            old, new = self.served(some - 1), self.served(some)
            ahead = (new[:, :queue] - old[:, :queue]).sum(axis=1)
            low, high = np.maximum(old[:, queue], start), np.minimum(new[:, queue], stop)
            place = old.sum(axis=1) + ahead + low - old[:, queue]
            has = high > low
            found.append((low[has], (high - low)[has], place[has]))
        return [np.concatenate(x) for x in zip(*found)]

    def tail(self) -> tuple[int, list[int]]:
        """Where the last, incomplete window begins and where its sequences, each a power of two, begin."""
        total = int(self.sizes.sum())
        start, rest = total - total % self.length, total % self.length
        begins = []
        for power in reversed(range(self.length.bit_length())):
            if rest & (1 << power):
                begins.append(start + sum(1 << p for p in range(power + 1, self.length.bit_length()) if rest & (1 << p)))
        return start, begins

    def pieces(self, queue: int, starts: np.ndarray, sizes: np.ndarray, tail: tuple[int, list[int]]) -> list[np.ndarray]:
        """``document, first token in it, sequence, offset`` of the pieces of documents that follow each other in a queue, from ``starts`` on."""
        first, tokens, place = self.span_arrays(queue, int(starts[0]), int(starts[-1] + sizes[-1]))
        # A piece ends where a span, a document or a sequence does.
        begin, begins = tail[0], np.array(tail[1], np.int64)
        window = place // self.length
        n = (place + tokens - 1) // self.length - window
        span = np.repeat(np.arange(len(first)), n)
        ends = (window[span] + 1 + np.arange(len(span)) - np.repeat(np.cumsum(n) - n, n)) * self.length
        late = np.flatnonzero(place + tokens > begin)
        inside = (begins > place[late, None]) & (begins < (place + tokens)[late, None])
        at, which = np.nonzero(inside)
        cuts = np.unique(np.concatenate([first, starts, first[span] + ends - place[span], first[late][at] + begins[which] - place[late][at]]))
        span = np.searchsorted(first, cuts, "right") - 1
        document = np.searchsorted(starts, cuts, "right") - 1
        place = place[span] + cuts - first[span]
        sequence, offset = place // self.length, place % self.length
        late = np.flatnonzero(place >= begin)
        if len(late):
            k = np.searchsorted(begins, place[late], "right") - 1
            sequence[late], offset[late] = begin // self.length + k, place[late] - begins[k]
        return [document, cuts - starts[document], sequence, offset]


def schedule_of(sizes: list[int], shares: list[float] | None = None, length: int = LENGTH, quantum: int = QUANTUM) -> Schedule:
    """``shares`` default to the queues' own, so that all queues end together."""
    weights = np.array(shares if shares is not None else sizes, np.float64)
    if len(weights) and weights.min() <= 0:
        raise ValueError("every queue needs a positive share")
    credits = weights / weights.sum() * length if len(weights) else weights
    return Schedule(np.array(sizes, np.int64), credits, quantum, length)


def batches_of(tokens: np.ndarray) -> Iterator[slice]:
    """Rows in slices of about ``BATCH`` tokens, at least a row each."""
    number = (np.cumsum(tokens) - tokens) // BATCH
    begins = np.flatnonzero(np.diff(number, prepend=-1))
    yield from map(slice, begins.tolist(), [*begins[1:].tolist(), len(tokens)])


def queues_of(blocks: DataFrame, shares: Mapping[str | None, float] | None) -> tuple[DataFrame, list[int], list[float] | None]:
    """``_source, _queue``; and each queue's tokens and share, in visiting order: by name, null last, then the groups."""
    spark = blocks.sparkSession
    sizes = stage(blocks.groupBy("source").agg(F.sum("n").alias("n")), "pack-sources")
    group = F.pmod(F.crc32(F.encode(F.coalesce("source", F.lit("")), "UTF-8")), F.lit(GROUPS)).cast("int")
    own = sizes.orderBy(F.desc("n"), F.asc_nulls_first("source")).limit(OWN_QUEUES).collect()
    own = sorted(own, key=lambda q: (q["source"] is None, q["source"] or ""))
    number = {q["source"]: i for i, q in enumerate(own)}
    named = spark.createDataFrame([(s, i) for s, i in number.items()], "_own string, _number int")
    placed = sizes.join(F.broadcast(named), F.col("source").eqNullSafe(F.col("_own")), "left")
    placed = placed.select(F.col("source").alias("_source"), F.coalesce("_number", group + len(own)).alias("_queue"), "n", F.col("_number").isNull().alias("grouped"))
    tokens = [q["n"] for q in own] + [0] * GROUPS
    for row in placed.where("grouped").groupBy("_queue").agg(F.sum("n").alias("n")).collect():
        tokens[row["_queue"]] = row["n"]
    given = None
    if shares is not None:
        if missing := [q["source"] for q in own if q["source"] not in shares]:
            raise ValueError(f"no share for {missing[:5]}")
        given = [float(shares[q["source"]]) for q in own] + [0.0] * GROUPS
        for source, share in shares.items():
            if source not in number:
                given[len(own) + zlib.crc32((source or "").encode()) % GROUPS] += share
    return placed.select("_source", "_queue"), tokens, given


def pack(
    docs: DataFrame,
    shares: Mapping[str | None, float] | None = None,
    length: int = LENGTH,
    quantum: int = QUANTUM,
    tokenizer: tuple[str, str] | None = None,
    with_ids: bool = True,
) -> DataFrame:
    """Pieces: ``doc_id, source, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids`` (16-bit ids, if wanted).

    ``shares`` gives the target proportion of each source; by default each has its share of all tokens.
    """
    if length & (length - 1):
        raise ValueError("the length must be a power of two")
    tokens = tokenized(docs, tokenizer)
    blocks = stage(tokens.groupBy("source", "block").agg(F.sum("tokens").alias("n")), "pack-blocks")
    named, sizes, given = queues_of(blocks, shares)
    # Queues without tokens are left out, so that every one has a share.
    used = [i for i, n in enumerate(sizes) if n]
    order = {queue: i for i, queue in enumerate(used)}
    schedule = schedule_of([sizes[i] for i in used], given and [given[i] for i in used], length, quantum)
    # One row per task and source: sums of sums, far smaller than the data.
    earlier = Window.partitionBy("_queue").orderBy("source", "block").rowsBetween(Window.unboundedPreceding, -1)
    queued = blocks.join(named, blocks["source"].eqNullSafe(named["_source"])).drop("_source")
    starts = queued.select(F.col("source").alias("_source"), F.col("block").alias("_block"), "_queue", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("queue_start"))
    starts = stage(starts, "pack-starts")
    placed = tokens.join(starts, tokens["source"].eqNullSafe(starts["_source"]) & (tokens["block"] == starts["_block"]))
    rows = placed.select("doc_id", "source", F.col("_queue").alias("queue"), (F.col("queue_start") + F.col("before")).alias("at"), "tokens", "ids")
    columns = {"start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(), "doc_tokens": pa.int64(), "sequence_id": pa.int64(), "offset": pa.int64()}
    columns |= {"ids": pa.binary()} if with_ids else {}
    kinds = ", ".join(f"{name} {'binary' if name == 'ids' else 'bigint'}" for name in columns)
    schema = extended(rows.select("doc_id", "source"), kinds)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail = schedule.tail()
        for batch in batches:
            queues, at, tokens_ = (np.array(x, np.int64) for x in columns_of(batch, "queue", "at", "tokens"))
            for part in batches_of(tokens_):  # bounds what one output batch holds
                slice_ = batch.slice(part.start, part.stop - part.start)
                (ids,) = columns_of(slice_, "ids")
                data = b"".join(ids)
                sizes, starts, own = tokens_[part], at[part], queues[part]
                base = np.cumsum(sizes) - sizes
                made = []
                # Documents that follow each other in their queue are worked on together.
                by_queue = np.lexsort((starts, own))
                follows = (np.diff(own[by_queue]) == 0) & (starts[by_queue][1:] == (starts + sizes)[by_queue][:-1])
                for run in np.split(by_queue, np.flatnonzero(~follows) + 1):
                    document, low, *places = schedule.pieces(order[int(own[run[0]])], starts[run], sizes[run], tail)
                    made.append((run[document], low, *places))
                row, low, sequence, offset = (np.concatenate(x) for x in zip(*made))
                # In the order of the ids, of which each is in one piece.
                begins = base[row] + low
                in_order = np.argsort(begins)
                row, low, sequence, offset, begins = (x[in_order] for x in (row, low, sequence, offset, begins))
                ends = np.append(begins[1:], len(data) // 2)
                wide = memoryview(np.frombuffer(data, "<u2").astype("<u4").tobytes())
                crcs = [zlib.crc32(wide[i:j]) for i, j in zip((4 * begins).tolist(), (4 * ends).tolist())]
                values = [low, ends - begins, crcs, sizes[row], sequence, offset]
                if with_ids:
                    values.append([data[i:j] for i, j in zip((2 * begins).tolist(), (2 * ends).tolist())])
                takes = pa.array(row)
                found = [pa.array(column, kind) for column, kind in zip(values, columns.values())]
                yield pa.RecordBatch.from_arrays([slice_.column(0).take(takes), slice_.column(1).take(takes), *found], names=schema.names)

    return rows.mapInArrow(pieces, schema)
