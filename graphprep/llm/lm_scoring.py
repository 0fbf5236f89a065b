"""Cross-entropy difference of matched bigram models.

A target model (documents labelled good) and a background model (all documents) have the same vocabulary, order and
smoothing. A document's score is the mean over its words of the loss under the target model minus the loss under the
background model, so the lower, the more like the target.

The vocabulary has all words that occur twice, and one entry for all others. All bigrams over it that occur twice get a
probability of their own, others are left to the smoothing; neither count depends on the size of the corpus:

    P(w | v) = L c(v, w) / c(v) + (1 - L b(v)) P(w),   P(w) = (c(w) + A) / (N + A V)

with ``b(v)`` the share of v's followers that have a probability of their own, so P sums to one. The first word of a text
has P(w).

Texts are read once, into blocks of documents in which a word is the number of its hash. What a block has to know of the
whole corpus it asks for: each of its words, then each of its bigrams, then each of its words as a first one, is sent once,
whatever its number of places, with its counts in the block. Requests are dealt out by ranges of hashes, added up, and the
sums go back to the block. These are all whole numbers, from which the block works out the losses of its own documents. So
what is shuffled and stored is in proportion to the corpus, a key has at most one row in a block, and no table of the models
is held anywhere as a whole. Words and bigrams are told apart by 64-bit hashes.

Defined results: a null text and one without words have no losses (null) and no words; a document is a target document
if any of its label rows says so; a null doc_id has no label; repeated rows count and are scored row by row; without
target documents the target model is the smoothing's uniform one; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import blake2b
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphprep.llm.common import columns_of, mixed, words_of
from graphprep.workspace import shuffles_deleted, stage

LEAST_COUNT = 2
HOT_SHARE = 1e-5  # not used any more: nothing of the models is sent to all tasks
WEIGHT = 0.7  # L
ADDED = 0.5  # A
CHUNK = 1_000_000  # words of a block of documents
DOCUMENTS = 100_000  # of a block at most
RANGE = 2_000_000  # words of the corpus for each range of hashes
OTHER = 0  # hash of no word: all words outside the vocabulary
GOOD, WORDS, PAIRS, FIRSTS = range(4)  # kinds of answers
ANSWERS = "block bigint, kind int, range int, data binary, entries bigint, n bigint, t bigint, rare_n bigint, rare_t bigint"


class Hashes:
    """64-bit hashes of words; those seen last are remembered."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = words_of(text or "")
        known = self.known
        for w in set(words).difference(known):
            h = int.from_bytes(blake2b(w, digest_size=8).digest(), "little")
            known[w] = h if h != OTHER else h + 2
        found = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        if len(known) > CHUNK:
            self.known = {}
        return found


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes, byte by byte apart, so that small numbers take little space."""
    planes = b"".join(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T.tobytes() for x in arrays)
    return np.array([len(x) for x in arrays], "<i8").tobytes() + pa.compress(planes, codec="zstd", asbytes=True)


def unpacked(data: bytes, *kinds: type) -> list[np.ndarray]:
    sizes, widths = np.frombuffer(data, "<i8", len(kinds)).tolist(), [np.dtype(k).itemsize for k in kinds]
    planes = pa.decompress(data[8 * len(kinds) :], sum(n * w for n, w in zip(sizes, widths)), codec="zstd", asbytes=True)
    found, at = [], 0
    for n, width, kind in zip(sizes, widths, kinds):
        part = np.frombuffer(planes, np.uint8, n * width, at).reshape(width, n)
        found.append(np.ascontiguousarray(part.T).view(kind).reshape(n))
        at += n * width
    return found


def steps(ordered: np.ndarray) -> np.ndarray:
    return np.diff(ordered, prepend=ordered.dtype.type(0))


def pair_keys(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mixed(a) + b


def blocks_of(docs: DataFrame) -> DataFrame:
    """``block, docs, size, data``, stored: doc_ids of a block's documents, its number of words, and packed their hashes, places and numbers."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        block = TaskContext.get().partitionId() << 32
        found: list[np.ndarray] = []
        own: list[pa.Array] = []
        size = 0

        def out() -> pa.RecordBatch:
            words, places = np.unique(np.concatenate(found), return_inverse=True)
            data = packed(steps(words), places.astype(np.uint32), np.array([len(x) for x in found], np.uint32))
            ids = pa.concat_arrays(own)
            columns = [pa.array([block]), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), pa.array([size]), pa.array([data], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["block", "docs", "size", "data"])

        for batch in batches:
            (texts,) = columns_of(batch, "text")
            start = 0
            for i, text in enumerate(texts, 1):
                found.append(hashes(text))
                size += len(found[-1])
                if size >= CHUNK or len(found) >= DOCUMENTS:
                    own.append(batch.column(0).slice(start, i - start))
                    yield out()
                    found, own, size, start, block = [], [], 0, i, block + 1
            own.append(batch.column(0).slice(start))
        if found:
            yield out()

    doc_id = docs.schema["doc_id"].dataType.simpleString()
    return stored(docs.select("doc_id", "text").mapInArrow(cut, f"block bigint, docs array<{doc_id}>, size bigint, data binary"), "lm-blocks")


def stored(table: DataFrame, name: str) -> DataFrame:
    """``stage``; what was shuffled for the table is deleted at once, as nothing else reads it."""
    with shuffles_deleted(table.sparkSession):
        return stage(table, name)


def good_rows(blocks: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """``block, kind, good``: places of the target documents in their blocks."""
    good = labels.where((F.col(label) == 1) & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("_id")).distinct()
    rows = blocks.select("block", F.posexplode("docs").alias("at", "doc_id"))
    # Labels grow with the corpus, so they are never broadcast, not even where they happen to be few.
    met = rows.join(good.hint("merge"), F.col("doc_id") == F.col("_id"), "left_semi")
    return stored(met.groupBy("block").agg(F.collect_list("at").alias("good")).select("block", F.lit(GOOD).alias("kind"), "good"), "lm-good")


class Totals(NamedTuple):
    """Words of the corpus, of its words outside the vocabulary, in all documents and in target ones; entries of the vocabulary."""

    n: np.ndarray
    outside: np.ndarray
    size: int


class Block:
    """A block with the answers it has so far."""

    def __init__(self, rows: pa.Table, answers: pa.Table) -> None:
        self.number = rows["block"][0].as_py()
        self.docs = rows["docs"].combine_chunks().flatten()
        self.docs = pa.concat_arrays(self.docs.chunks) if isinstance(self.docs, pa.ChunkedArray) else self.docs
        delta, places, sizes = unpacked(rows["data"][0].as_py(), np.uint64, np.uint32, np.uint32)
        self.words, self.places, self.sizes = np.cumsum(delta, dtype=np.uint64), places.astype(np.int64), sizes.astype(np.int64)
        self.row = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.good = np.zeros(len(self.sizes), bool)
        parts: dict[int, list[tuple[int, bytes]]] = {}
        for kind, number, data, good in zip(*(answers[c].to_pylist() for c in ("kind", "range", "data", "good"))):
            if kind == GOOD:
                self.good[good] = True
            else:
                parts.setdefault(kind, []).append((number, data))
        # Requests were in the order of their keys and so are ranges of keys.
        self.answers = {kind: [np.concatenate(x) for x in zip(*(unpacked(d, np.int64, np.int64, np.uint8) for _, d in sorted(of)))] for kind, of in parts.items()}

    def answer(self, kind: int) -> list[np.ndarray]:
        return self.answers.get(kind) or [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint8)]

    def word_request(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n = np.bincount(self.places, minlength=len(self.words))
        return self.words, n, np.bincount(self.places, self.good[self.row], minlength=len(self.words)).astype(np.int64)

    def entries(self) -> np.ndarray:
        """Each word's entry in the vocabulary."""
        return np.where(self.answer(WORDS)[0] >= LEAST_COUNT, self.words, np.uint64(OTHER))

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Keys of the bigrams in order; for each where it first is; where there are bigrams, and the number of each one's key."""
        at = np.flatnonzero(self.row[1:] == self.row[:-1])
        entry = self.entries()
        keys, first, key = np.unique(pair_keys(entry[self.places[at]], entry[self.places[at + 1]]), return_index=True, return_inverse=True)
        return keys, at[first], at, key

    def pair_request(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys, _, at, key = self.pairs()
        n = np.bincount(key, minlength=len(keys))
        return keys, n, np.bincount(key, self.good[self.row[at]], minlength=len(keys)).astype(np.int64)

    def first_request(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each entry, the bigrams with a probability of their own that begin with it, each in one block of all."""
        _, first, _, _ = self.pairs()
        n, t, owned = self.answer(PAIRS)
        own = (owned == 1) & (n >= LEAST_COUNT)
        entries, number = np.unique(self.entries(), return_inverse=True)
        which = number[self.places[first[own]]]
        # Sums of whole numbers, exact up to 2^53.
        return entries, *[np.bincount(which, x[own], minlength=len(entries)).astype(np.int64) for x in (n, t)]

    def losses(self, totals: Totals, weight: float, added: float) -> list[np.ndarray]:
        """Each document's loss under the background and under the target model."""
        _, first, at, key = self.pairs()
        entry = self.entries()
        _, number = np.unique(entry, return_inverse=True)
        begins = np.cumsum(self.sizes)[self.sizes > 0] - self.sizes[self.sizes > 0]
        kept = self.answer(PAIRS)[0] >= LEAST_COUNT
        a, b = self.places[first], self.places[first + 1] if len(first) else first
        out = []
        for m in range(2):
            count = np.where(entry == OTHER, totals.outside[m], self.answer(WORDS)[m])
            p = (count + added) / (totals.n[m] + added * totals.size)
            some = np.maximum(count, 1)
            follow = 1.0 - np.where(count > 0, weight * self.answer(FIRSTS)[m][number] / some, 0.0)
            own = np.where(kept & (count[a] > 0), weight * self.answer(PAIRS)[m] / some[a], 0.0)
            loss = -np.log(follow[a] * p[b] + own)
            total = np.bincount(self.row[at], loss[key], minlength=len(self.sizes))
            out.append(total + np.bincount(self.row[begins], -np.log(p[self.places[begins]]), minlength=len(self.sizes)))
        return out


def added_up(batches: Iterator[pa.RecordBatch], kind: int) -> Iterator[pa.RecordBatch]:
    """Answers to all requests of some ranges: each key's sums, and whether its first request is this one."""
    asked: dict[int, list[tuple[int, bytes]]] = {}
    for batch in batches:
        for number, block, data in zip(*columns_of(batch, "range", "block", "data")):
            asked.setdefault(number, []).append((block, data))
    schema = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("range", pa.int32()), ("data", pa.binary()), *[(c, pa.int64()) for c in ("entries", "n", "t", "rare_n", "rare_t")]])
    for number in list(asked):
        # By block, so that the first request is the same one if the task runs again.
        requests = sorted(asked.pop(number))
        parts = [unpacked(data, np.uint64, np.int64, np.int64) for _, data in requests]
        ends = np.cumsum([len(p[0]) for p in parts])
        keys = np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts])
        order = np.argsort(keys, kind="stable")
        new = np.append(True, keys[order][1:] != keys[order][:-1])
        begins, group = np.flatnonzero(new), np.cumsum(new) - 1
        del keys
        first = np.zeros(len(order), np.uint8)
        first[order] = new
        sums, back = [], []
        for x in (1, 2):
            sums.append(np.add.reduceat(np.concatenate([p[x] for p in parts])[order], begins))
            back.append(np.empty(len(order), np.int64))
            back[-1][order] = sums[-1][group]
        rare = sums[0] < LEAST_COUNT
        totals = [int((~rare).sum()), *[int(s.sum()) for s in sums], *[int(s[rare].sum()) for s in sums]]
        for i, (block, _) in enumerate(requests):
            part = slice(ends[i] - len(parts[i][0]), ends[i])
            row = [block, kind, number, packed(back[0][part], back[1][part], first[part]), *(totals if i == 0 else [0] * 5)]
            yield pa.RecordBatch.from_arrays([pa.array([x], field.type) for x, field in zip(row, schema)], schema=schema)


def answered(blocks: DataFrame, answers: DataFrame, kind: int, ranges: int) -> DataFrame:
    """The answers to what all blocks ask, stored."""
    request: Callable = {WORDS: Block.word_request, PAIRS: Block.pair_request, FIRSTS: Block.first_request}[kind]

    def ask(rows: pa.Table, known: pa.Table) -> pa.Table:
        block = Block(rows, known)
        keys, n, t = request(block)
        dealt = ((keys >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
        cuts = np.searchsorted(dealt, np.arange(ranges + 1, dtype=np.uint64))
        some = [(i, slice(x, y)) for i, (x, y) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())) if y > x]
        data = [packed(steps(keys[part]), n[part], t[part]) for _, part in some]
        columns = [pa.array([i for i, _ in some], pa.int32()), pa.array([block.number] * len(some), pa.int64()), pa.array(data, pa.binary())]
        return pa.Table.from_arrays(columns, names=["range", "block", "data"])

    requests = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(ask, "range int, block bigint, data binary")
    return stored(requests.repartitionById(ranges, F.col("range")).mapInArrow(lambda batches: added_up(batches, kind), ANSWERS), f"lm-answers-{kind}")


def score(docs: DataFrame, labels: DataFrame, label: str = "quality", weight: float = WEIGHT, added: float = ADDED) -> DataFrame:
    """``doc_id, n_words, target_loss, background_loss, difference`` for every row of ``doc_id, text``; losses in nats per word."""
    blocks = blocks_of(docs)
    good = good_rows(blocks, labels, label)
    known = good.select("block", "kind", F.lit(None).cast("int").alias("range"), F.lit(None).cast("binary").alias("data"), "good")
    join = lambda table: known.unionByName(table.select("block", "kind", "range", "data", F.lit(None).cast("array<int>").alias("good")))
    size = blocks.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    ranges = max(docs.sparkSession.sparkContext.defaultParallelism, -(-size // RANGE))
    words = answered(blocks, known, WORDS, ranges)
    sums = words.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("n", "t", "rare_n", "rare_t", "entries")]).first()
    totals = Totals(np.array(sums[:2]), np.array(sums[2:4]), sums[4] + 1)
    known = join(words)
    known = join(answered(blocks, known, PAIRS, ranges))
    known = join(answered(blocks, known, FIRSTS, ranges))
    names = ["doc_id", "n_words", "target_loss", "background_loss", "difference"]

    def scored(rows: pa.Table, answers: pa.Table) -> pa.Table:
        block = Block(rows, answers)
        none = block.sizes == 0
        background, target = (x / np.maximum(block.sizes, 1) for x in block.losses(totals, weight, added))
        losses = [pa.array(x, pa.float64(), mask=none) for x in (target, background, target - background)]
        return pa.Table.from_arrays([block.docs, pa.array(block.sizes, pa.int64()), *losses], names=names)

    doc_id = docs.schema["doc_id"].dataType.simpleString()
    kinds = f"doc_id {doc_id}, n_words bigint, target_loss double, background_loss double, difference double"
    return blocks.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(scored, kinds)
