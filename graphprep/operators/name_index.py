"""A stored index of names for word and substring search.

``entries/`` holds ``id, value, label``, numbered in the order in which answers are given: matches sorted by id are sorted as
they are shown, so a match's rank is its place, and no answer is ever sorted.

``postings/bucket=<b>/`` holds ``term, range, n, shift, data``: for a term and a range of 65,536 ids, the ids (for trigrams with
the places they are at) as differences of a byte or two. A bucket is a hash of the term; files are sorted by term. A search
reads the buckets of the terms it asks for.

A question is worked on range by range, in the ranges that its rarest term is in. A cell holds the blocks of one range once, for
all questions that are asked there, and a question's lists are looked up in each other from the shortest to the longest, so
that only what is left of the shortest is ever held. Trigrams are taken every third place: a label holds the question if the
places fit. Labels are fetched last, for the rows of the pages alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from graphprep.functions import postings
from graphprep.functions.text import GRAM
from graphprep.operators.lookup import small_copy
from graphprep.workspace import scratch_path, stage

RANGE_BITS = 16
BUCKETS = 64
#: Characters of names that a task indexes at once.
FLUSH_CHARS = 4_000_000
POSTINGS = "term string, range int, n int, shift int, data binary"
WORD, GRAMS = "word", "gram"


class NameIndex(NamedTuple):
    kind: str
    entries: DataFrame
    postings: DataFrame


def bucket_of(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(BUCKETS)).cast("int")


def read_index(spark: SparkSession, path: str, kind: str) -> NameIndex:
    stored = spark.read.schema(f"{POSTINGS}, bucket int").parquet(f"{path}/postings")
    return NameIndex(kind, spark.read.schema("id long, value string, label string").parquet(f"{path}/entries"), stored)


def _characters(texts: list[str], ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """``keys, occurrences, shift, size`` of all substrings of one to three characters; places are kept for three."""
    points = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4").astype(np.int64)
    sizes = np.array([len(t) for t in texts])
    owner = np.repeat(np.arange(len(texts)), sizes)
    place = np.arange(len(points)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    yield np.zeros(len(ids), np.int64), ids, 0, 0
    for size in range(1, GRAM + 1):
        n = len(points) - size + 1
        if n <= 0:
            break
        whole = np.flatnonzero(owner[:n] == owner[size - 1 :])
        keys = points[whole]
        for j in range(1, size):
            keys = (keys << 21) | points[whole + j]
        if size < GRAM:
            yield keys, ids[owner[whole]], 0, size
        else:
            shift = int(place.max()).bit_length()
            yield keys, (ids[owner[whole]] << shift) | place[whole], shift, size


def _blocks_of(keys: np.ndarray, occurrences: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Each key with the number of its distinct occurrences and their block."""
    order = np.lexsort((occurrences, keys))
    keys, occurrences = keys[order], occurrences[order]
    new = np.append(True, (keys[1:] != keys[:-1]) | (occurrences[1:] != occurrences[:-1]))
    keys, occurrences = keys[new], occurrences[new]
    begins = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    data, starts = postings.encode(occurrences, begins)
    whole = data.tobytes()
    cuts = [*starts.tolist(), len(whole)]
    return keys[begins], np.diff(np.append(begins, len(keys))), [whole[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


def _index(kind: str):
    """Names in the order of their ids to posting blocks."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: list[str] = []
        ids: list[int] = []
        held, open_ = 0, None

        def blocks() -> Iterator[pa.RecordBatch]:
            low = np.array(ids, np.int64) & ((1 << RANGE_BITS) - 1)
            if kind == WORD:
                numbers: dict[str, int] = {}
                words = [t.split(" ") for t in texts]
                keys = np.array([numbers.setdefault(w, len(numbers)) for ws in words for w in ws], np.int64)
                terms = list(numbers)
                parts = [(keys, np.repeat(low, [len(ws) for ws in words]), 0, lambda k: terms[k])]
            else:
                spelled = lambda size: lambda k: "".join(chr((k >> (21 * j)) & 0x1FFFFF) for j in reversed(range(size)))
                parts = [(k, o, shift, spelled(size)) for k, o, shift, size in _characters(texts, low)]
            for keys, occurrences, shift, name in parts:
                if len(keys):
                    found, n, data = _blocks_of(keys, occurrences)
                    columns = [pa.array([name(k) for k in found.tolist()]), pa.array(np.full(len(n), open_, np.int32)), pa.array(n.astype(np.int32)), pa.array(np.full(len(n), shift, np.int32)), pa.array(data, pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, names=["term", "range", "n", "shift", "data"])

        for batch in batches:
            for id_, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if open_ != id_ >> RANGE_BITS or held >= FLUSH_CHARS:
                    if texts:
                        yield from blocks()
                    texts, ids, held, open_ = [], [], 0, id_ >> RANGE_BITS
                texts.append(text)
                ids.append(id_)
                held += len(text) + 1
        if texts:
            yield from blocks()

    return work


def write_index(rows: DataFrame, order: list[Column], kind: str, path: str) -> NameIndex:
    """Index ``rows(value, label, text)``, ``text`` lower-cased, numbered by ``order`` (over further columns of ``rows``, too)."""
    spark = rows.sparkSession
    placed = rows.where(F.col("text").isNotNull()).repartitionByRange(*order).sortWithinPartitions(*order)
    # The number of a row in its range and that of the range, in one.
    placed = stage(placed.select("value", "label", "text", F.monotonically_increasing_id().alias("_place")), "index-rows")
    part, inner = F.shiftright("_place", 33).alias("part"), F.col("_place").bitwiseAND((1 << 33) - 1)
    sizes = sorted((r["part"], r["count"]) for r in placed.groupBy(part).count().collect())
    starts, total = [], 0
    for number, n in sizes:
        starts.append((number, total))
        total += n
    before = spark.createDataFrame(starts, "part long, before long")
    numbered = placed.withColumn("part", part).join(F.broadcast(before), "part").withColumn("id", F.col("before") + inner)
    numbered.select("id", "value", "label").write.mode("overwrite").parquet(f"{path}/entries")
    blocks = numbered.select("id", "text").mapInArrow(_index(kind), POSTINGS).withColumn("bucket", bucket_of(F.col("term")))
    spread = blocks.hint("rebalance", "bucket").sortWithinPartitions("bucket", "term", "range")
    spread.write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/postings")
    return read_index(spark, path, kind)


def write_word_index(names: DataFrame, path: str) -> NameIndex:
    """Index ``names(name, ent, count)`` by words; the most frequent first."""
    label = F.concat_ws(" ", "name", F.col("count").cast("string"), "ent")
    rows = names.select(F.col("ent").alias("value"), label.alias("label"), F.lower("name").alias("text"), "count")
    return write_index(rows, [F.desc("count"), F.asc("value")], WORD, path)


def write_label_index(labels: DataFrame, path: str) -> NameIndex:
    """Index ``labels(uri, label)`` by the characters of the labels, in the order of the uris."""
    rows = labels.select(F.col("uri").alias("value"), "label", F.lower("label").alias("text"))
    return write_index(rows, [F.asc("value"), F.asc("label")], GRAMS, path)


def scratch_index(rows: DataFrame, kind: str) -> NameIndex:
    """The index of names that are searched once."""
    path = scratch_path(rows.sparkSession, f"{kind}-index")
    return write_word_index(rows, path) if kind == WORD else write_label_index(rows, path)


def _terms(kind: str) -> Column:
    """``array<struct<offset, term>>`` of a question."""
    question = F.col("question")
    if kind == WORD:
        return F.transform(F.array_distinct(F.split(question, " ", -1)), lambda w: F.struct(F.lit(0).alias("offset"), w.alias("term")))
    last = F.length(question) - GRAM
    places = F.array_distinct(F.concat(F.sequence(F.lit(0), last, F.lit(GRAM)), F.array(last)))
    long_ = F.transform(places, lambda i: F.struct(i.alias("offset"), F.substring(question, i + 1, F.lit(GRAM)).alias("term")))
    return F.when(last >= 0, long_).otherwise(F.array(F.struct(F.lit(0).alias("offset"), question.alias("term"))))


class _Cell:
    """The posting blocks of one range; a term's numbers are decoded when they are first asked for."""

    def __init__(self) -> None:
        self.blocks: dict[str, list[tuple[int, bytes]]] = {}
        self.decoded: dict[str, np.ndarray] = {}

    def numbers(self, term: str, placed: bool) -> np.ndarray:
        found = self.decoded.get(term)
        if found is None:
            lists = []
            for shift, data in self.blocks.get(term, ()):
                values = postings.decode(data)
                lists.append(((values >> shift) << 32) | (values & ((1 << shift) - 1)) if placed else values)
            found = np.concatenate(lists) if lists else np.zeros(0, np.int64)
            if len(lists) > 1:
                found.sort()
            self.decoded[term] = found
        return found

    def matches(self, terms: list[dict], placed: bool) -> np.ndarray:
        """Ids (within the range) with all terms, at fitting places."""
        left = None
        for offset, numbers in sorted(((t["offset"], self.numbers(t["term"], placed)) for t in terms), key=lambda x: len(x[1])):
            numbers = numbers - offset if offset else numbers
            left = numbers if left is None else postings.met(left, numbers)
            if not len(left):
                break
        return np.unique(left >> 32) if placed else left


def _match(kind: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, cell = None, _Cell()
        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("range", "copy", "term", "shift", "data", "question", "terms")]
            questions, ranges, found = [], [], []
            for range_, copy, term, shift, data, question, terms in zip(*columns):
                if (range_, copy) != key:
                    key, cell = (range_, copy), _Cell()
                if question is None:
                    cell.blocks.setdefault(term, []).append((shift, data))
                    continue
                placed = kind == GRAMS and len(terms[0]["term"]) == GRAM
                ids = cell.matches(terms, placed)
                if len(ids):
                    questions.append(question)
                    ranges.append(range_)
                    found.append(ids.astype(np.int32))
            sizes = np.array([len(ids) for ids in found], np.int32)
            values = np.concatenate(found) if found else np.zeros(0, np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)), pa.array(values))
            yield pa.RecordBatch.from_arrays([pa.array(questions, pa.string()), pa.array(ranges, pa.int32()), pa.array(sizes, pa.int32()), lists], names=["question", "range", "n", "ids"])

    return work


def matches(questions: DataFrame, index: NameIndex) -> DataFrame:
    """``question, range, n, ids`` for ``questions(question)``, stored: ids within a range, in order."""
    spark = questions.sparkSession
    asked = stage(questions.select("question", _terms(index.kind).alias("terms")), "asked-terms")
    terms = asked.select(F.explode("terms.term").alias("term")).distinct()
    buckets = [r["bucket"] for r in terms.select(bucket_of(F.col("term")).alias("bucket")).distinct().collect()]
    few = small_copy(terms)
    wanted = F.broadcast(few) if few is not None else terms
    # Only the asked buckets are listed and read, and of them only the asked terms are handed on.
    used = index.postings.where(F.col("bucket").isin(buckets)).join(wanted, "term", "left_semi")
    sizes = stage(used.groupBy("term", "range").agg(F.sum("n").alias("n")), "term-sizes")
    rarity = asked.select("question", F.explode("terms.term").alias("term")).join(sizes.groupBy("term").agg(F.sum("n").alias("n")), "term", "left").fillna(0, ["n"])
    rarest = rarity.groupBy("question").agg(F.min(F.struct("n", "term")).alias("rarest")).where("rarest.n > 0")
    there = rarest.select("question", F.col("rarest.term").alias("term")).join(sizes.select("term", "range"), "term").drop("term")
    n_ranges = sizes.select("range").distinct().count()
    copies = max(1, math.ceil(spark.sparkContext.defaultParallelism / max(1, n_ranges)))
    nothing = {"question": "string", "terms": asked.schema["terms"].dataType, "term": "string", "shift": "int", "data": "binary"}
    null = lambda *names: [F.lit(None).cast(nothing[c]).alias(c) for c in names]
    blocks = used.select("range", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy"), F.lit(0).alias("kind"), "term", "shift", "data", *null("question", "terms"))
    copy = F.pmod(F.xxhash64("question"), F.lit(copies)).cast("int")
    placed = there.join(asked, "question").select("range", copy.alias("copy"), F.lit(1).alias("kind"), *null("term", "shift", "data"), "question", "terms")
    cells = blocks.unionByName(placed).repartition("range", "copy").sortWithinPartitions("range", "copy", "kind")
    return stage(cells.mapInArrow(_match(index.kind), "question string, range int, n int, ids array<int>"), "index-matches")
