"""N-gram Jaccard join with Bayesian pruning of candidates.

Texts that are equal become one class. Each class has ``BANDS * ROWS`` MinHash values of its five-word shingles; classes
that agree on all rows of a band are candidates, and are compared in the first band they share only. The comparison
takes the values a step at a time: after ``n`` of them, ``m`` equal, the similarity's posterior is Beta(1 + m, 1 + n - m),
and the pair is dropped once the chance that it reaches the threshold is below the tolerance. What remains is
compared exactly, shingle by shingle.

Work goes on in cells. A bucket of a band with up to ``CELL`` classes is one cell; a larger one is cut into blocks and
each pair of blocks is a cell, so no task holds more than two blocks and no pair is left out. Cells hand on one row
per class, its number of links and the root of its links, never the pairs. The texts of classes with candidates
left are sent to their cells for the exact comparison.

A pair of similarity s is missed with a chance of (1 - s^4)^24, 3 in a million at 0.8, and by the tolerance.

Defined results: texts without words (and null ones) have no shingles and no links and stand alone; a text of less than
five words has one shingle, all of it; repeated rows are copies; an empty table gives an empty one.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphprep.llm.common import Shingles, columns_of, extended, shingle_set
from graphprep.operators.lookup import unique_join
from graphprep.workspace import stage

BANDS = 24
ROWS = 4
THRESHOLD = 0.8
TOLERANCE = 1e-6
STEP = 16
CELL = 1024
PAIRS = 65_536  # compared at once in a task
HOT_SHARE = 1000  # a class with more than a thousandth of the rows is hot


@lru_cache
def _factors(n: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    drawn = np.random.default_rng(seed).integers(0, 2**32, size=(2, n, 1), dtype=np.uint32)
    return drawn[0] | np.uint32(1), drawn[1]


def minhash(shingles: np.ndarray, values: int = BANDS * ROWS) -> np.ndarray:
    """The least of each of ``values`` 32-bit hashes over the shingles, in slices of bounded size."""
    a, b = _factors(values)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(values, np.iinfo(np.uint32).max, np.uint32)
    for i in range(0, len(short), 512):
        np.minimum(least, (short[i : i + 512] * a + b).min(axis=1), out=least)
    return least


@lru_cache
def least_matches(values: int, threshold: float, tolerance: float, step: int) -> tuple[int, ...]:
    """For step, 2 step, ... values: the fewest equal ones with which a pair is kept.

    The posterior chance of reaching the threshold after m of n is P(Bin(n + 1, threshold) <= m).
    """
    kept = []
    for n in range(step, values + 1, step):
        chance, m = 0.0, -1
        while chance < tolerance:
            m += 1
            chance += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        kept.append(m)
    return tuple(kept)


def signatures(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, shingles, signature`` for every row of ``doc_id, text``; the key is the text's digest."""
    rows = docs.select("doc_id", F.md5(F.coalesce(F.col("text"), F.lit(""))).alias("text_key"), "text")
    schema = extended(rows.drop("text"), "shingles bigint, signature binary")

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Shingles()
        for batch in batches:
            (texts,) = columns_of(batch, "text")
            sizes, found = [], []
            for text in texts:
                own = hashes(text or "")
                sizes.append(len(own))
                found.append(minhash(own).tobytes() if len(own) else None)
            columns = [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(found, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_key", "shingles", "signature"])

    return rows.mapInArrow(signed, schema)


def candidate_cells(classes: DataFrame, cell: int = CELL) -> DataFrame:
    """``cell, block, rep`` : the classes of every bucket with two classes or more, dealt out to cells.

    ``classes`` is a stored table ``rep, signature``. A cell is named by band, bucket and pair of blocks; ``block`` says
    which of the two a class is in.
    """
    width = 4 * ROWS
    bands = F.array(*[F.struct(F.lit(b).alias("band"), F.xxhash64(F.substring("signature", b * width + 1, width)).alias("bucket")) for b in range(BANDS)])
    keyed = classes.where(F.col("signature").isNotNull()).select("rep", F.explode(bands).alias("at")).select("rep", "at.*")
    shared = keyed.groupBy("band", "bucket").agg(F.count("*").alias("n")).where("n > 1")
    shared = shared.select(F.col("band").alias("_band"), F.col("bucket").alias("_bucket"), "n")
    met = keyed.join(shared, (keyed["band"] == shared["_band"]) & (keyed["bucket"] == shared["_bucket"]))
    blocks = F.ceil(F.col("n") / F.lit(cell)).cast("int")
    dealt = met.select("rep", "band", "bucket", blocks.alias("blocks"), F.pmod(F.xxhash64("rep"), blocks).cast("int").alias("own"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    pairs = dealt.select("rep", "band", "bucket", "own", other)
    name = F.xxhash64("band", "bucket", F.least("own", "other"), F.greatest("own", "other"))
    return pairs.select(name.alias("cell"), "band", (F.col("own") > F.col("other")).alias("second"), (F.col("own") == F.col("other")).alias("alone"), "rep")


def whole_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole cells from batches sorted by ``cell``; the last, perhaps unfinished one waits for the next batch."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        cell = batch.column(batch.schema.get_field_index("cell")).to_numpy()
        last = int(np.searchsorted(cell, cell[-1]))
        if last or (held and held[-1].column(held[-1].schema.get_field_index("cell"))[-1].as_py() != cell[-1]):
            table = pa.Table.from_batches([*held, batch.slice(0, last)])
            held = []
            if table.num_rows:
                yield table.combine_chunks()
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def pairs_of(cell: np.ndarray, second: np.ndarray, alone: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of all pairs within each cell, across its two blocks if it has two, in chunks of about ``PAIRS``."""
    starts = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
    ends = np.append(starts[1:], len(cell))
    left, right, size = [], [], 0
    for start, end in zip(starts.tolist(), ends.tolist()):
        if alone[start]:
            mine, theirs = np.arange(start, end), None
        else:
            mine, theirs = start + np.flatnonzero(~second[start:end]), start + np.flatnonzero(second[start:end])
        for place, i in enumerate(mine.tolist()):
            others = mine[place + 1 :] if theirs is None else theirs
            if len(others):
                left.append(np.full(len(others), i))
                right.append(others)
                size += len(others)
            if size >= PAIRS:
                yield np.concatenate(left), np.concatenate(right)
                left, right, size = [], [], 0
    if left:
        yield np.concatenate(left), np.concatenate(right)


def outlasting(signature: np.ndarray, band: np.ndarray, left: np.ndarray, right: np.ndarray, least: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that agree in their cell's band, in none before it, and are kept by every step."""
    keys = signature.reshape(len(signature), BANDS, ROWS)
    here = band[left]
    kept = (keys[left, here] == keys[right, here]).all(axis=1)  # a bucket is named by a hash, this is the bucket itself
    left, right, here = left[kept], right[kept], here[kept]
    for b in range(BANDS - 1):
        kept = (here <= b) | (keys[left, b] != keys[right, b]).any(axis=1)
        left, right, here = left[kept], right[kept], here[kept]
    equal = np.zeros(len(left), np.int64)
    for at, fewest in zip(range(0, signature.shape[1], STEP), least):
        equal = equal + (signature[left, at : at + STEP] == signature[right, at : at + STEP]).sum(axis=1)
        kept = equal >= fewest
        left, right, equal = left[kept], right[kept], equal[kept]
    return left, right


def _prune(threshold: float, tolerance: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = least_matches(BANDS * ROWS, threshold, tolerance, STEP)
        for table in whole_cells(batches):
            cell, band, rep = (table.column(c).to_numpy() for c in ("cell", "band", "rep"))
            second, alone = (table.column(c).to_numpy(zero_copy_only=False) for c in ("second", "alone"))
            packed = b"".join(table.column("signature").to_pylist())
            signature = np.frombuffer(packed, np.uint32).reshape(len(cell), BANDS * ROWS)
            found = [outlasting(signature, band, *pairs, least) for pairs in pairs_of(cell, second, alone)]
            if not found:
                continue
            left, right = (np.concatenate(side) for side in zip(*found))
            # One row for each class that has a pair: the partners that come after it in the cell's order.
            order = np.argsort(left, kind="stable")
            left, right = left[order], right[order]
            rows = np.unique(np.concatenate([left, right]))
            edges = np.searchsorted(left, np.append(rows, len(cell)))
            partners = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(rep[right], pa.int64()))
            for at in range(0, len(rows), 10_000):
                part = slice(at, at + 10_000)
                columns = [pa.array(cell[rows[part]]), pa.array(rep[rows[part]]), partners[part]]
                yield pa.RecordBatch.from_arrays(columns, names=["cell", "rep", "partners"])

    return prune


def _verify(threshold: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_cells(batches):
            cell = table.column("cell").to_numpy()
            starts = np.flatnonzero(np.append(True, cell[1:] != cell[:-1])).tolist()
            out: dict[str, list[int]] = {"rep": [], "root": [], "documents": [], "texts": []}
            for start, end in zip(starts, [*starts[1:], len(cell)]):
                part = table.slice(start, end - start)
                for row in links_of(*(part.column(c).to_pylist() for c in ("rep", "partners", "copies", "text")), threshold):
                    for name, value in zip(out, row):
                        out[name].append(value)
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in out.values()], names=list(out))

    return verify


def links_of(reps: list[int], partners: list[list[int]], copies: list[int], texts: list[bytes], threshold: float) -> Iterator[tuple[int, int, int, int]]:
    """``(rep, root, documents, texts)`` for the classes of one cell that have a link there."""
    sets = {rep: shingle_set(zlib.decompress(text).decode()) for rep, text in zip(reps, texts)}
    weight = dict(zip(reps, copies))
    root = {rep: rep for rep in reps}
    links = {rep: [0, 0] for rep in reps}

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for rep, others in zip(reps, partners):
        own = sets[rep]
        for other in others:
            theirs = sets[other]
            if min(len(own), len(theirs)) < threshold * max(len(own), len(theirs)):
                continue
            common = len(own & theirs)
            if common >= threshold * (len(own) + len(theirs) - common):
                for a, b in ((rep, other), (other, rep)):
                    links[a][0] += weight[b]
                    links[a][1] += 1
                x, y = top(rep), top(other)
                root[max(x, y)] = min(x, y)
    for rep in reps:
        if links[rep][1]:
            yield rep, top(rep), *links[rep]


def connected(edges: DataFrame, name: str = "jaccard-components") -> DataFrame:
    """``rep, root``: every node of ``rep, root`` edges with the least node it is connected to.

    Rounds of hooking to the least neighbour and shortcutting; each is stored in the shared folder, and only a count
    comes to the driver. The rounds grow with the logarithm of a component's length.
    """
    both = edges.select(F.col("rep").alias("a"), F.col("root").alias("b"))
    both = stage(both.union(edges.select("root", "rep")).where("a <> b").distinct(), name)
    labels = stage(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("rep"), F.least("a", "m").alias("root")), name)
    while True:
        # The least label among the neighbours, then the label of that label.
        near = both.join(labels.withColumnRenamed("rep", "b"), "b").groupBy(F.col("a").alias("rep")).agg(F.min("root").alias("near"))
        hooked = labels.join(near, "rep").select("rep", F.col("root").alias("old"), F.least("root", "near").alias("hook"))
        jump = labels.select(F.col("rep").alias("hook"), F.col("root").alias("jump"))
        moved = hooked.join(jump, "hook", "left").select("rep", "old", F.least("hook", F.coalesce("jump", "hook")).alias("root"))
        after = stage(moved, name)
        labels = after.select("rep", "root")
        if not after.where("root <> old").limit(1).count():
            return labels


def link_documents(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> tuple[DataFrame, DataFrame]:
    """Members and classes of ``docs`` (``doc_id``, ``text``), both stored.

    Members: ``doc_id, text_key`` for every row. Classes: one row per text, ``text_key, first_id`` (its least doc_id),
    ``copies, n_links`` (documents of other texts linked to it, plus its other copies), ``n_text_links``, ``group_id``
    (the least first_id of all texts connected to it) and ``group_key`` (the text_key that owns it).
    """
    members = stage(signatures(docs), "jaccard-members")
    grouped = members.groupBy("text_key").agg(
        F.min("doc_id").alias("first_id"), F.count("*").alias("copies"), F.first("shingles").alias("shingles"), F.first("signature").alias("signature")
    )
    classes = stage(grouped.withColumn("rep", F.monotonically_increasing_id()), "jaccard-classes")
    cells = stage(candidate_cells(classes.select("rep", "signature")), "jaccard-cells")
    values = classes.select(F.col("rep").alias("_rep"), "signature")
    signed = cells.join(values, cells["rep"] == values["_rep"]).drop("_rep")
    sorted_ = signed.repartition("cell").sortWithinPartitions("cell")
    pruned = sorted_.mapInArrow(_prune(threshold, tolerance), "cell bigint, rep bigint, partners array<bigint>")
    left = stage(pruned, "jaccard-candidates")
    found = stage(_verified(docs, left, classes, threshold), "jaccard-links")
    labels = connected(found)
    totals = found.groupBy("rep").agg(F.sum("documents").alias("documents"), F.sum("texts").alias("texts"))
    narrow = classes.select("rep", "text_key", "first_id", "copies", "shingles")
    labelled = narrow.join(labels, "rep", "left").join(totals, "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    least = labelled.groupBy("root").agg(F.min(F.struct(F.col("first_id").isNull(), "first_id", "text_key")).alias("least"))
    whole = labelled.join(least, "root").select(
        "text_key",
        "first_id",
        "copies",
        "shingles",
        (F.coalesce("documents", F.lit(0)) + F.when(F.col("shingles") > 0, F.col("copies") - 1).otherwise(0)).alias("n_links"),
        F.coalesce("texts", F.lit(0)).alias("n_text_links"),
        F.col("least")["first_id"].alias("group_id"),
        F.col("least")["text_key"].alias("group_key"),
    )
    return members.select("doc_id", "text_key", "shingles"), stage(whole, "jaccard-groups")


def _verified(docs: DataFrame, left: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """``rep, root, documents, texts`` of each cell, after the exact comparison.

    Only one row of a text is sent: of the copies, those with the least doc_id meet it, and repeated rows are combined
    by each task before the shuffle.
    """
    wanted = left.select("rep").distinct().join(classes.select("rep", "text_key", "first_id", "copies"), "rep")
    wanted = stage(wanted.select("rep", "copies", F.col("text_key").alias("_key"), F.col("first_id").alias("_id")), "jaccard-wanted")
    texts = docs.select("doc_id", F.md5(F.coalesce(F.col("text"), F.lit(""))).alias("text_key"), F.coalesce("text", F.lit("")).alias("text"))
    # The wanted classes grow with the corpus, so they are never broadcast, not even where they happen to be few.
    met = texts.join(wanted.hint("merge"), (texts["text_key"] == wanted["_key"]) & texts["doc_id"].eqNullSafe(wanted["_id"]))
    once = met.groupBy("rep", "copies").agg(F.first("text").alias("text"))
    packed = stage(once.select("rep", "copies", "text"), "jaccard-texts")
    schema = "rep bigint, copies bigint, text binary"

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (texts,) = columns_of(batch, "text")
            small = pa.array([zlib.compress(t.encode(), 1) for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), small], names=["rep", "copies", "text"])

    sent = left.join(packed.mapInArrow(squeeze, schema), "rep")
    sorted_ = sent.repartition("cell").sortWithinPartitions("cell")
    return sorted_.mapInArrow(_verify(threshold), "rep bigint, root bigint, documents bigint, texts bigint")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """``doc_id, class_id, n_links, n_text_links`` for every row: the group it is in, named by its least doc_id."""
    members, classes = link_documents(docs, threshold, tolerance)
    found = unique_join(members.select("doc_id", "text_key", F.col("shingles").alias("_n")), _result(classes), "text_key", "_text_key", hot=_hot(classes))
    alone = F.col("_n") == 0
    return found.select("doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("group_id")).alias("class_id"), "n_links", "n_text_links")


def _result(classes: DataFrame) -> DataFrame:
    return classes.select(F.col("text_key").alias("_text_key"), "group_id", "n_links", "n_text_links")


def _hot(classes: DataFrame) -> list[str]:
    """Texts with more than a thousandth of the rows: fewer than a thousand, and known from the counts."""
    total = classes.agg(F.sum("copies")).first()[0] or 0
    return [r[0] for r in classes.where(F.col("copies") > max(1000, total // HOT_SHARE)).select("text_key").collect()]


def keep_one(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """``docs`` with one row of each group, one with its least doc_id; rows without words all stay."""
    _, classes = link_documents(docs, threshold, tolerance)
    chosen = classes.where((F.col("text_key") == F.col("group_key")) & (F.col("shingles") > 0))
    chosen = chosen.select(F.col("text_key").alias("_key"), F.col("first_id").alias("_id"))
    text = F.coalesce(docs["text"], F.lit(""))
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), F.md5(text).alias("key"), F.trim(F.translate(text, "\t\n\x0b\x0c\r", "     ")).alias("bare"))
    wordless = rows.where(F.col("bare") == "").select("doc.*")
    worded = rows.where(F.col("bare") != "").select("doc", "key", F.col("doc")["doc_id"].alias("id"))
    met = worded.join(chosen, (worded["key"] == chosen["_key"]) & worded["id"].eqNullSafe(chosen["_id"]))
    once = met.groupBy("key", "id").agg(F.first("doc").alias("doc"))
    return once.select("doc.*").unionByName(wordless)
