"""Document fingerprints: bottom-k sketches of shingle hashes, by DataFrame functions only.

A sketch is the ascending array of the ``k`` least distinct 63-bit hashes of a text's five-word shingles. The sketch of
a union is the ``k`` least of both sketches, so parts (of a text or of a corpus) are sketched apart and merged. From
two sketches follow resemblance (the share of hashes that both have among the ``k`` least of the union), from one
the number of distinct shingles (``k - 1`` over the place of the last hash in the unit interval; exact below ``k``), and
from both the containment.

Defined results: null and empty texts and texts without words have an empty sketch, two empty sketches resemble each other
fully and an empty and a filled one not at all; a text of less than five words is one shingle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphprep.llm.common import SHINGLE, SPACES, cumulate
from graphprep.workspace import stage

K = 128
SPAN = float(2**63)


def split_words(text: Column) -> Column:
    return F.filter(F.split(text, SPACES, -1), lambda w: w != "")


def word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def shingle_hashes(hashes: Column, size: int = SHINGLE) -> Column:
    """Hashes of all runs of ``size`` words from the words' hashes; of all words if they are fewer; none without words.

    Pass a column of a DataFrame, not an expression: it is looked up for each run, and would be computed each time.
    """
    starts = F.slice(hashes, 1, F.greatest(F.size(hashes) - (size - 1), F.lit(0)))
    runs = F.transform(starts, lambda h, i: F.shiftrightunsigned(F.xxhash64(h, *[F.get(hashes, i + j) for j in range(1, size)]), 1))
    few = F.array(F.shiftrightunsigned(F.xxhash64(F.array_join(F.transform(hashes, lambda h: h.cast("string")), " ")), 1))
    none = F.array().cast("array<bigint>")
    return F.when(F.size(hashes) >= size, runs).when(F.size(hashes) > 0, few).otherwise(none)


def least(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def with_sketch(table: DataFrame, text: str, name: str, k: int = K) -> DataFrame:
    """Adds the sketch ``name`` of the column ``text``."""
    hashed = table.withColumn("_hashes", word_hashes(split_words(F.coalesce(F.col(text), F.lit("")))))
    return hashed.withColumn(name, least(shingle_hashes(F.col("_hashes")), k)).drop("_hashes")


def merge(left: Column, right: Column, k: int = K) -> Column:
    return least(F.concat(left, right), k)


def merge_rows(table: DataFrame, sketches: str, *keys: str, k: int = K) -> DataFrame:
    """One sketch per key from a column of sketches: the least hashes of each group, never a whole group in a task.

    Hashes are first made distinct per key; each range of hashes then gives its own ``k`` least, and those are merged.
    """
    hashes = table.select(*keys, F.explode(sketches).alias("h")).distinct()
    part = F.pmod(F.xxhash64("h"), F.lit(256))
    local = hashes.groupBy(*keys, part.alias("part")).agg(least(F.collect_set("h"), k).alias("s"))
    return local.groupBy(*keys).agg(least(F.flatten(F.collect_list("s")), k).alias(sketches))


def distinct_shingles(s: Column, k: int = K) -> Column:
    return F.when(F.size(s) < k, F.size(s).cast("double")).otherwise((k - 1) * SPAN / F.element_at(s, -1).cast("double"))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of common shingles among all; exact if both texts have less than ``k`` together."""
    union = merge(a, b, k)
    both = F.size(F.array_intersect(F.array_intersect(union, a), b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(both / F.greatest(F.size(union), F.lit(1)))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of ``a``'s shingles that ``b`` has; 1 for an empty ``a``."""
    union = distinct_shingles(merge(a, b, k), k)
    common = resemblance(a, b, k) * union
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), common / F.greatest(distinct_shingles(a, k), F.lit(1.0))))


def as_text(s: Column) -> Column:
    """16 hex digits for each hash, in ascending order."""
    return F.array_join(F.transform(s, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def from_text(text: Column) -> Column:
    places = F.sequence(F.lit(0), F.greatest(F.length(text) / 16 - 1, F.lit(0)).cast("int"))
    parts = F.transform(places, lambda i: F.conv(F.substring(text, (i * 16 + 1).cast("int"), F.lit(16)), 16, 10).cast("bigint"))
    return F.when(F.length(text) > 0, parts).otherwise(F.array().cast("array<bigint>"))


#: What tells documents apart: two plain columns for doc_id, so that null ones meet by equality, and the text's hash.
IDENTITY = ("blank", "number", "key")


def neighbours(rows: DataFrame) -> DataFrame:
    """The identity of each distinct document, of the one before it (``before_...``), and ``borrowed``.

    The order is doc_id (null last), then the text's hash, and goes round. ``borrowed`` is how many characters the
    document before takes from this one. Repeated rows are one document here. No text is moved.
    """
    distinct = rows.select(*IDENTITY, F.length("text").alias("n_chars")).distinct()
    placed = stage(cumulate(stage(distinct, "print-ids"), [], IDENTITY, {"place": F.lit(1)}, "print-places"), "print-order")
    total = placed.count()
    after = F.pmod(F.col("place") + 1, F.lit(max(total, 1))).alias("place")
    moved = placed.select(after, *[F.col(c).alias(f"before_{c}") for c in IDENTITY], F.floor(F.col("n_chars") / 4).cast("int").alias("borrowed"))
    return placed.join(moved, "place").drop("place", "n_chars")


def compare_edits(docs: DataFrame, k: int = K) -> DataFrame:
    """Fingerprints of every document, its edited text, and their likeness, for ``doc_id`` (bigint) and ``text``.

    The edited text has its last quarter of characters replaced by the beginning of the next document. The text is cut
    in three parts: what is kept, its own end and the borrowed end, each end with the last words kept, so that every
    run of words is in a part. The kept part is sketched once and serves both texts.

    Texts are shuffled once, by document; to the document before goes the borrowed beginning and the sketch only.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").isNull().alias("blank"), F.coalesce("doc_id", F.lit(0)).alias("number"), text.alias("text"))
    rows = rows.select("blank", "number", F.xxhash64("text").alias("key"), "text")
    order = stage(neighbours(rows), "print-neighbours")
    before = [f"before_{c}" for c in IDENTITY]
    lent = with_sketch(rows.join(order, list(IDENTITY)), "text", "next_s", k).groupBy(*before)
    lent = lent.agg(F.first(F.substring("text", F.lit(1), F.col("borrowed"))).alias("borrowed_text"), F.first("next_s").alias("next_s"))
    # Grouped and joined by the same columns, so what is lent is shuffled once.
    mine = rows.join(lent, [rows[c] == lent[b] for c, b in zip(IDENTITY, before)])
    n_chars = F.length("text")
    cut = n_chars - F.floor(n_chars / 4).cast("int")
    parts = mine.select(
        F.when(~F.col("blank"), F.col("number")).alias("doc_id"),
        n_chars.cast("bigint").alias("n_chars"),
        F.substring("text", F.lit(1), cut).alias("kept"),
        F.substring("text", cut + 1, n_chars).alias("own"),
        "borrowed_text",
        "next_s",
    )
    known = ["doc_id", "n_chars", "next_s"]
    # The last piece may go on in the end; it and the four words before it belong to the ends.
    cutting = parts.withColumn("pieces", F.split("kept", SPACES, -1))
    edited = F.sha2(F.encode(F.concat("kept", "borrowed_text"), "UTF-8"), 256)
    last = F.element_at("pieces", -1)
    ended = cutting.select(
        *known,
        edited.alias("edited_sha256"),
        word_hashes(F.filter(F.slice("pieces", 1, F.size("pieces") - 1), lambda w: w != "")).alias("whole"),
        word_hashes(split_words(F.concat(last, "own"))).alias("own"),
        word_hashes(split_words(F.concat(last, "borrowed_text"))).alias("new"),
    )
    overlap = F.slice("whole", F.greatest(F.size("whole") - (SHINGLE - 2), F.lit(1)), SHINGLE - 1)
    joined = ended.select(*known, "edited_sha256", "whole", F.concat(overlap, "own").alias("own"), F.concat(overlap, "new").alias("new"))
    # An end of less than five words with its overlap has a run of its own only if it is the whole text.
    none = F.array().cast("array<bigint>")
    kept = F.when(F.size("whole") >= SHINGLE, least(shingle_hashes(F.col("whole")), k)).otherwise(none)
    end = {c: F.when((F.size("whole") < SHINGLE) | (F.size(c) >= SHINGLE), least(shingle_hashes(F.col(c)), k)).otherwise(none) for c in ("own", "new")}
    sketched = joined.select(*known, "edited_sha256", kept.alias("kept"), end["own"].alias("own"), end["new"].alias("new"))
    merged = sketched.select(*known, "edited_sha256", merge(F.col("kept"), F.col("own"), k).alias("s"), merge(F.col("kept"), F.col("new"), k).alias("e"))
    return merged.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("s")).alias("fingerprint"),
        as_text(F.col("e")).alias("edited_fingerprint"),
        resemblance(F.col("s"), F.col("e"), k).alias("near_edited"),
        resemblance(F.col("s"), F.col("next_s"), k).alias("near_next"),
        distinct_shingles(F.col("s"), k).alias("shingles"),
        containment(F.col("e"), F.col("s"), k).alias("edited_in_text"),
    )
